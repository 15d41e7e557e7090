"""The pipeline's stages, each against the operators' brute-force forms, and the registered queries."""
from __future__ import annotations

import llm_cases as C

import __spark_entry__ as E
import corpus_pipeline as P
from reqtrail.llm import quality


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    junk = [(500 + i, " ".join(w + "%%%" for w in C.words(C.prose(i, 90))), "en", "a", 9) for i in range(4)]
    extra = [(600, C.prose(600, 80) + " token=abcdef0123456789 " + C.prose(601, 20), "en", "b", 0)]
    data = C.rows() + junk + extra + [(700 + i, C.prose(700 + i, 70), "en", "abc"[i % 3], 0) for i in range(40)]
    docs = C.frame(spark, data)
    columns = docs.columns
    seen = {}
    for i, (name, stage) in enumerate(P.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        seen[name] = docs.collect()
        if i < len(P.STAGES) - 1:
            assert docs.columns == columns
    first, second, third, fourth, last = seen.values()
    rejected = {d for d, t, *_ in data} - {r.doc_id for r in first}
    assert {500, 501, 502, 503} <= rejected and 600 not in rejected and not {700 + i for i in range(40)} & rejected
    assert all(len(C.words(r.text)) >= quality.LEAST_WORDS for r in first)
    assert [r.doc_id for r in second].count(1) == 1 and not {2, 3} & {r.doc_id for r in second}
    assert {r.doc_id for r in second} <= {r.doc_id for r in first} and len(third) == len(second)
    text = {r.doc_id: r for r in third}[600]
    assert "[SECRET]" in text.text and "abcdef0123456789" not in text.text and text.n_chars == len(text.text)
    assert {r.doc_id for r in fourth} <= {r.doc_id for r in third} and len(last) == len(fourth)
    assert all(r.n_tokens == len(r.ids) > 0 for r in last)


def test_empty_table_through_all_stages(spark, tmp_path):
    C.frame(spark, [], clashing=False).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0


def test_every_operator_is_registered():
    names = [n for n in E.queries() if n.startswith("op")]
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 11)] and "pipeline" in E.queries()
