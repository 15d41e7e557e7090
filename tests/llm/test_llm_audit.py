"""Source divergence and embedding groups against DuckDB and plain Python."""
from __future__ import annotations

import math
import os
import random
from collections import Counter, defaultdict

import duckdb
import llm_cases as C
import numpy as np
import pytest
from pyspark.sql import functions as F

from reqtrail.llm import cosine_groups, divergence, queries

SF = "/root/testdata/sf0.001"


def plain(data: list[tuple], least: int) -> set[tuple]:
    docs = [(lang or "", source or "", [w.decode() for w in divergence.terms_of((text or "").encode())]) for _, text, lang, source, *_ in data]
    held, count = defaultdict(Counter), defaultdict(Counter)
    for lang, source, words in docs:
        held[lang].update(set(words))
        count[lang, source].update(words)
    out = set()
    f = lambda p, q: (p - q) ** 2 // (p + q)
    for lang in {x[0] for x in docs}:
        kept = [t for t, n in held[lang].items() if n >= least]
        sources = sorted({s for x, s, _ in docs if x == lang})
        total = sum((count[lang, s] for s in sources), Counter())

        def share(counts):
            n = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (n + 2 * len(kept)) for t in kept}

        p, q = {s: share(count[lang, s]) for s in sources}, share(total)
        for s in sources:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", sorted(terms, key=lambda x: (-x[0], x[1].encode()))[:10])):
                for rank, (value, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode())), 1):
                    out.add((lang, s, part, item, value, rank))
    return out


def corpus() -> list[tuple]:
    rnd = random.Random(5)
    words = [C.prose(i, 1).strip(".").lower() for i in range(60)] + ["été", "漢字", "O'Neil", "naïve"]
    data = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([0, 3, 40]))), rnd.choice(["en", "de", None]), rnd.choice(["a", "b", "c", None]), 0) for i in range(150)]
    return data + [(900, None, "fr", "x", 0), (901, "", "fr", None, 0), (902, "ONE Two", "it", "solo", 0), (902, "ONE Two", "it", "solo", 0)]


@pytest.mark.parametrize("limits", [{}, {"block_bytes": 2_000, "shard_bytes": 500}])
def test_audit_equals_plain_python(spark, limits):
    """Also with blocks of a few postings and many shards."""
    data = corpus()
    got = divergence.audit(C.frame(spark, data), **limits)
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == plain(data, 10)


def test_audit_of_the_shared_cases(spark):
    data = C.rows()
    assert {tuple(r) for r in divergence.audit(C.frame(spark, data), least=2).collect()} == plain(data, 2)
    assert divergence.audit(C.frame(spark, [])).collect() == []


def test_large_counts_stay_exact(spark):
    n = 3 * 10**12 + 7
    got = spark.createDataFrame([(n - 5, n, 11)], "c long, n long, v long").select(divergence.share(*(F.col(x) for x in "cnv"))).first()[0]
    assert got == 1 + 10**9 * (n - 5 + 2) // (n + 22)


def test_spilled_runs_are_sorted_and_whole():
    block = divergence.Block(3)
    texts = [("en", "a", C.prose(i, 50).encode()) for i in range(4)]
    for lang, source, text in texts:
        block.add((lang, source), text)
    runs = list(block.spill())
    want = Counter(w for *_, t in texts for w in divergence.terms_of(t))
    got = {}
    for run in runs:
        terms = [t for t, _, _ in divergence.walk(run)]
        assert terms == sorted(terms)
        got |= {t: sum(n for _, n, _ in postings) for t, _, postings in divergence.walk(run)}
    assert got == want and block.size == 0 and not block.groups


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test tables not present")
@pytest.mark.parametrize("name", ["op12_divergence", "op13_embeddings"])
def test_queries_equal_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF).toPandas()
    want = con.sql(queries.ORACLE_SQL[name]).df()
    columns = sorted(got.columns)
    as_set = lambda df: sorted(map(tuple, df[columns].astype(str).values))
    assert sorted(want.columns) == columns and as_set(got) == as_set(want)


VECTORS = "vec_id long, embedding array<float>, label int, home string, node string, bucket string"


def groups(length: int = 24, seed: int = 3) -> list[tuple]:
    """Clusters around some centres at cosines near 0.98, equal copies, and everything that links with nothing."""
    rnd, out = np.random.default_rng(seed), []

    def put(vector, label):
        out.append((len(out) * 3 + 1, None if vector is None else [None if x is None else float(x) for x in vector], label))

    for c in range(12):
        centre = rnd.standard_normal(length)
        for k in range(int(rnd.integers(1, 30))):
            put(centre + rnd.standard_normal(length) * rnd.choice([0.05, 0.09, 0.12]), c % 3)
    copy = np.float32(rnd.standard_normal(length))
    for _ in range(40):
        put(copy, 1)
    put(copy, 2)
    put(copy * 2, 1)
    for bad in (None, [], [0.0] * length, [None, *[1.0] * (length - 1)], [math.nan, *[1.0] * (length - 1)], [math.inf, *[1.0] * (length - 1)], [1.0] * (length // 2)):
        put(bad, 1)
        put(bad, 1)
    put(copy, None)
    put([1e-30] * length, 0)
    put([1e30] * length, 0)
    return out


def all_pairs(data: list[tuple], least: float = 0.98) -> set[tuple]:
    ids, n, root = [d for d, *_ in data], Counter(), list(range(len(data)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    good = {}
    for i, (_, v, label) in enumerate(data):
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float32).astype(np.float64)
            good[i] = (label, x / np.linalg.norm(x))
    for i in good:
        for j in good:
            if i < j and good[i][0] == good[j][0] and len(good[i][1]) == len(good[j][1]) and good[i][1] @ good[j][1] >= least:
                n[i] += 1
                n[j] += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least_id = {}
    for i in range(len(data)):
        least_id[find(i)] = min(least_id.get(find(i), ids[i]), ids[i])
    return {(ids[i], n[i], least_id[find(i)], least_id[find(i)] == ids[i]) for i in range(len(data))}


@pytest.mark.parametrize("limits", [{}, {"block": 16}, {"bucket_size": 1}])
def test_groups_equal_all_pairs(spark, limits):
    """Also with buckets cut into chunks, and with codes of two levels."""
    data = groups()
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in data], VECTORS).repartition(4)
    got = cosine_groups.near_duplicates(df, **limits).collect()
    assert {tuple(r) for r in got} == all_pairs(data) and len(got) == len(data)


def test_repeated_rows_and_null_ids(spark):
    v = [float(i % 5) + 0.5 for i in range(16)]
    data = [(7, v, 1), (7, v, 1), (None, v, 1), (9, [-x for x in v], 1)]
    got = cosine_groups.near_duplicates(spark.createDataFrame([(*r, "x", "y", "z") for r in data], VECTORS)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(7, 2, 7, True), (7, 2, 7, True), (None, 2, 7, False), (9, 0, 9, True)], key=repr)
    assert cosine_groups.near_duplicates(spark.createDataFrame([], VECTORS)).collect() == []


def test_margin_finds_partners_at_the_least_cosine():
    """Recall of pairs at exactly the least cosine, the hardest ones, for codes of one and two levels."""
    rnd = np.random.default_rng(1)
    x, z = rnd.standard_normal((2, 4000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    z -= (z * x).sum(1)[:, None] * x
    z /= np.linalg.norm(z, axis=1)[:, None]
    y = 0.98 * x + math.sqrt(1 - 0.98**2) * z
    for levels in (1, 2):
        hash_ = cosine_groups.Hash(64, cosine_groups.TABLES, levels, 0.98)
        (home_x, in_x), (home_y, in_y) = hash_.places(x), hash_.places(y)
        rows, found = np.arange(len(x)), np.zeros(len(x), bool)
        for t in range(hash_.tables):
            a, b = np.ones(len(x), bool), np.ones(len(x), bool)
            for level in range(levels):
                a &= in_y[t, level, rows, home_x[t, level]]
                b &= in_x[t, level, rows, home_y[t, level]]
            found |= a | b
        assert found.mean() >= 0.998
