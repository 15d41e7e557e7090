"""Chunked children equal the one array of a document, element by element, and spread a hot document over tasks."""
from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from reqtrail.operators import chunks, link, nest

LINES = "k string, o long, item string, q int"


def _lines(spark, n=3000, seed=1):
    rnd = random.Random(seed)
    rows = [("hot" if rnd.random() < 0.4 else None if rnd.random() < 0.05 else f"k{rnd.randint(0, 40)}", i, f"i{rnd.randint(0, 99)}",
             rnd.choice([None, 1, 2])) for i in range(n)]
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, LINES).repartition(5)


def _header(spark):
    return spark.createDataFrame([("hot", 1), ("empty", 2), (None, 3)] + [(f"k{i}", i) for i in range(30)], "k string, unit int")


@pytest.mark.parametrize("rows", [1, 64, 5000])
def test_chunks_laid_end_to_end_are_the_array(spark, rows):
    lines, header = _lines(spark), _header(spark)
    whole = {r.k: (r.unit, r.lines) for r in nest.nest_lines(header, lines, ["k"], ["o"], ["item", "q"]).collect()}
    got = chunks.with_header(header, chunks.chunk_lines(lines, ["k"], ["o"], ["item", "q"], rows=rows), ["k"]).collect()
    parts: dict = {}
    for r in sorted(got, key=lambda r: r.chunk):
        unit, elements = parts.setdefault(r.k, (r.unit, []))
        assert len(elements) == r.chunk * rows and len(r.lines) <= rows and unit == r.unit  # whole chunks before it
        elements.extend(r.lines)
    assert parts == whole and parts["empty"] == (2, []) and parts[None] == (3, [])


def test_unchunk_gives_positions_of_the_document(spark):
    lines = _lines(spark)
    flat = chunks.unchunk_lines(chunks.chunk_lines(lines, ["k"], ["o"], ["o", "item"], rows=50), ["k"], "lines", rows=50)
    want = nest.positions(lines.select("k", "o", "item"), ["k"], ["o"])
    bag = lambda df: sorted(map(repr, df.select("k", "pos", "o", "item").collect()))
    assert bag(flat) == bag(want)


def test_links_by_chunk_equal_links_by_document(spark):
    lines, header = _lines(spark), _header(spark)
    rnd = random.Random(2)
    links = spark.createDataFrame([(rnd.choice(["hot", "k1", "k2", None]), rnd.choice([None, f"i{rnd.randint(0, 120)}"]), i, f"po{i}")
                                   for i in range(300)], "req string, line string, o long, po string")
    args = (["k"], ["req"], "lines", "item", "line", "PO", {"po": "number"}, ["o"])
    whole = link.attach_link_nested(nest.nest_lines(header, lines, ["k"], ["o"], ["item", "q"]), links, *args)
    parts = chunks.with_header(header, chunks.chunk_lines(lines, ["k"], ["o"], ["item", "q"], rows=64), ["k"])
    linked = link.attach_link_nested(parts, links, *args, chunk="chunk")
    want = [tuple(r) for r in nest.unnest_lines(whole, ["k"], "lines").collect()]
    got = [tuple(r) for r in chunks.unchunk_lines(linked, ["k"], "lines", rows=64).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and any(r[-1] for r in got)
    assert linked.count() == parts.count()


def test_hot_document_is_spread(spark):
    parts = chunks.chunk_lines(_lines(spark, 6000), ["k"], ["o"], ["item"], rows=32)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # tiny partitions would be put together
    try:
        tasks = parts.where("k = 'hot'").groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert len(tasks) >= 3 and max(r["count"] for r in tasks) < 0.6 * sum(r["count"] for r in tasks)


def test_empty_tables(spark):
    none = spark.createDataFrame([], LINES)
    parts = chunks.chunk_lines(none, ["k"], ["o"], ["item"])
    assert parts.count() == 0
    assert [tuple(r) for r in chunks.with_header(_header(spark).where("k = 'hot'"), parts, ["k"]).collect()] == [("hot", 1, 0, [])]
    assert chunks.with_header(_header(spark).limit(0), chunks.chunk_lines(_lines(spark, 50), ["k"], ["o"], ["item"]), ["k"]).count() == 0
