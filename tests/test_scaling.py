"""Plans of steps that grew faster than their input: links by chunk, joins of wide rows with keys, tables read by several loads."""
from __future__ import annotations

import datetime as dt
from contextlib import contextmanager
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from reqtrail import session
from reqtrail.functions.text import strip_ws
from reqtrail.operators import chunks, counts, keyed, merge, rewrite
from reqtrail.plans import increments, job_queries


@contextmanager
def no_broadcast(spark):
    """Joins as they are planned when no side is small."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        spark.conf.set(name, was)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def hashed_joins_only(df) -> bool:
    return "ShuffledHashJoin" in plan(df) and "SortMergeJoin" not in plan(df)


@pytest.fixture
def chunked(spark):
    lines = spark.createDataFrame([("a", i, i // 2) for i in range(200)] + [("b", 1, None), ("b", 2, 0)], "k string, o int, item int")
    return chunks.chunk_lines(lines, ["k"], ["o"], ["o", "item"], rows=50)


def test_links_of_a_chunk_are_not_searched_for_each_element(spark, chunked):
    links = spark.createDataFrame([("a", i, f"p{i}") for i in range(0, 100, 3)] + [("a", None, "x"), ("b", 0, None)], "k string, item int, po string")
    out = chunks.set_in_chunks(chunked, links, ["k"], "lines", "item", "item", "link", ["po"])
    assert "element_at" not in plan(out) and "map_from_entries" not in plan(out)
    got = {(r.k, r.o): (r.item, r.link) for r in chunks.unchunk_lines(out, ["k"], "lines", rows=50).collect()}
    assert len(got) == 202 and got["b", 1] == (None, None) and got["b", 2][1].po is None
    assert all(got["a", i][1] == ((f"p{i // 2}",) if i // 2 % 3 == 0 else None) for i in range(200))


def test_a_link_that_is_there_stays_and_one_that_comes_twice_is_an_error(spark, chunked):
    one = chunks.set_in_chunks(chunked, spark.createDataFrame([("a", 1, "x"), ("a", 2, "y")], "k string, item int, po string"), ["k"], "lines", "item", "item", "link", ["po"])
    two = chunks.set_in_chunks(one, spark.createDataFrame([("a", 2, "z")], "k string, item int, po string"), ["k"], "lines", "item", "item", "link", ["po"])
    got = {r.o: r.link for r in chunks.unchunk_lines(two, ["k"], "lines", rows=50).where("k = 'a'").collect()}
    assert [got[i] and got[i].po for i in (2, 3, 4, 5, 6)] == ["x", "x", "z", "z", None]
    twice = spark.createDataFrame([("a", 2, "z"), ("a", 2, "w")], "k string, item int, po string")
    with pytest.raises(Exception, match="twice"):
        chunks.set_in_chunks(chunked, twice, ["k"], "lines", "item", "item", "link", ["po"]).collect()


def test_strip_ws_is_the_pattern_without_a_pattern(spark):
    odd = [chr(c) for c in (*range(0, 0x21), 0x7f, 0x85, 0xa0, 0x1680, 0x180e, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202f, 0x205f, 0x2060, 0x3000, 0xfeff)]
    texts = [None, "", "a", "a b", " \t\n", "\r\na\r\n", "a \n "] + [s for c in odd for s in (c, c + "a", "a" + c, f"{c}{c}a{c}b{c}{c}")]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    new, was = strip_ws("t").alias("new"), F.regexp_replace("t", r"(?U)^\s+|\s+$", "").alias("was")
    assert [r for r in df.select("t", new, was).collect() if r.new != r.was] == []
    assert "regexp" not in plan(df.select(new))


def test_wide_rows_are_not_sorted_to_meet_keys(spark):
    rows = spark.createDataFrame([(i % 7, f"r{i}") for i in range(30)] + [(None, "n")], "k int, v string")
    stored = spark.createDataFrame([(i, f"s{i}") for i in range(10)] + [(9, "again")], "k int, v string")
    parent = spark.createDataFrame([(i,) for i in (1, 2, 2, 3, None)], "k int")
    with no_broadcast(spark):
        out = merge.replace_children(stored, rows, ["k"], parent=parent)
        assert hashed_joins_only(out)
        got = sorted((r.k, r.v) for r in out.collect())
    assert got == sorted([(i % 7, f"r{i}") for i in range(30) if i % 7 in (1, 2, 3)] + [(i, f"s{i}") for i in (0, 4, 5, 6, 7, 8, 9)] + [(9, "again")])


def test_file_names_are_not_sorted_to_find_touched_files(spark, tmp_path, monkeypatch):
    table = rewrite.create(spark.range(1000).withColumn("v", F.lit("x")), ["id"], str(tmp_path), "t")
    seen, names = [], rewrite._names
    monkeypatch.setattr(rewrite, "_names", lambda df: seen.append(df) or names(df))
    monkeypatch.setattr(rewrite, "MANY", 2, raising=False)
    with no_broadcast(spark):
        found = rewrite.touched_by_keys(spark, table, spark.range(3), ["id"])
        assert hashed_joins_only(seen[0])
    assert found and found <= set(table.files)


def test_counted_states_meet_touched_keys_unsorted(spark):
    lines = spark.createDataFrame([("a", 1), ("a", 2), ("b", None), ("c", 3), (None, 1)], "po string, req int")
    with no_broadcast(spark):
        state = counts.pair_counts(lines, ["po"], "req")
        deltas = counts.replacement_deltas(state, lines.where("po = 'a' and req = 1"), ["po"], "req", many=True)
        after = counts.apply_deltas(state, deltas, ["po"], "req")
        out = counts.updated_counts(counts.distinct_counts(state, ["po"], "req"), after, deltas, ["po"], "req", many=True)
        for df in (deltas, counts.removal_deltas(state, lines.where("po = 'c'"), ["po"], "req", many=True), out):
            assert hashed_joins_only(df)
        assert sorted(tuple(r) for r in out.collect()) == [("a", 1, 1, 1), ("b", 1, 1, 0), ("c", 1, 1, 1)]


class OneOrder:
    """Tables of one order with two lines and three events."""

    def __init__(self, spark):
        day = dt.datetime(2024, 1, 1)
        self.spark = spark
        self.orders = spark.createDataFrame([(1, 1, "F", 1.0, day, "1-URGENT")], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string")
        self.lineitem = spark.createDataFrame([(1, 5, 2, n, q, 9.0, "A", "F", day) for n, q in ((1, 7.0), (2, 50.0))],
                                              "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")
        self.events = spark.createDataFrame([(i, day, 4, "view") for i in (3, 4, 5)], "event_id long, ts timestamp_ntz, user_id long, event_type string")


def test_tables_of_several_loads_are_made_once(spark):
    for load in increments.timeline_loads(OneOrder(spark)):
        assert not any(step in plan(load[name]) for name in ("req_line", "po", "po_worklist") for step in ("Exchange", "Window", "Join", "Aggregate"))


def test_lines_of_the_counts_are_made_once(spark):
    written = []
    watch = lambda name, df: written.append((name, df))
    session.watchers.append(watch)
    try:
        rows = increments.po_req_counts_incremental(OneOrder(spark)).collect()
    finally:
        session.watchers.remove(watch)
    assert [tuple(r) for r in rows] == [("5-202401", 1, 1, 1)]
    assert [name for name, df in written if "concat" in plan(df)] == ["po-lines"]


def test_slices_hold_all_rows_and_whole_keys(spark, tmp_path):
    data = [(i % 11, "ab"[i % 2], i) for i in range(60)] + [(None, None, 7), (None, "a", 8), (3, "b", 3), (3, "b", 3)]
    spark.createDataFrame(data, "k int, g string, v int").coalesce(1).write.parquet(str(tmp_path / "t"))
    places = keyed.in_slices(spark.read.parquet(str(tmp_path / "t")), ["k", "g"], 4).withColumn("task", F.spark_partition_id()).collect()
    assert sorted([tuple(r)[:3] for r in places], key=str) == sorted(data, key=str)
    tasks, keys = [r.task for r in places], {}
    for r in places:
        keys.setdefault((r.k, r.g), set()).add(r.task)
    assert all(len(at) == 1 for at in keys.values()) and len(set(tasks)) > 1
    assert max(map(tasks.count, set(tasks))) < len(data)


def test_a_task_sorts_a_slice_of_a_report(spark):
    day = dt.datetime(2024, 1, 1)
    data = [(o, 14 * o + n, s, n, 1.0, 9.0, "ANR"[(o + n) % 3], day) for o in range(40) for n in range(4) for s in (2, 1)]
    schema = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz"
    out = job_queries.JOBS["job_req"][0](SimpleNamespace(lineitem=spark.createDataFrame(data, schema)))
    reads = plan(out).split("Exchange hashpartitioning")[1:]
    assert len(reads) == 2 and all("Union" in read and "WindowGroupLimit" in read for read in reads)
    first = {}
    for flag, tag in (("A", "n"), ("R", "o")):                   # the next report holds no A, the earlier one no R
        for o, part, supp, n, *_ in sorted(r for r in data if r[6] != flag and r[1] % 13):
            if (o, tag) not in first and not (tag == "o" and (o, "n") in first):
                first[o, tag] = (o, None if part % 5 == 0 else f"Acc{part % 3}{tag}{supp % 4}")
    assert sorted((r.REQ_No, r.Account) for r in out.collect()) == sorted(first.values())
