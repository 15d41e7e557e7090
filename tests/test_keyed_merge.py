from __future__ import annotations

from conftest import rows

from reqtrail.operators import keyed, merge, nest

T = "k string, a string, b long"


def test_first_and_last_keep_nulls(spark):
    df = spark.createDataFrame([("k1", None, 1), ("k1", "x", 2), ("k2", "y", 5), ("k2", None, 4)],
                               "k string, a string, o long")
    first = {r["k"]: r["a"] for r in keyed.first_per_key(df, ["k"], ["o"]).collect()}
    last = {r["k"]: r["a"] for r in keyed.last_per_key(df, ["k"], ["o"]).collect()}
    assert first == {"k1": None, "k2": None} and last == {"k1": "x", "k2": "y"}


def test_first_seen_and_repeated_flags(spark):
    df = spark.createDataFrame([("p", None, 1), ("p", None, 2), ("p", "t", 3), ("q", "t", 1)],
                               "p string, t string, o long")
    got = {(r["p"], r["o"]): r["repeated"] for r in keyed.repeated_flag(df, ["p", "t"], ["o"]).collect()}
    assert got == {("p", 1): False, ("p", 2): True, ("p", 3): False, ("q", 1): False}


def test_upsert(spark):
    tgt = spark.createDataFrame([("k1", "a1", 1), ("k2", "a2", 2)], T)
    src = spark.createDataFrame([("k2", None, 20), ("k3", "a3", 30), (None, "z", 0)], T)
    out = {r["k"]: r for r in merge.upsert(tgt, src, ["k"], ["a"]).collect()}
    assert set(out) == {"k1", "k2", "k3"}
    assert (out["k1"]["a"], out["k1"]["b"]) == ("a1", 1)       # kept
    assert (out["k2"]["a"], out["k2"]["b"]) == (None, 2)       # source NULL overwrites; unlisted kept
    assert (out["k3"]["a"], out["k3"]["b"]) == ("a3", None)    # inserted with listed fields only


def test_update_only_and_unmatched(spark):
    tgt = spark.createDataFrame([("k1", "a1", 1), ("k2", "a2", 2)], T)
    src = spark.createDataFrame([("k2", "new", 0), ("k9", "x", 0)], T)
    out = {r["k"]: r["a"] for r in merge.update_only(tgt, src, ["k"], ["a"]).collect()}
    assert out == {"k1": "a1", "k2": "new"}
    assert [r["k"] for r in merge.unmatched(tgt, src, ["k"]).collect()] == ["k9"]


def test_update_only_last_row_wins(spark):
    tgt = spark.createDataFrame([("k1", "a", 1)], T)
    src = spark.createDataFrame([("k1", "first", 1), ("k1", "second", 2)], T)
    out = merge.update_only(tgt, src, ["k"], ["a"], order=["b"]).collect()
    assert [r["a"] for r in out] == ["second"]


def test_replace_children_bag_set_and_update_only(spark):
    old = spark.createDataFrame([("k1", "o", 1), ("k2", "o", 1)], "k string, v string, _ord long")
    new = spark.createDataFrame([("k2", "x", 1), ("k2", "x", 2), ("k2", "y", 3), ("k3", "z", 1)],
                                "k string, v string, _ord long")
    bag = rows(merge.replace_children(old, new, ["k"]), "k", "_ord")
    assert [(r["k"], r["v"]) for r in bag] == [("k1", "o"), ("k2", "x"), ("k2", "x"), ("k2", "y"), ("k3", "z")]
    st = rows(merge.replace_children(old, new, ["k"], dedup_fields=["v"], order="_ord"), "k", "_ord")
    assert [(r["k"], r["v"], r["_ord"]) for r in st] == [("k1", "o", 1), ("k2", "x", 1), ("k2", "y", 3),
                                                         ("k3", "z", 1)]
    parent = spark.createDataFrame([("k1",), ("k2",)], "k string")
    upd = rows(merge.replace_children(old, new, ["k"], parent=parent), "k", "_ord")
    assert "k3" not in {r["k"] for r in upd}


def test_add_to_set_nan_and_null(spark):
    new = spark.createDataFrame([("k", float("nan"), 1), ("k", float("nan"), 2), ("k", None, 3), ("k", None, 4)],
                                "k string, v double, _ord long")
    st = merge.replace_children(new.limit(0), new, ["k"], dedup_fields=["v"], order="_ord")
    assert sorted(r["_ord"] for r in st.collect()) == [1, 3]


def test_backorder_reset_and_set(spark):
    item = spark.createDataFrame([("i1", 5.0), ("i2", None), ("i3", 7.0)], "Item_No string, qty double")
    src = spark.createDataFrame([("i3", 3.0, 1), ("i3", 9.0, 2), ("i9", 1.0, 1)], "Item_No string, qty double, o long")
    out = {r["Item_No"]: r["qty"] for r in merge.reset_and_set(item, src, ["Item_No"], "qty", ["o"]).collect()}
    assert out == {"i1": 0.0, "i2": 0.0, "i3": 9.0}


def test_freshness_stamp(spark):
    import datetime as dt
    ctl = spark.createDataFrame([("PO_DATA", dt.datetime(2020, 1, 1))], "dbname string, last_updated_time timestamp_ntz")
    out = {r["dbname"]: r["last_updated_time"] for r in merge.stamp(ctl, ["PO_DATA", "NEW"],
                                                                     dt.datetime(2030, 1, 1)).collect()}
    assert out == {"PO_DATA": dt.datetime(2030, 1, 1)}


def test_merge_is_idempotent(spark):
    tgt = spark.createDataFrame([("k1", "a1", 1), ("k2", "a2", 2)], T)
    src = spark.createDataFrame([("k2", "b", 0), ("k3", "c", 0)], T)
    once = merge.upsert(tgt, src, ["k"], ["a"])
    twice = merge.upsert(once, src, ["k"], ["a"])
    assert rows(once, "k") == rows(twice, "k")


def test_nest_and_unnest(spark):
    header = spark.createDataFrame([("k1",), ("k2",)], "k string")
    lines = spark.createDataFrame([("k1", "b", 2), ("k1", "a", 1)], "k string, v string, o long")
    docs = {r["k"]: r["lines"] for r in nest.nest_lines(header, lines, ["k"], ["o"], ["v"]).collect()}
    assert [e["v"] for e in docs["k1"]] == ["a", "b"] and docs["k2"] == []
    flat = nest.unnest_lines(nest.nest_lines(header, lines, ["k"], ["o"], ["v"]), ["k"], "lines")
    assert [(r["pos"], r["v"]) for r in rows(flat, "pos")] == [(0, "a"), (1, "b")]


def test_versioned_writes_and_fan_out(spark):
    import os
    import tempfile
    root = tempfile.mkdtemp(prefix="reqtrail-out-")
    df = spark.createDataFrame([("k1", "a", 1)], T)
    dev, prod = os.path.join(root, "dev"), os.path.join(root, "prod")
    paths = merge.fan_out(df, [dev, prod], "TIMELINE")
    assert [p.startswith(b) for p, b in zip(paths, [dev, prod])] == [True, True]
    again = merge.write_version(df, dev, "TIMELINE")
    assert again != paths[0]                                   # a new version, never over the old one
    assert spark.read.parquet(paths[0]).collect() == spark.read.parquet(again).collect()


def test_first_row_is_reduced_before_the_shuffle(spark):
    df = spark.createDataFrame([("k", i % 3, i) for i in range(50)], "k string, a long, o long")
    plan = keyed.first_per_key(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    below_exchange = plan.split("Exchange hashpartitioning", 1)[1]
    assert "WindowGroupLimit" in below_exchange          # partial top-1 on the map side
    assert [r["a"] for r in keyed.first_per_key(df, ["k"], ["o"]).collect()] == [0]
    assert [r["a"] for r in keyed.last_per_key(df, ["k"], ["o"]).collect()] == [49 % 3]
