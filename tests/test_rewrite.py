"""Merges of touched files: same rows as the plain merges, and no other file is written."""
from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from reqtrail.operators import changes, merge, rewrite
from reqtrail.streaming.snapshots import TableStore

KEYS = ["k"]


def bag(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def table(spark, root, rows=400, name="t"):
    """Eight files of consecutive keys, two rows each."""
    df = spark.range(rows).select((F.col("id") / 2).cast("long").alias("k"), F.col("id").alias("n"), F.lit("old").alias("v"))
    path = f"{root}/{name}/v=0"
    df.repartitionByRange(8, "k").sortWithinPartitions("k").write.parquet(path)
    return rewrite.files_under(spark, path)


def headers(spark, root):
    df = spark.range(400).select(F.col("id").alias("k"), F.lit("old").alias("v"), (F.col("id") % 2).cast("double").alias("q"))
    df.repartitionByRange(8, "k").write.parquet(f"{root}/h/v=0")
    return rewrite.files_under(spark, f"{root}/h/v=0")


def stays(before, after, root):
    """Names, sizes and times of the files that both versions list."""
    both = set(before.files) & set(after.files)
    return both, {f: os.stat(f.removeprefix("file://")).st_mtime_ns for f in both}


@pytest.mark.parametrize("form", ["upsert", "update_only"])
def test_headers_touch_the_files_of_their_keys(spark, tmp_path, form):
    first = headers(spark, tmp_path)
    source = spark.createDataFrame([(3, "new", "x"), (7, None, "y"), (None, "lost", "z"), (1000, "far", "w")], "k long, v string, extra string")
    plain = getattr(merge, form)(first.read(spark), source.where("k is not null"), KEYS, ["v", "extra"])
    made = getattr(rewrite, form)(spark, first, source, KEYS, ["v", "extra"])
    assert len(made.touched) == 1 and len(made.kept) == len(first.files) - 1
    times = {f: os.stat(f.removeprefix("file://")).st_mtime_ns for f in made.kept}
    after = rewrite.write_files(made, f"{tmp_path}/h/v=1")
    assert set(made.kept) < set(after.files) and not set(made.touched) & set(after.files)
    assert {f: os.stat(f.removeprefix("file://")).st_mtime_ns for f in made.kept} == times
    assert bag(after.read(spark)) == bag(plain)
    assert after.read(spark).where("k = 300").first()["extra"] is None  # a kept file without the new column


def test_children_of_one_key_in_two_files(spark, tmp_path):
    first = table(spark, tmp_path)
    extra = spark.createDataFrame([(5, 9000, "old")], "k long, n long, v string")
    second = rewrite.write_files(rewrite.Rewrite(first.files, (), extra, first.schema, ("k",)), f"{tmp_path}/t/v=extra")
    new = spark.createDataFrame([(5, 1, "new"), (5, 1, "new"), (None, 2, "lost")], "k long, n long, v string")
    made = rewrite.replace_children(spark, second, new, KEYS)
    assert len(made.touched) == 2
    after = rewrite.write_files(made, f"{tmp_path}/t/v=1")
    assert bag(after.read(spark)) == bag(merge.replace_children(second.read(spark), new, KEYS))
    assert after.read(spark).where("k = 5").count() == 2
    only = rewrite.replace_children(spark, second, new, KEYS, dedup_fields=["v"], order="n", parent=spark.createDataFrame([(6,)], "k long"))
    assert not only.touched and only.rows.count() == 0


def test_reset_leaves_files_that_hold_the_default(spark, tmp_path):
    df = spark.range(400).select(F.col("id").alias("k"), F.when(F.col("id") == 90, 4.0).when(F.col("id") == 390, None).otherwise(0.0).alias("q"))
    df.repartitionByRange(8, "k").write.parquet(f"{tmp_path}/b/v=0")
    first = rewrite.files_under(spark, f"{tmp_path}/b/v=0")
    source = spark.createDataFrame([(200, 7.0, 1), (200, 8.0, 2), (10, 0.0, 1), (None, 5.0, 1)], "k long, q double, o int")
    made = rewrite.reset_and_set(spark, first, source, KEYS, "q", ["o"], default=0.0)
    assert len(made.touched) == 3  # of keys 90, 200 and 390; key 10 is set to what it is
    after = rewrite.write_files(made, f"{tmp_path}/b/v=1")
    assert bag(after.read(spark)) == bag(merge.reset_and_set(first.read(spark), source, KEYS, "q", ["o"], 0.0))
    again = rewrite.reset_and_set(spark, after, source, KEYS, "q", ["o"], default=0.0)
    assert not again.touched


def test_empty_snapshot_and_empty_table(spark, tmp_path):
    first = headers(spark, tmp_path)
    none = spark.createDataFrame([], "k long, v string")
    assert not rewrite.upsert(spark, first, none, KEYS, ["v"]).touched
    empty = rewrite.FileSet((), first.schema)
    made = rewrite.upsert(spark, empty, spark.createDataFrame([(1, "a")], "k long, v string"), KEYS, ["v"])
    after = rewrite.write_files(made, f"{tmp_path}/h/v=2")
    assert [tuple(r) for r in after.read(spark).select("k", "v").collect()] == [(1, "a")]


def test_search_reads_keys_between_the_snapshots_ends(spark, tmp_path, capsys):
    first = headers(spark, tmp_path)
    source = spark.createDataFrame([(3, "a"), (20, "b")], "k long, v string")
    scan = first.read(spark).select("k", F.col("_metadata.file_path").alias(rewrite.FILE))
    rewrite._near(scan, source, "k").join(source.select("k"), ["k"], "left_semi").explain()
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(k,3)" in plan and "LessThanOrEqual(k,20)" in plan and "ReadSchema: struct<k:bigint>" in plan


def test_store_lists_kept_and_new_files(spark, tmp_path):
    store, first = TableStore(spark, str(tmp_path / "store")), headers(spark, tmp_path)
    assert store.commit({"h": first.read(spark)}, "load", 0)
    before = store.files("h")
    source = spark.createDataFrame([(3, "new")], "k long, v string")
    assert store.commit({"h": rewrite.upsert(spark, before, source, KEYS, ["v"])}, "one", 1)
    after = store.files("h")
    assert len(set(before.files) & set(after.files)) == len(before.files) - 1
    assert bag(store.current("h")) == bag(merge.upsert(first.read(spark), source, KEYS, ["v"]))
    assert store.commit({"h": rewrite.update_only(spark, after, source.withColumn("v", F.lit("third")), KEYS, ["v"])}, "two", 2)
    assert store.current("h").where("v = 'third'").count() == 1 and store.current("h").count() == 400


def test_change_set_feeds_a_merge(spark, tmp_path):
    """Only changed rows reach the merge, so a report that repeats yesterday's touches the file of its one change."""
    first = headers(spark, tmp_path)
    old = first.read(spark)
    new = old.withColumn("v", F.when(F.col("k") == 250, F.lit("changed")).otherwise(F.col("v")))
    found = changes.change_set(old, new, KEYS, ["v"], fields=["v", "q"])
    assert {(r["change"], tuple(r["changed_fields"])): r["count"] for r in found.groupBy("change", "changed_fields").count().collect()} == {
        ("unchanged", ()): 399, ("updated", ("v",)): 1}
    made = rewrite.upsert(spark, first, changes.only_changed(new, found, KEYS), KEYS, ["v", "q"])
    assert len(made.touched) == 1


def test_change_set_nulls_repeats_and_new_columns(spark):
    old = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, None, 1), (None, "n", 1), (4, "x", 1), (6, "s", 1)], "k int, v string, o int")
    new = spark.createDataFrame([(1, "b", 9, None), (2, "", 1, None), (None, "n", 1, "w"), (5, "y", 1, None), (6, "s", 1, None)], "k int, v string, o int, w string")
    got = {r["k"]: (r["change"], r["changed_fields"], r["n_old"], r["n_new"]) for r in changes.change_set(old, new, ["k"], ["o"], fields=["v", "w"]).collect()}
    assert got == {1: ("unchanged", [], 2, 1), 2: ("updated", ["v"], 1, 1), None: ("updated", ["w"], 1, 1),
                   4: ("removed", [], 1, 0), 5: ("inserted", [], 0, 1), 6: ("unchanged", [], 1, 1)}
    bags = changes.changed_keys(old, new.drop("w"), ["k"], fields=["v"])
    assert {r["k"] for r in bags.collect()} == {1, 2, 4, 5}


def test_change_set_is_one_shuffle_after_partial_sums(spark, capsys):
    old = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").cast("string").alias("v"), "id")
    changes.change_set(old, old, ["k"], ["id"], fields=["v"]).explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_max" in plan
