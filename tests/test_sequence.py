"""The skew-safe sequencer equals row_number/lag/lead windows, also when one key dominates."""
from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from reqtrail.operators.keyed import order_key
from reqtrail.operators.sequence import sequence_groups

SCHEMA = "k string, g int, o long, x double, s string"


def _data(seed: int, n: int = 3000):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        k = "hot" if rnd.random() < 0.4 else (None if rnd.random() < 0.05 else f"k{rnd.randint(0, 60)}")
        out.append((k, rnd.randint(0, 3), i, rnd.choice([None, 1.5, 2.5]), f"v{i}"))
    return out


def windows(df, keys, order, lag_cols=(), lead_cols=()):
    """The same by one plain window per group."""
    w = Window.partitionBy(*keys).orderBy(order_key(order))
    return df.withColumns({"_rank": F.row_number().over(w).cast("long"), **{"_lag_" + c: F.lag(c).over(w) for c in lag_cols},
                           **{"_lead_" + c: F.lead(c).over(w) for c in lead_cols}})


def bag(df, cols):
    return sorted(repr(tuple(r)) for r in df.select(*cols).collect())


@pytest.mark.parametrize("seed,parts", [(1, 7), (2, 16), (3, 1), (4, 40)])
def test_sequencer_matches_windows(spark, seed, parts):
    df = spark.createDataFrame(_data(seed), SCHEMA).repartition(5)
    args = dict(keys=["k", "g"], order=["o"], lag_cols=["x", "s"], lead_cols=["o", "s"])
    cols = ["k", "g", "o", "x", "s", "_rank", "_lag_x", "_lag_s", "_lead_o", "_lead_s"]
    assert bag(sequence_groups(df, partitions=parts, **args), cols) == bag(windows(df, **args), cols)


@pytest.mark.parametrize("parts", [1, 3, 9])
def test_small_groups_and_empty_tables(spark, parts):
    df = spark.createDataFrame([(f"k{i % 7}" if i % 5 else None, 0, i, None, None) for i in range(20)], SCHEMA)
    args = dict(keys=["k"], order=["o"], lag_cols=["o"], lead_cols=["o"])
    cols = ["k", "o", "_rank", "_lag_o", "_lead_o"]
    assert bag(sequence_groups(df, partitions=parts, **args), cols) == bag(windows(df, **args), cols)
    assert sequence_groups(df.where("o < 0"), partitions=parts, **args).count() == 0


def test_values_stay_exact(spark):
    """Integers above 2^53, open-ended and early dates, decimals and NaN come through unchanged."""
    day = [dt.datetime(9999, 12, 31), dt.datetime(1600, 1, 1), None, dt.datetime(2020, 2, 29, 1, 2, 3, 4)]
    rows = [("hot" if i % 3 else "b", i, 9007199254740993 + i, day[i % 4], float("nan") if i % 2 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, o long, v long, t timestamp_ntz, f double").withColumn("d", F.col("v").cast("decimal(38,4)"))
    args = dict(keys=["k"], order=["o"], lag_cols=["v", "t", "f", "d"], lead_cols=["v", "t", "f", "d"])
    cols = ["k", "o", "_rank"] + [p + c for p in ("_lag_", "_lead_") for c in ("v", "t", "f", "d")]
    assert bag(sequence_groups(df, partitions=6, **args), cols) == bag(windows(df, **args), cols)


def test_sequencer_inside_a_union(spark):
    """Range numbers must not depend on the stage the rows are consumed in."""
    df = spark.createDataFrame(_data(4, 800), SCHEMA).repartition(3)
    other = spark.createDataFrame([("z", 0, -1, None, "z")], SCHEMA)
    args = dict(keys=["k"], order=["o"], lag_cols=["s"], lead_cols=["o"])
    cols = ["k", "o", "_rank", "_lag_s", "_lead_o"]
    pad = windows(other, **args).select(*cols)
    got = pad.unionByName(sequence_groups(df, partitions=5, **args).select(*cols))
    assert bag(got, cols) == bag(pad.unionByName(windows(df, **args).select(*cols)), cols)


def test_reserved_column_names_are_refused(spark):
    df = spark.createDataFrame([("a", 1, 5)], "k string, o long, _rank long")
    with pytest.raises(ValueError):
        sequence_groups(df, ["k"], ["o"])


def test_plan_has_no_python_single_task_or_forced_broadcast(spark, capsys):
    df = spark.createDataFrame(_data(7, 300), SCHEMA)
    sequence_groups(df, ["k"], ["o"], lag_cols=["x"], lead_cols=["o"], partitions=5).explain("extended")
    plan = capsys.readouterr().out
    assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan
    assert "SinglePartition" not in plan and "ResolvedHint" not in plan and "strategy=broadcast" not in plan


def test_hot_key_is_spread_over_many_partitions(spark):
    """A key holding 40% of the rows is sequenced by several tasks, none holding most of it."""
    df = spark.createDataFrame(_data(6, 4000), SCHEMA)
    out = sequence_groups(df, ["k"], ["o"], lead_cols=["o"], partitions=8, partition_col="_p")
    hot = out.where("k = 'hot'").groupBy("_p").count().collect()
    sizes = sorted(r["count"] for r in hot)
    assert len(sizes) >= 3                              # the hot key spans several ranges
    assert max(sizes) < 0.6 * sum(sizes)                # no single task holds most of it
    ranks = sorted(r["_rank"] for r in out.where("k = 'hot'").collect())
    assert ranks == list(range(1, len(ranks) + 1))      # positions still continue across them


def test_running_counts_equal_the_plain_window(spark):
    """Positions inside two streams merged in one order, across the borders of ranges, for a key with most rows."""
    rows = [(1 if i % 5 else i % 3, i // 4, i, i % 3 == 0) for i in range(600)]
    df = spark.createDataFrame(rows, "k long, t long, o long, own boolean")
    got = sequence_groups(df, ["k"], ["t", "o"], count_cols=["own"], partitions=7, partition_col="part")
    plain = Window.partitionBy("k").orderBy("t", "o").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = df.withColumn("n", F.count_if("own").over(plain))
    assert {(r.o, r._count_own) for r in got.collect()} == {(r.o, r.n) for r in want.collect()}
    assert got.where("k = 1").select("part").distinct().count() > 2
