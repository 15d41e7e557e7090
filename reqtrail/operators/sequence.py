"""Ordered analytics inside groups that may be hot (position, previous row, next row).

A window ``partitionBy(key)`` sorts a whole group in one task: a key holding a
third of the rows becomes a third of the job in one task. Here rows are
range-partitioned on (key, order) first, so Spark's range partitioner cuts a hot
key into many ranges:

1. ``repartitionByRange(key, order)``, each row tagged with its range (``_part``), written
   once to the shared folder. Every later step sees the same ranges, also after
   a lost executor (a range partitioner that runs again may choose other bounds).
2. Built-in ``row_number`` / ``lag`` / ``lead`` over ``partitionBy("_part")`` and
   ``partitionBy("_part", *keys)``: one shuffle; no window is larger than one range.
3. Only groups that touch a range border are stitched: at most two rows for each range,
   in a window over their key, give the offset of a group that began earlier and its
   neighbours across the border. They are joined back by range; Spark chooses the
   join by their size.

The result equals ``row_number`` / ``lag`` / ``lead`` over
``Window.partitionBy(keys).orderBy(order)`` (order: NULLs last, ties must not
exist in ``order``). No Python runs, so every type keeps its exact values.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reqtrail.operators.keyed import ColLike, order_key
from reqtrail.session import materialize


def sequence_groups(df: DataFrame, keys: Sequence[str], order: Sequence[ColLike], lag_cols: Sequence[str] = (),
                    lead_cols: Sequence[str] = (), rank_col: str = "_rank", partitions: int | None = None,
                    partition_col: str | None = None, count_cols: Sequence[str] = ()) -> DataFrame:
    """Add ``rank_col`` (1-based position in the group), ``_lag_<c>``, ``_lead_<c>`` and ``_count_<c>``.

    Equivalent to ``row_number``/``lag``/``lead`` over ``partitionBy(keys).orderBy(order)``, and to the running count of the rows
    so far where a column of ``count_cols`` is true, this one included: the position in one of several streams merged in one order.
    ``partition_col`` keeps the range each row was sequenced in, e.g. to see how a hot
    key was spread.
    """
    keys, lag_cols, lead_cols, count_cols = list(keys), list(lag_cols), list(lead_cols), list(count_cols)
    reserved = {"_o", "_rank", "_n", "_key", "_before", "_after", "_part", "_offset", "_first", "_last", rank_col}
    reserved |= {"_lag_" + c for c in lag_cols} | {"_lead_" + c for c in lead_cols}
    reserved |= {p + c for c in count_cols for p in ("_count_", "_total_", "_before_")}
    clash = reserved & set(df.columns)
    if clash:
        raise ValueError(f"sequence_groups: input already has reserved columns {sorted(clash)}")

    # Without an explicit count, AQE sizes the ranges from the data.
    ranged = df.withColumn("_o", order_key(order)).repartitionByRange(
        *([partitions] if partitions else []), *[F.col(k) for k in keys], F.col("_o"))
    local = materialize(ranged.withColumn("_part", F.spark_partition_id()), "sequence")

    key = F.struct(*[F.col(k) for k in keys])
    in_part = Window.partitionBy("_part").orderBy(*keys, "_o")
    in_group = Window.partitionBy("_part", *keys)
    ordered = in_group.orderBy("_o")
    local = local.withColumn("_key", key).withColumns({
        "_before": F.lag("_key").over(in_part), "_after": F.lead("_key").over(in_part),
        "_rank": F.row_number().over(ordered).cast("long"), "_n": F.count(F.lit(1)).over(in_group),
        **{"_count_" + c: F.count_if(c).over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)) for c in count_cols},
        **{"_total_" + c: F.count_if(c).over(in_group) for c in count_cols},
        **{"_lag_" + c: F.lag(c).over(ordered) for c in lag_cols},
        **{"_lead_" + c: F.lead(c).over(ordered) for c in lead_cols}})

    # The first and the last row of a range: what its border groups give to their neighbours.
    border = local.where(F.col("_before").isNull() | F.col("_after").isNull())
    groups = border.groupBy("_part", *keys).agg(
        F.max("_n").alias("_n"), *[F.max("_total_" + c).alias("_total_" + c) for c in count_cols], F.bool_or(F.col("_before").isNull()).alias("_first"),
        F.bool_or(F.col("_after").isNull()).alias("_last"),
        F.first(F.when(F.col("_before").isNull(), F.struct(F.lit(1), *lead_cols)), ignorenulls=True).alias("_head"),
        F.first(F.when(F.col("_after").isNull(), F.struct(F.lit(1), *lag_cols)), ignorenulls=True).alias("_tail"))
    across = Window.partitionBy(*keys).orderBy("_part")
    earlier = lambda c: F.coalesce(F.sum(c).over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = groups.select(
        "_part", "_first", "_last", earlier("_n").alias("_offset"), *[earlier("_total_" + c).alias("_before_" + c) for c in count_cols],
        F.lag("_tail").over(across).alias("_tail"), F.lead("_head").over(across).alias("_head"))
    fix = groups.groupBy("_part").agg(
        F.max(F.when(F.col("_first"), F.col("_offset"))).alias("_offset"),
        *[F.max(F.when(F.col("_first"), F.col("_before_" + c))).alias("_before_" + c) for c in count_cols],
        F.first(F.when(F.col("_first"), F.col("_tail")), ignorenulls=True).alias("_tail"),
        F.first(F.when(F.col("_last"), F.col("_head")), ignorenulls=True).alias("_head"))

    first_key = F.first("_key").over(in_part.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = local.withColumn("_in_first", F.col("_key").eqNullSafe(first_key))
    j = local.join(fix, "_part")
    cols = [F.col(c) for c in df.columns]
    cols.append((F.col("_rank") + F.when(F.col("_in_first"), F.col("_offset")).otherwise(F.lit(0))).alias(rank_col))
    for c in count_cols:
        cols.append((F.col("_count_" + c) + F.when(F.col("_in_first"), F.col("_before_" + c)).otherwise(F.lit(0))).alias("_count_" + c))
    for c in lag_cols:
        cols.append(F.when(F.col("_before").isNull() & F.col("_tail").isNotNull(), F.col("_tail")[c])
                    .otherwise(F.col("_lag_" + c)).alias("_lag_" + c))
    for c in lead_cols:
        cols.append(F.when(F.col("_after").isNull() & F.col("_head").isNotNull(), F.col("_head")[c])
                    .otherwise(F.col("_lead_" + c)).alias("_lead_" + c))
    if partition_col:
        cols.append(F.col("_part").alias(partition_col))
    return j.select(*cols)
