"""What changed between two snapshots of a table, by key.

Both forms read each snapshot once, reduce every row to hashes, and shuffle these by key after a partial
aggregation in the map tasks, so wide text columns stay where they are and a key with a third of all rows is small
before the shuffle. Comparisons are NULL-safe: NULL equals NULL, in keys as well, and differs from any value.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reqtrail.operators.keyed import ColLike, order_key

INSERTED, UPDATED, REMOVED, UNCHANGED = "inserted", "updated", "removed", "unchanged"


def _fingerprint(df: DataFrame, field: str) -> Column:
    """64 bits of one cell; NULL has its own, and so has a column that the snapshot lacks."""
    cell = F.col(field) if field in df.columns else F.lit(None).cast("string")
    return F.xxhash64(cell.isNull(), cell)


def _fields(old: DataFrame, new: DataFrame, keys: Sequence[str], fields: Sequence[str] | None) -> list[str]:
    if fields is not None:
        return list(fields)
    return [c for c in dict.fromkeys([*new.columns, *old.columns]) if c not in keys]


def change_set(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[ColLike],
               fields: Sequence[str] | None = None) -> DataFrame:
    """One row per key of either snapshot: keys, change, changed_fields, n_old, n_new.

    ``change`` is inserted, updated, removed or unchanged; ``changed_fields`` names the fields of an updated key, in the
    order of ``fields`` (default: all columns but the keys). A key that a snapshot repeats counts with its last
    row in ``order`` (A4), as a load would leave it; ``n_old`` and ``n_new`` tell how many rows it has.
    """
    keys, fields = list(keys), _fields(old, new, keys, fields)

    def side(df: DataFrame, is_new: bool) -> DataFrame:
        state = F.struct(order_key(order).alias("place"), F.array(*[_fingerprint(df, f) for f in fields]).alias("cells"))
        return df.select(*keys, F.lit(is_new).alias("_new"), state.alias("_state"))

    both = side(old, False).unionByName(side(new, True))
    last = both.groupBy(*keys).agg(
        F.count_if(~F.col("_new")).alias("n_old"), F.count_if("_new").alias("n_new"),
        F.max(F.when(~F.col("_new"), F.col("_state"))).getField("cells").alias("_before"),
        F.max(F.when(F.col("_new"), F.col("_state"))).getField("cells").alias("_after"))
    changed = F.array_compact(F.array(*[F.when(F.get("_before", F.lit(i)) != F.get("_after", F.lit(i)), F.lit(f)) for i, f in enumerate(fields)]))
    kind = (F.when(F.col("n_old") == 0, INSERTED).when(F.col("n_new") == 0, REMOVED)
             .when(F.size("_changed") > 0, UPDATED).otherwise(UNCHANGED))
    return (last.withColumn("_changed", F.coalesce(changed, F.array().cast("array<string>")))
                .select(*keys, kind.alias("change"), F.col("_changed").alias("changed_fields"), "n_old", "n_new"))


def changed_keys(old: DataFrame, new: DataFrame, keys: Sequence[str], fields: Sequence[str] | None = None) -> DataFrame:
    """The keys whose rows differ as a bag, in any order: child rows added, removed or altered.

    Old rows count -1, new rows +1. A key is unchanged if the signs and the signed row hashes both add up to 0, which map
    tasks add up for their own rows first.
    """
    keys, fields = list(keys), _fields(old, new, keys, fields)

    def side(df: DataFrame, sign: int) -> DataFrame:
        row = F.xxhash64(*[_fingerprint(df, f) for f in fields]).cast("decimal(20,0)")
        return df.select(*keys, F.lit(sign).alias("_sign"), (row * sign).cast("decimal(20,0)").alias("_row"))

    sums = side(old, -1).unionByName(side(new, 1)).groupBy(*keys).agg(F.sum("_sign").alias("_n"), F.sum("_row").alias("_rows"))
    return sums.where((F.col("_n") != 0) | (F.col("_rows") != 0)).select(*keys)


def only_changed(new: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of a snapshot that a merge has to apply: those of inserted and updated keys (NULL keys are not merged, D19)."""
    wanted = changes.where(F.col("change").isin(INSERTED, UPDATED)).select(*keys)
    return new.join(wanted, list(keys), "left_semi")


__all__ = ["change_set", "changed_keys", "only_changed", "INSERTED", "UPDATED", "REMOVED", "UNCHANGED"]
