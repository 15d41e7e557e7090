"""Merging a snapshot into a keyed table.

Tables are immutable DataFrames: every merge returns the new table and
``write_version`` stores it under a new version folder, never over its input.
Canonical storage is flat (a header table plus one child table per array), so
"set the array", "push", "add to set" and "reset" are all row-set operations.
"""
from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reqtrail.operators.keyed import ColLike, hashed, last_per_key, order_key
from reqtrail.session import materialize

SRC = "_src_present"


def _not_null(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def _prefixed(source: DataFrame, keys: Sequence[str], cols: Sequence[str], prefix: str) -> DataFrame:
    return source.select(*keys, *[F.col(c).alias(prefix + c) for c in cols]).withColumn(SRC, F.lit(True))


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], set_cols: Sequence[str]) -> DataFrame:
    """Field-level upsert.

    Matched keys get the listed fields from the source (a source NULL overwrites),
    other fields survive; source-only keys are inserted with only the listed
    fields; target-only keys are kept. ``source`` must hold one row per key
    (reduce it with ``first_per_key``/``last_per_key``); NULL keys are dropped (D19).
    """
    keys, set_cols = list(keys), list(set_cols)
    s = _prefixed(source.where(_not_null(keys)), keys, set_cols, "_s_")
    j = target.join(s, keys, "full_outer")
    present = F.coalesce(F.col(SRC), F.lit(False))
    out = list(keys)
    for c in target.columns:
        if c in keys:
            continue
        if c in set_cols:
            out.append(F.when(present, F.col("_s_" + c)).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    out += [F.col("_s_" + c).alias(c) for c in set_cols if c not in target.columns]
    return j.select(*out)


def update_only(target: DataFrame, source: DataFrame, keys: Sequence[str], set_cols: Sequence[str],
                order: Sequence[ColLike] | None = None) -> DataFrame:
    """Like ``upsert`` but source keys without a target row are ignored.

    With ``order`` the source is first reduced to its last row per key (repeated
    updates: the last one wins); otherwise it must already be unique per key.
    """
    keys, set_cols = list(keys), list(set_cols)
    src = source.where(_not_null(keys))
    if order is not None:
        src = last_per_key(src, keys, order, cols=set_cols)
    s = _prefixed(src, keys, set_cols, "_s_")
    j = target.join(s, keys, "left")
    present = F.coalesce(F.col(SRC), F.lit(False))
    out = [F.col(k) for k in keys]
    for c in target.columns:
        if c in keys:
            continue
        out.append(F.when(present, F.col("_s_" + c)).otherwise(F.col(c)).alias(c) if c in set_cols else F.col(c))
    out += [F.col("_s_" + c).alias(c) for c in set_cols if c not in target.columns]
    return j.select(*out)


def unmatched(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows an update-only merge would silently drop (also NULL keys)."""
    keys = list(keys)
    with_keys = source.where(_not_null(keys))
    return with_keys.join(target.select(*keys), keys, "left_anti").unionByName(source.where(~_not_null(keys)))


def replace_all(snapshot: DataFrame, keys: Sequence[str] | None = None,
                order: Sequence[ColLike] | None = None) -> DataFrame:
    """K3 (+A4): the new table is the snapshot; with ``keys`` the last row per key wins."""
    if keys:
        return last_per_key(snapshot.where(_not_null(keys)), keys, order or [])
    return snapshot


def append(table: DataFrame, rows: DataFrame) -> DataFrame:
    """K4: insert every row, no key, no dedup."""
    return table.unionByName(rows, allowMissingColumns=True)


def dedup_children(rows: DataFrame, keys: Sequence[str], fields: Sequence[str], order: str) -> DataFrame:
    """A2/K6: add-to-set. Equal elements (NULL=NULL, NaN=NaN) keep the first occurrence."""
    return rows.groupBy(*keys, *fields).agg(F.min(order).alias(order)).select(*rows.columns)


def replace_children(children: DataFrame, new_rows: DataFrame, keys: Sequence[str],
                     parent: DataFrame | None = None, dedup_fields: Sequence[str] | None = None,
                     order: str | None = None, once: bool = False) -> DataFrame:
    """K7 + K5/K6: children of keys in the snapshot are replaced, others untouched.

    ``parent`` given = update-only (K2): snapshot keys without a parent row are
    ignored. ``dedup_fields`` given = add-to-set inside the snapshot (K6).
    The snapshot is read twice (its keys, its rows); ``once`` writes it to the shared
    folder first, for a snapshot that is costly to compute. Wide rows stream past hashed
    keys and are not sorted for the joins; AQE may divide a hot key's rows.
    """
    keys = list(keys)
    rows = materialize(new_rows, "snapshot") if once else new_rows
    rows = rows.where(_not_null(keys))
    if parent is not None:
        rows = rows.join(hashed(parent.select(*keys)), keys, "left_semi")
    if dedup_fields is not None:
        rows = dedup_children(rows, keys, dedup_fields, order)
    kept = children.join(hashed(rows.select(*keys)), keys, "left_anti")  # needs no distinct keys
    return kept.unionByName(rows, allowMissingColumns=True)


def reset_and_set(target: DataFrame, source: DataFrame, keys: Sequence[str], col: str,
                  order: Sequence[ColLike], default: object = 0) -> DataFrame:
    """K8+K2 in one pass: every row gets ``default`` unless the source sets it (last row wins)."""
    keys = list(keys)
    src = last_per_key(source.where(_not_null(keys)), keys, order, cols=[col])
    s = _prefixed(src, keys, [col], "_s_")
    j = target.join(s, keys, "left")
    value = F.when(F.col(SRC), F.col("_s_" + col)).otherwise(F.lit(default).cast(target.schema[col].dataType)
                                                             if col in target.columns else F.lit(default))
    out = [F.col(c) for c in target.columns if c != col] + [value.alias(col)]
    return j.select(*out)


def stamp(control: DataFrame, names: Iterable[str], as_of: dt.datetime | Column | None = None,
          name_col: str = "dbname", time_col: str = "last_updated_time") -> DataFrame:
    """Set the load time of existing dataset names; unknown names are not inserted."""
    if as_of is None:
        when = F.current_timestamp()
    elif isinstance(as_of, Column):
        when = as_of
    else:
        when = F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f"))
    dtype = control.schema[time_col].dataType
    hit = F.col(name_col).isin(list(names))
    return control.withColumn(time_col, F.when(hit, when.cast(dtype)).otherwise(F.col(time_col)))


def write_version(df: DataFrame, base: str, table: str, partition_by: Sequence[str] | None = None) -> str:
    """K3 storage: write a new immutable version folder and return its path.

    Readers keep using the previous version until they are pointed at the new one,
    so nobody sees an empty table while it is rebuilt (D24), and a failed job leaves
    the old version intact. The folder name is unique, so retries never collide.
    """
    stamp_ = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S")
    path = f"{base.rstrip('/')}/{table}/v={stamp_}-{uuid.uuid4().hex[:8]}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def fan_out(df: DataFrame, bases: Sequence[str], table: str) -> list[str]:
    """Compute once, write the same table to several targets (dev, prod).

    The first target is written from the plan; the others copy that written
    version, so nothing is recomputed or held in executor memory.
    """
    first = write_version(df, bases[0], table)
    copy = df.sparkSession.read.parquet(first)
    return [first] + [write_version(copy, b, table) for b in bases[1:]]


__all__ = ["upsert", "update_only", "unmatched", "replace_all", "append", "dedup_children",
           "replace_children", "reset_and_set", "stamp", "write_version", "fan_out", "order_key"]
