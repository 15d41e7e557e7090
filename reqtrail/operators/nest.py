"""A1, A2, K9: flat child rows <-> nested arrays.

Canonical storage is flat; arrays are built only for the document view, where a
document's array is bounded by that document's own child rows.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reqtrail.operators.keyed import ColLike, order_key
from reqtrail.operators.sequence import sequence_groups


def positions(df: DataFrame, keys: Sequence[str], order: Sequence[ColLike], name: str = "pos") -> DataFrame:
    """A1, flat form: the 0-based position of each child row inside its key (skew-safe)."""
    out = sequence_groups(df, keys, order, rank_col="_pos_rank")
    return out.withColumn(name, (F.col("_pos_rank") - 1).cast("int")).drop("_pos_rank")


def nest_lines(header: DataFrame, lines: DataFrame, keys: Sequence[str], order: Sequence[ColLike],
               fields: Sequence[str], as_name: str = "lines") -> DataFrame:
    """A1: one array of structs per key, in ``order``; keys without lines get ``[]``."""
    keys = list(keys)
    arr = (lines.groupBy(*keys)
                .agg(F.sort_array(F.collect_list(F.struct(order_key(order).alias("_o"),
                                                          *[F.col(f) for f in fields]))).alias("_a"))
                .select(*keys, F.transform("_a", lambda e: e.dropFields("_o")).alias(as_name)))
    arr_type = arr.schema[as_name].dataType
    out = header.join(arr, keys, "left")
    return out.withColumn(as_name, F.coalesce(F.col(as_name), F.array().cast(arr_type)))


def unnest_lines(docs: DataFrame, keys: Sequence[str], arr: str, pos: str = "pos") -> DataFrame:
    """Inverse of ``nest_lines``: one row per element with its 0-based position."""
    return (docs.select(*keys, F.posexplode(arr).alias(pos, "_e"))
                .select(*keys, F.col(pos).cast("int").alias(pos), "_e.*"))


def set_in_array(docs: DataFrame, links: DataFrame, keys: Sequence[str], arr: str, elem_key: str,
                 link_key: str, field: str, value_cols: Sequence[str],
                 partition_keys: Sequence[str] | None = None) -> DataFrame:
    """K9: on each document, set ``arr[*].field`` for every element whose ``elem_key`` has a link.

    ``links`` holds one row per (keys, link_key) (reduce it with ``last_per_key``);
    NULL keys never match. Elements without a link keep their current ``field``.
    ``partition_keys`` (a subset of ``keys`` that is unique per document, e.g. the
    document id) groups the links by those columns only, with the other keys inside
    the map key: documents that are already partitioned by them join without being
    shuffled again, and only the small link side moves.
    """
    keys = list(keys)
    part = list(partition_keys or keys)
    rest = [k for k in keys if k not in part]
    value = F.struct(*[F.col(c) for c in value_cols])
    map_key = F.struct(*[F.col(k).alias(k) for k in rest], F.col(link_key).alias("_lk"))
    notnull = F.lit(True)
    for k in keys + [link_key]:
        notnull = notnull & F.col(k).isNotNull()
    per_doc = (links.where(notnull)
                    .groupBy(*part)
                    .agg(F.map_from_entries(F.collect_list(F.struct(map_key, value))).alias("_m")))
    elem_type = docs.schema[arr].dataType.elementType
    val_type = per_doc.schema["_m"].dataType.valueType
    if field not in elem_type.fieldNames():
        docs = docs.withColumn(arr, F.transform(arr, lambda e: e.withField(field, F.lit(None).cast(val_type))))
    j = docs.join(per_doc, part, "left")

    def upd(e: Column) -> Column:
        hit = F.element_at(F.col("_m"), F.struct(*[F.col(k).alias(k) for k in rest], e[elem_key].alias("_lk")))
        return F.when(F.col("_m").isNotNull() & hit.isNotNull(), e.withField(field, hit)).otherwise(e)

    return j.withColumn(arr, F.transform(arr, upd)).drop("_m")
