"""Rows and flags chosen by a key and an explicit row order.

Spark rows have no order, so every "first"/"last" takes an ``order``: a list of
columns that is total within a key (decision D2). Each has a map-side step that
reduces a key holding a third of the data on every map task before the shuffle
(partial aggregation, or the partial WindowGroupLimit of a top-1 window).
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ColLike = str | Column

#: Reads of a report whose rows are reduced by key (``in_slices``). A map task sorts its part of a split in memory: wide rows of
#: a split of 128 MB (Spark's default) are over 2 GB, an eighth of them is less than a core's share of a usual executor.
SLICES = 8


def _col(c: ColLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def order_key(order: Sequence[ColLike]) -> Column:
    """One comparable struct for a multi-column ascending order, NULLs last."""
    fields = []
    for i, c in enumerate(order):
        col = _col(c)
        fields.append(col.isNull().alias(f"n{i}"))
        fields.append(col.alias(f"v{i}"))
    return F.struct(*fields)


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[ColLike], cols: Sequence[str] | None,
          last: bool) -> DataFrame:
    keys = list(keys)
    cols = [c for c in (cols or df.columns) if c not in keys]
    # Ascending with NULLs last; "last" is the exact reverse of that order.
    spec = [(_col(c).desc_nulls_first() if last else _col(c).asc_nulls_last()) for c in order]
    w = Window.partitionBy(*keys).orderBy(*spec)
    # ``row_number() == 1`` is planned with a partial WindowGroupLimit before the
    # shuffle: each map task keeps one row per key, so a hot key is reduced map-side
    # like a partial aggregation (tests/test_keyed_merge.py checks the plan).
    return (df.withColumn("_pick_rn", F.row_number().over(w))
              .where(F.col("_pick_rn") == 1)
              .select(*keys, *cols))


def in_slices(df: DataFrame, keys: Sequence[str], n: int = SLICES) -> DataFrame:
    """The same rows as the union of ``n`` reads of ``df``, each of the keys with one hash.

    For the wide rows of a report read from files, before ``first_per_key`` or ``last_per_key``: their map tasks sort the rows
    they read, and spill all of a large split. In slices a task sorts an n-th of its split. All rows of a key are in one slice,
    so a split gives no more rows to the shuffle than before. ``df`` is computed ``n`` times up to its filter by key, so it must
    be the same each time.
    """
    keys = list(keys)
    place = F.pmod(F.xxhash64(*keys), F.lit(n))
    return reduce(DataFrame.union, [df.where(place == i) for i in range(n)])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[ColLike],
                  cols: Sequence[str] | None = None) -> DataFrame:
    """A3: the first row of each key in ``order`` (header from its first line)."""
    return _pick(df, keys, order, cols, last=False)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[ColLike],
                 cols: Sequence[str] | None = None) -> DataFrame:
    """A4: the last row of each key in ``order`` (repeated overwrite: last one wins)."""
    return _pick(df, keys, order, cols, last=True)


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct non-NULL keys of a snapshot."""
    cond = None
    for k in keys:
        cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
    return df.select(*keys).where(cond).distinct()


def first_seen_flag(df: DataFrame, keys: Sequence[str], order: Sequence[ColLike],
                    name: str = "first_seen") -> DataFrame:
    """True on the first row of each key in ``order``.

    Built as "minimum order per key" (partial aggregation) joined back, instead of a
    window, so a hot key is never sorted in one task; NULL keys form one group.
    """
    keys = list(keys)
    tagged = df.withColumn("_ok", order_key(order))
    firsts = (tagged.groupBy(*keys).agg(F.min("_ok").alias("_first"))
                    .select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_first"))
    cond = None
    for k in keys:
        c = tagged[k].eqNullSafe(firsts[f"_k_{k}"])
        cond = c if cond is None else cond & c
    return (tagged.join(firsts, cond, "left")
                  .withColumn(name, F.col("_ok") == F.col("_first"))
                  .drop("_ok", "_first", *[f"_k_{k}" for k in keys]))


def repeated_flag(df: DataFrame, keys: Sequence[str], order: Sequence[ColLike],
                  name: str = "repeated") -> DataFrame:
    """True when an earlier row (in ``order``) has the same ``keys``."""
    out = first_seen_flag(df, keys, order, name="_fs")
    return out.withColumn(name, ~F.col("_fs")).drop("_fs")


def hashed(keys: DataFrame, many: bool = True) -> DataFrame:
    """The key side of a semi or anti join. ``many``: too many keys to broadcast; they are hashed by shuffle, and the rows that meet
    them stream past unsorted. Else Spark chooses, so few keys are broadcast and the rows stay where they are."""
    return keys.hint("shuffle_hash") if many else keys
