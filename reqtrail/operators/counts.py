"""A6/A7 kept up to date: distinct counts under replacement, from a counted multiset.

How many requisitions a PO names cannot be kept as a number alone: when lines are replaced, whether a requisition is still named depends on
how often it was. The state is therefore one row per (PO, requisition) with the number of lines that hold the pair. A
replacement is a set of signed counts: minus what the state holds for the replaced POs, plus the pairs of the new lines.
The stored lines are never read; the state is as large as its distinct pairs, and only the pairs of touched POs change. ``many`` says that a
report touches many of the keys (see ``keyed.hashed``).
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reqtrail.operators.keyed import hashed
from reqtrail.operators.timeline import NULL_REQ_MODES, _n_req

N = "n_lines"


def pair_counts(lines: DataFrame, keys: Sequence[str], member: str) -> DataFrame:
    """The counted multiset of (keys, member): ``n_lines`` of each pair; a NULL member is a member, NULL keys are not counted."""
    known = lines
    for k in keys:
        known = known.where(F.col(k).isNotNull())
    return known.groupBy(*keys, member).agg(F.count(F.lit(1)).alias(N))


def replacement_deltas(state: DataFrame, new_lines: DataFrame, keys: Sequence[str], member: str, many: bool = False) -> DataFrame:
    """Signed counts that replace the lines of every key in ``new_lines`` (K7 + K5)."""
    plus = pair_counts(new_lines, keys, member)
    minus = state.join(hashed(plus.select(*keys).distinct(), many), list(keys), "left_semi")
    return plus.unionByName(minus.select(*keys, member, (-F.col(N)).alias(N)))


def removal_deltas(state: DataFrame, removed: DataFrame, keys: Sequence[str], member: str, many: bool = False) -> DataFrame:
    """Signed counts that take all lines of the keys in ``removed`` away."""
    gone = state.join(hashed(removed.select(*keys).distinct(), many), list(keys), "left_semi")
    return gone.select(*keys, member, (-F.col(N)).alias(N))


def apply_deltas(state: DataFrame, deltas: DataFrame, keys: Sequence[str], member: str) -> DataFrame:
    """The state after signed counts; pairs that come to nothing leave it. NULL members meet each other."""
    both = state.select(*keys, member, N).unionByName(deltas.select(*keys, member, N))
    return both.groupBy(*keys, member).agg(F.sum(N).cast("long").alias(N)).where(F.col(N) != 0)


def distinct_counts(state: DataFrame, keys: Sequence[str], member: str) -> DataFrame:
    """n_req_each, n_req_one and n_req_ignore of every key (the modes of D3), as ``timeline.req_counts_per_po`` gives them from lines."""
    counts = state.groupBy(*keys).agg(F.count_if(F.col(member).isNotNull()).alias("n_distinct"),
                                      F.coalesce(F.sum(F.when(F.col(member).isNull(), F.col(N))), F.lit(0)).alias("n_null"))
    return counts.select(*keys, *[_n_req(m).alias(f"n_req_{m}") for m in NULL_REQ_MODES])


def updated_counts(counts: DataFrame, state: DataFrame, deltas: DataFrame, keys: Sequence[str], member: str, many: bool = False) -> DataFrame:
    """``distinct_counts`` after the deltas, made anew for the keys that they name alone. ``state`` is the one after them."""
    touched = hashed(deltas.select(*keys).distinct(), many)
    fresh = distinct_counts(state.join(touched, list(keys), "left_semi"), keys, member)
    return counts.join(touched, list(keys), "left_anti").unionByName(fresh)


__all__ = ["pair_counts", "replacement_deltas", "removal_deltas", "apply_deltas", "distinct_counts", "updated_counts"]
