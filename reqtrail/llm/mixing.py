"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by exact length per source. A source takes all its documents as often as its target holds them whole;
what is left of the target is a budget for one more copy of some documents. A proportional share of every
length goes first, and a bounded-knapsack dynamic programme over the lengths fills what remains as exactly as
lengths allow. The documents of a length are those with the smallest seeded hashes.

Defined cases: a null text has size 0 and is never taken; a null source is a source of its own, the last
one; rows of one id are chosen by their texts, or by all their columns where whole rows are mixed, so reruns agree; equal rows are
ordered among themselves at random but give equal rows; an empty table gives an empty result; if all sizes are 0 all targets are 0; other columns are not read.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reqtrail.llm.common import WORD, materialize, numbered

WEIGHTS = (5, 2, 1)
SHARE, LIMIT = 1.5, 2  # of all sizes; of a source's and a document's size
PROGRAMME = 1 << 17  # words that the dynamic programme fits
BUCKET_ROWS = 512


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """(source, source_size, target) from (source, size, n): a row per source.

    A target is weight times a common level, or the source's limit if that is less; the level is where all targets make
    the share. Over sources in ascending order of limit over weight, the first whose own level is within its limit sets it.
    """
    per = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("most", F.col("source_size") * limit)
    order = W.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    whole = W.partitionBy()
    level = (F.sum("source_size").over(whole) * share - F.coalesce(F.sum("most").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))) \
        / F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
    per = per.withColumn("level", level).withColumn("place", F.row_number().over(order))
    fits = F.when(F.col("level") * F.col("weight") <= F.col("most"), F.struct("place", "level"))
    per = per.withColumn("level", F.coalesce(F.min(fits).over(whole)["level"], F.lit(0.0)))
    return per.select("source", "source_size", F.least(F.col("most").cast("double"), F.col("weight") * F.col("level")).alias("target"))


def fit_programme(budget: int, lengths: list[int], counts: list[int]) -> dict[int, int]:
    """How many of each length make the largest sum within the budget: bounded knapsack over reachable sums.

    Sums are the bits of one integer. For each sum the length that first reached it is kept, from which the choice is read back.
    """
    by = np.zeros(budget + 1, np.int64)
    reached, mask = 1, (1 << (budget + 1)) - 1
    for length, count in sorted(zip(lengths, counts)):
        new = 1 if not length else reached
        for _ in range(min(count, budget // length) if length else 0):
            new = (new << length) & mask & ~reached
            if not new:
                break
            bits = np.unpackbits(np.frombuffer(new.to_bytes(budget // 8 + 1, "little"), np.uint8), bitorder="little")
            by[np.flatnonzero(bits)] = length
            reached |= new
        if reached >> budget:
            break
    best, out = reached.bit_length() - 1, {}
    while best:
        length = int(by[best])
        out[length] = out.get(length, 0) + 1
        best -= length
    return out


def fill(sizes: np.ndarray, counts: np.ndarray, extra: np.ndarray, left: int) -> tuple[np.ndarray, int]:
    """One more document of some sizes, so that little of the budget is left: the longest first, down to what the programme fits."""
    extra = extra.copy()
    for i in np.argsort(-sizes, kind="stable"):
        if left <= PROGRAMME:
            break
        more = min(int(counts[i] - extra[i]), max(0, left - PROGRAMME // 2) // max(1, int(sizes[i])))
        extra[i] += more
        left -= more * int(sizes[i])
    open_ = np.flatnonzero((sizes > 0) & (extra < counts) & (sizes <= left))
    if left > PROGRAMME:  # any other open size is above left - PROGRAMME / 2: one document fits, the longest
        chosen = {int(sizes[open_].max()): 1} if len(open_) else {}
    else:
        chosen = fit_programme(max(0, left), sizes[open_].tolist(), (counts - extra)[open_].tolist())
    place = {int(sizes[i]): i for i in open_}
    for size, n in chosen.items():
        extra[place[size]] += n
        left -= n * size
    return extra, left


def fill_long(sizes: np.ndarray, counts: np.ndarray, extra: np.ndarray, left: int) -> tuple[np.ndarray, int]:
    """The same with the long documents chosen together and first: a programme in units of words, their sizes rounded up, so that
    they fit. The short ones share what these leave in proportion to their numbers."""
    extra, short = extra.copy(), sizes <= PROGRAMME // 2
    left += int((extra * sizes)[short].sum())
    extra[short] = 0
    unit = -(-left // (8 * PROGRAMME))
    open_: dict[int, list[int]] = {}
    for i in np.argsort(-sizes, kind="stable"):
        if PROGRAMME // 2 < sizes[i] <= left and extra[i] < counts[i]:
            open_.setdefault(-(-int(sizes[i]) // unit), []).append(int(i))
    units = list(open_)
    for length, n in fit_programme(left // unit, units, [int((counts - extra)[open_[u]].sum()) for u in units]).items():
        for i in open_[length]:
            more = min(n, int(counts[i] - extra[i]))
            extra[i] += more
            n -= more
            left -= more * int(sizes[i])
    total = int((sizes * counts)[short].sum())
    if left > PROGRAMME and total:
        extra[short] = [min(n, n * (left - PROGRAMME // 2) // total) for n in counts[short].tolist()]
        left -= int((extra * sizes)[short].sum())
    return fill(sizes, counts, extra, left)


def fit(sizes: np.ndarray, counts: np.ndarray, target: float, limit: int = LIMIT) -> tuple[int, np.ndarray]:
    """Whole copies of every document, and how many documents of each size get one more."""
    total = int((sizes * counts).sum())
    extra = np.zeros(len(sizes), np.int64)
    if not total:
        return 0, extra
    whole = min(int(limit), int(target // total))
    budget = 0 if whole == limit else round(target - whole * total)
    if budget > PROGRAMME:
        extra = np.array([n * (budget - PROGRAMME // 2) // total for n in counts.tolist()], np.int64)
    left = budget - int((extra * sizes).sum())
    filled, rest = fill(sizes, counts, extra, left)
    if rest and sizes.max() > PROGRAMME // 2:  # documents in the way of each other
        other, less = fill_long(sizes, counts, extra, left)
        filled = other if less < rest else filled
    return whole, filled


def mix(docs: DataFrame, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, row_col: str | None = None, row_hash: str | None = None) -> DataFrame:
    """(id, size, source_size, target, copies, taken) of every document; ``row_col`` is carried along if given.

    Rows of one id, source and size are told apart by their texts, or by the hash of the row in ``row_hash``.
    """
    carried = [F.col(row_col).alias("_row")] if row_col else []
    content = F.col(row_hash) if row_hash else F.xxhash64(F.col(text_col))
    slim = materialize(docs.select(F.col(id_col).alias("_id"), F.col(source_col).cast("string").alias("source"),
                                   n_words(F.col(text_col)).alias("size"),
                                   F.xxhash64(F.lit(seed), F.col(id_col), content).alias("_hash"), *carried), "mix-sizes")
    sizes = materialize(slim.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-lengths")
    aims = targets(sizes, weights, share)

    def plan(group: pd.DataFrame) -> pd.DataFrame:
        whole, extra = fit(group["size"].to_numpy(), group["n"].to_numpy(), float(group["target"].iloc[0]))
        return group.assign(whole=whole, extra=extra)

    known = sizes.join(aims.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    plans = known.groupBy("source").applyInPandas(plan, known.schema.simpleString()[7:-1].replace(":", " ") + ", whole int, extra long")

    # documents of one length by seeded hash, divided by its first bits: a bucket is in, out, or cut by rank
    most = sizes.agg(F.max("n")).first()[0] or 0
    bits = max(0, int(np.ceil(np.log2(max(1, most / BUCKET_ROWS)))))
    slim = slim.withColumn("_bucket", F.expr(f"shiftrightunsigned(_hash, {64 - bits})") if bits else F.lit(0).cast("long"))
    buckets = slim.groupBy("source", "size", "_bucket").agg(F.count(F.lit(1)).alias("_in"))
    before = W.partitionBy("source", "size").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    buckets = buckets.withColumn("_before", F.coalesce(F.sum("_in").over(before), F.lit(0)))
    same = lambda a, b, names: [a[n].eqNullSafe(b[n]) for n in names]
    buckets = buckets.join(plans, same(buckets, plans, ["source", "size"])).select(
        buckets["source"], buckets["size"], "_bucket", "_before", "source_size", "target", "whole", "extra")
    rows = slim.join(buckets, same(slim, buckets, ["source", "size", "_bucket"])).drop(buckets["source"], buckets["size"], buckets["_bucket"])
    place = F.row_number().over(W.partitionBy("source", "size", "_bucket").orderBy("_hash", "_id"))
    copies = F.col("whole") + (F.col("_before") + place <= F.col("extra")).cast("int")
    return rows.withColumn("copies", copies).select(
        F.col("_id").alias(id_col), "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"),
        *([F.col("_row").alias(row_col)] if row_col else []))


def mixed(docs: DataFrame, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken."""
    rows = numbered(docs)
    hashed = [F.col("_carried").getField(f.name) for f in docs.schema if "map<" not in f.dataType.simpleString() and f.dataType.typeName() != "variant"]
    slim = rows.select("_row", *(F.col("_carried").getField(c).alias(c) for c in (id_col, text_col, source_col)),
                       F.xxhash64(*hashed).alias("_content"))
    copies = mix(slim, seed, id_col, text_col, source_col, weights, share, "_row", "_content").where("copies > 0").select("_row", "copies")
    return rows.join(copies, "_row").select("_carried", F.explode(F.sequence(F.lit(1), "copies"))).select("_carried.*")
