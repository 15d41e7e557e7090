"""Document fingerprints: threshold-scaled sketches of word shingles, by DataFrame expressions alone.

A sketch keeps every different shingle hash below a fixed fraction of the hash range, so sketches of very
unequal documents are comparable and the sketch of a union is the union of sketches. A text none of whose
hashes is below keeps its least one (unsigned), so that no text with words has an empty sketch. That one is not in the
sketches of texts with hashes below, so pairs with such a text are compared by all hashes of both.

Defined cases: a null text is the empty text; a text without words has an empty sketch (fingerprint ""); fewer
words than a shingle make one shingle; two empty sketches are alike (1.0), an empty one and another are not (0.0); texts of any length are
hashed whole; repeated rows each give a row and follow each other in order of their text; a null id comes first;
an only document is its own next one; an empty table gives an empty result; other columns are not read.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reqtrail.llm.common import words

WIDTH, FRACTION = 5, 1 / 8
BUCKET_ROWS, MOST_BUCKETS = 2000, 4096


def with_hashes(df: DataFrame, text_col: str, out: str, width: int = WIDTH) -> DataFrame:
    """Add the hashes of all shingles of a text, in order."""
    df = df.withColumn("_words", words(F.col(text_col)))
    at = F.sequence(F.lit(0), F.greatest(F.size("_words") - width, F.lit(0)))
    hashes = F.transform(at, lambda i: F.xxhash64(*(F.get("_words", i + j) for j in range(width))))
    return df.withColumn(out, F.when(F.size("_words") > 0, hashes).otherwise(F.array().cast("array<long>"))).drop("_words")


def is_below(h: Column, fraction: float = FRACTION) -> Column:
    return F.shiftrightunsigned(h, 1) < int(fraction * (1 << 63))


def unsigned_least(hashes: Column) -> Column:
    """An array of the least hash, unsigned like the threshold; empty of none."""
    flip = lambda h: h.bitwiseXOR(F.lit(-1 << 63))
    return F.when(F.size(hashes) > 0, F.array(flip(F.array_min(F.transform(hashes, flip))))).otherwise(F.array().cast("array<long>"))


def with_sketch(df: DataFrame, text_col: str, out: str, width: int = WIDTH, fraction: float = FRACTION) -> DataFrame:
    """Add the sketch of a text as a sorted array of hashes."""
    df = with_hashes(df, text_col, "_hashes", width)
    df = df.withColumn("_below", F.filter("_hashes", lambda h: is_below(h, fraction)))
    least = unsigned_least(F.col("_hashes"))
    return df.withColumn(out, F.when(F.size("_below") > 0, F.array_sort(F.array_distinct("_below"))).otherwise(least)).drop("_hashes", "_below")


def merge(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """The sketch of two documents together, from their sketches."""
    both = F.array_sort(F.array_union(a, b))
    below = F.filter(both, lambda h: is_below(h, fraction))
    return F.when(F.size(below) > 0, below).otherwise(unsigned_least(both))


def fingerprint(sketch: Column) -> Column:
    """The sketch as text: 16 hex digits a hash, in order."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def shared(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def containment(a: Column, b: Column) -> Column:
    """The share of the smaller document's shingles that the other has."""
    least = F.least(F.size(a), F.size(b))
    return F.when(least > 0, shared(a, b) / least).otherwise((F.size(a) == F.size(b)).cast("double"))


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(a) + F.size(b) - shared(a, b)
    return F.when(union > 0, shared(a, b) / union).otherwise(F.lit(1.0))


def with_compared(df: DataFrame, pairs: list[tuple[str, str, str, str, str]], width: int = WIDTH, fraction: float = FRACTION) -> DataFrame:
    """Add ``near_<name>`` (containment) and ``jaccard_<name>`` for each (name, text, sketch, other text, other sketch).

    By the sketches where both have hashes below the threshold or one has none at all, else by all hashes of both texts.
    """
    only_least = lambda c: (F.size(c) == 1) & ~is_below(F.get(c, 0), fraction)
    for name, text, sketch, other_text, other in pairs:
        whole = (only_least(F.col(sketch)) | only_least(F.col(other))) & (F.size(sketch) > 0) & (F.size(other) > 0)
        for c, t in (("_a", text), ("_b", other_text)):  # no text, so no hashes, where the sketches do
            df = with_hashes(df.withColumn("_t", F.when(whole, F.col(t)).otherwise(F.lit(""))), "_t", c, width)
        a, b = (F.when(whole, F.array_distinct(c)).otherwise(F.col(s)) for c, s in (("_a", sketch), ("_b", other)))
        df = df.withColumn("_a", a).withColumn("_b", b)
        df = df.withColumns({f"near_{name}": containment(F.col("_a"), F.col("_b")), f"jaccard_{name}": jaccard(F.col("_a"), F.col("_b"))}).drop("_a", "_b", "_t")
    return df


def with_next(df: DataFrame, id_col: str, text_col: str, columns: list[str], rows: int = BUCKET_ROWS) -> DataFrame:
    """Add ``next_<column>`` of the next row in order of (id, text); after the last row comes the first.

    One shuffle: rows go to buckets of consecutive ids, whose first ids are quantiles of the id column. The rows of a
    bucket's first id are also guests at the end of the bucket before, and those of the first id at the end of the last.
    """
    n, least, missing = df.agg(F.count(F.lit(1)), F.min(id_col), F.count(F.when(F.col(id_col).isNull(), 1))).first()
    buckets = max(1, min(MOST_BUCKETS, n // rows))
    bounds = df.agg(F.percentile_approx(id_col, [i / buckets for i in range(1, buckets)], 100 * buckets)).first()[0] if buckets > 1 else None
    bounds = sorted({b for b in bounds or [] if missing or b > least})
    starts = F.array(*map(F.lit, bounds)).cast("array<long>")
    bucket = F.size(F.filter(starts, lambda b: b <= F.col(id_col))) if bounds else F.lit(0)
    first = F.col(id_col).isNull() if missing else F.col(id_col) == F.lit(least)
    df = df.withColumn("_bucket", bucket)
    place = lambda b, guest: F.struct(b.cast("int").alias("bucket"), F.lit(guest).alias("guest"))
    none = F.lit(None).cast("struct<bucket:int,guest:int>")
    guest = F.when(F.get(starts, F.col("_bucket") - 1) == F.col(id_col), place(F.col("_bucket") - 1, 1)) if bounds else none
    places = F.array(place(F.col("_bucket"), 0), guest, F.when(first, place(F.lit(len(bounds)), 2)).otherwise(none))
    df = df.withColumn("_place", F.explode(F.filter(places, lambda p: p.isNotNull())))
    df = df.withColumn("_bucket", F.col("_place.bucket")).withColumn("_guest", F.col("_place.guest")).drop("_place")
    order = W.partitionBy("_bucket").orderBy("_guest", id_col, text_col)
    df = df.withColumns({f"next_{c}": F.lead(c).over(order) for c in columns})
    return df.where("_guest = 0").drop("_bucket", "_guest")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, fraction: float = FRACTION) -> DataFrame:
    """(id, sketch) of every text."""
    slim = docs.select(F.col(id_col).cast("long").alias(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return with_sketch(slim, "text", "sketch", width, fraction).drop("text")


def fingerprints_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row its sketch, that of its text with the last half replaced by the next row's beginning, and the next row's; how alike they are."""
    slim = docs.select(F.col(id_col).cast("long").alias(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # the ids alone decide the buckets; sketches are made before the shuffle, an eighth of the size of their texts
    rows = with_next(with_sketch(slim, "text", "sketch"), id_col, "text", ["text", "sketch"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.select(id_col, n.cast("long").alias("n_chars"), "sketch", "next_sketch", "text", "next_text", edited.alias("edited"))
    rows = with_sketch(rows, "edited", "edited_sketch")
    rows = with_compared(rows, [("edited", "text", "sketch", "edited", "edited_sketch"), ("next", "text", "sketch", "next_text", "next_sketch")])
    return rows.drop("text", "next_text")
