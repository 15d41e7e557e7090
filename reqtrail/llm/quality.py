"""Quality rules by n-gram perplexity.

A character n-gram model (interpolated modified Kneser-Ney, ``kneser_ney``: counted in Spark, sorted hash arrays that the
workers memory-map) learns from every document that reads as prose by plain counts: not failed by the base rules
and with few symbols (else the model learns the symbols of junk, which then passes). There are two models, each of about half of the different
texts by a checksum, and a document is scored by the one that it, and its copies, are not in, so that no text speaks for itself.
Every document then gets its log perplexity per character, and each language a band around its median. Each side of it is as wide as ``WIDTH`` median deviations of the documents on that side, and at least ``LEAST`` of the
median, for labels of few documents; equal perplexities (copies) count once. Documents above or below the band of their language are rejected, as are those that fail the base rules.

Defined cases: a null text has no words and fails the base rules; null languages are a language of their own;
texts of any length are read whole; equal rows get equal verdicts; a half without any text to learn from gives
the other half's documents one perplexity; an empty table gives an empty result; other columns are not read.
"""
from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reqtrail.llm import kneser_ney as kn
from reqtrail.llm.common import materialize, offsets_of, schema, slices, text_bytes, whole_row

ORDER, BITS = 4, 16  # code points, and bits of each
LEAST_WORDS, MOST_REPEATED = 50, 50  # words; percent of words in repeated windows
MOST_SYMBOLS = 10  # percent of words, for the documents to learn from
FOLDS = 2
WIDTH, LEAST = 6.0, 0.1
BLANK = b"\x20\x09\x0a\x0b\x0c\x0d"
INSIDE = bytes(range(0x80, 0xC0))  # bytes that continue a code point
SYMBOLS = b"#*$%&|<>"
RULES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def rules(text: bytes) -> tuple[int, int, int, int, int]:
    """The counts named in RULES."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip(BLANK)]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        often, last = Counter(windows), -1
        for i, window in enumerate(windows):
            if often[window] > 1:
                repeated += i + 2 - max(last, i - 1)
                last = i + 2
    return (len(words), len(text.translate(None, BLANK + INSIDE)), len(text) - len(text.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)), repeated)


def base_failed(counts: tuple[int, int, int, int, int]) -> bool:
    return counts[0] < LEAST_WORDS or 100 * counts[4] > MOST_REPEATED * counts[0]


def is_prose(counts: tuple[int, int, int, int, int]) -> bool:
    return not base_failed(counts) and 100 * counts[2] <= MOST_SYMBOLS * counts[0]


def fold_of(text: bytes) -> int:
    return zlib.crc32(text) % FOLDS


def keys_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """n-gram keys of all code points and an end of each text, and the offsets of each text. Digits count as 0."""
    decoded = [t.decode("utf-8") for t in texts]
    points = np.frombuffer("".join(["\1" * (ORDER - 1) + t + "\2" for t in decoded]).encode("utf-32-le"), "<u4").astype(np.uint64)
    points = np.where((points >= 48) & (points <= 57), np.uint64(48), points & np.uint64((1 << BITS) - 1))
    sizes = np.array([len(t) + 1 for t in decoded], np.int64)
    keys = np.zeros(max(0, len(points) - ORDER + 1), np.uint64)
    for i in range(ORDER):
        keys = keys << np.uint64(BITS) | points[i:i + len(keys)]
    starts = offsets_of(sizes + ORDER - 1)[:-1]
    keep = np.ones(len(keys), bool)
    for i in range(1, ORDER):  # windows that begin in the text before
        keep[starts[1:] - i] = False
    return keys[keep], offsets_of(sizes)


def train(docs: DataFrame, text_col: str = "text") -> list[str]:
    """Count the documents that read as prose and write a model of each fold; returns their folders."""
    slim = docs.select(F.col(text_col).cast("string").alias("text"))
    shards = 1 + kn.shards_for(slim, "text") // 16  # few different keys

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [[] for _ in range(FOLDS)], [0] * FOLDS
        for batch in slices(batches, 0):
            texts = [t for t in text_bytes(batch.column(0)) if is_prose(rules(t))]
            for fold in range(FOLDS):
                some = [t for t in texts if fold_of(t) == fold]
                if some:
                    codes, keys = pd.factorize(keys_of(some)[0])
                    held[fold].append((keys, np.bincount(codes).reshape(-1, 1)))
                    size[fold] += len(keys)
                if size[fold] > kn.FLUSH // FOLDS:
                    held[fold], size[fold] = [kn.merged(held[fold])], 0
                    if len(held[fold][0][0]) > kn.FLUSH // FOLDS:
                        yield sent(fold, *held[fold].pop())
        for fold in range(FOLDS):
            if held[fold]:
                yield sent(fold, *kn.merged(held[fold]))

    def sent(fold: int, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return kn.rows_of([(kind, fold * shards + shard, packed) for kind, shard, packed in kn.dealt("g", keys, counts, shards)])

    parts, folders = materialize(slim.mapInArrow(count, kn.PART), "ngrams-by-fold"), []
    for fold in range(FOLDS):
        own = parts.where(F.col("shard").between(fold * shards, (fold + 1) * shards - 1))
        folders.append(kn.new_folder(docs.sparkSession))
        kn.build(own.withColumn("shard", F.col("shard") - fold * shards), folders[-1], ORDER, BITS, shards)
    return folders


def measure(docs: DataFrame, folders: list[str], id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
            carry: bool = False) -> DataFrame:
    """(id, language, the counts of RULES, base_failed, log10 perplexity per character) of every row; ``carry``: and the row."""

    out = schema(f"{id_col} long, _lang string, " + ", ".join(f"{r} long" for r in RULES) + ", base_failed boolean, perplexity double",
                 docs.schema if carry else None)
    names = docs.columns  # a carried row crosses to the workers once and gives the other columns there

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = [kn.load(f) for f in folders]
        for batch in slices((with_text(b) for b in batches), 0):
            texts = text_bytes(batch.column(0))
            counts = [rules(t) for t in texts]
            sums = perplexities(texts, models)
            ids, langs = (batch.column(1), batch.column(2))
            yield pa.RecordBatch.from_arrays([
                ids, langs, *(pa.array(c, pa.int64()) for c in zip(*counts)), pa.array(map(base_failed, counts), pa.bool_()),
                pa.array(sums), *batch.columns[3:]], names=out.names)

    def with_text(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not carry:
            return batch
        row = batch.column(0)
        field = lambda name, kind: row.field(names.index(name)).cast(kind)
        return pa.RecordBatch.from_arrays([field(text_col, pa.string()), field(id_col, pa.int64()), field(lang_col, pa.string()), row], names=["t", "i", "l", "r"])

    slim = docs.select(whole_row(docs).alias("_carried")) if carry else docs.select(
        F.col(text_col).cast("string").alias("_text"), F.col(id_col).cast("long").alias(id_col), F.col(lang_col).cast("string").alias("_lang"))
    return slim.mapInArrow(run, out)


def perplexities(texts: list[bytes], models: list[kn.Model]) -> np.ndarray:
    """Mean -log10 probability of each text's code points and end, by the model of the next fold."""
    out, folds = np.zeros(len(texts)), np.array([fold_of(t) for t in texts], np.int64)
    for fold in np.unique(folds).tolist():
        some = np.flatnonzero(folds == fold)
        keys, offsets = keys_of([texts[i] for i in some.tolist()])
        codes, different = pd.factorize(keys)
        out[some] = -np.add.reduceat(models[(fold + 1) % FOLDS].log10(different)[codes], offsets[:-1]) / np.diff(offsets)
    return out


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", carry: bool = False,
            width: float = WIDTH, least: float = LEAST) -> DataFrame:
    """(id, counts, base_failed, perplexity, kept) of every row; with ``carry`` the row itself as ``_carried``."""
    measured = materialize(measure(docs, train(docs, text_col), id_col, text_col, lang_col, carry), "perplexities")
    judged = measured.where(~F.col("base_failed"))
    judged = judged.select("_lang", "perplexity").distinct()
    middle = judged.groupBy("_lang").agg(F.percentile_approx("perplexity", 0.5, 10_000).alias("_middle"))

    def with_(a: DataFrame, b: DataFrame) -> DataFrame:  # a row for each language: Spark broadcasts it by its size
        b = b.withColumnRenamed("_lang", "_l")
        return a.join(b, F.col("_lang").eqNullSafe(F.col("_l")), "left").drop("_l")

    off = F.col("perplexity") - F.col("_middle")
    spread = with_(judged, middle).groupBy("_lang").agg(F.first("_middle").alias("_middle"), *(
        F.percentile_approx(F.when(sign * off >= 0, sign * off), 0.5, 10_000).alias(name) for sign, name in ((-1, "_below"), (1, "_above"))))
    # a row for each language, written so that its size is known when the join with the texts is planned
    spread = materialize(spread, "perplexity-bands")
    wide = lambda side: F.greatest(width * 1.4826 * F.col(side), least * F.col("_middle"))
    within = (off >= -wide("_below")) & (off <= wide("_above"))
    return with_(measured, spread).withColumn("kept", ~F.col("base_failed") & F.coalesce(within, F.lit(True))).drop("_middle", "_below", "_above", "_lang")
