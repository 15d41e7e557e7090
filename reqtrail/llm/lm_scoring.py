"""Language-model scoring of documents by words.

The model is a word bigram model with interpolated modified Kneser-Ney smoothing (``kneser_ney``); a symbol is 32 bits of
a word's XXH64. Words are lower-cased (ASCII letters) and each text ends with an end token. Exact counts of the training tokens, by
64-bit hash, give the base score (unigrams with one added) and say which tokens are known.

Defined cases: a null text is the empty text and has the end token alone; texts of any length are scored whole; repeated rows
each give a row and count each; without training documents every score rests on the uniform distribution; an
empty table gives an empty result; other columns are not read.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reqtrail.llm import kneser_ney as kn
from reqtrail.llm.common import offsets_of, slices, text_bytes

BEGIN, END = xxhash.xxh64_intdigest(b"\t"), xxhash.xxh64_intdigest(b"\n")  # no word has these letters
LOW = np.uint64(0xFFFFFFFF)


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all tokens, and the offsets of each text."""
    digest, end = xxhash.xxh64_digest, xxhash.xxh64_digest(b"\n")
    out = [b"".join([*map(digest, text.lower().split()), end]) for text in texts]
    return np.frombuffer(b"".join(out), ">u8").astype(np.uint64), offsets_of([len(x) // 8 for x in out])


def bigrams(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    before = np.empty_like(hashes)
    before[1:] = hashes[:-1]
    before[offsets[:-1]] = BEGIN
    return (before & LOW) << np.uint64(32) | hashes & LOW


def train(docs: DataFrame, text_col: str = "text") -> str:
    """Count all texts and write the model; returns its folder."""
    slim = docs.select(F.col(text_col).cast("string").alias("text"))
    shards, folder = kn.shards_for(slim, "text"), kn.new_folder(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = kn.Counter(shards)
        for batch in slices(batches, 0):
            hashes, offsets = tokens(text_bytes(batch.column(0)))
            held.add("g", bigrams(hashes, offsets))
            held.add("token", hashes)
            if held.size > 2 * kn.FLUSH:
                yield from held.flush()
        yield from held.flush()

    kn.build(slim.mapInArrow(count, kn.PART), folder, order=2, bits=32, shards=shards)
    return folder


def score(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = kn.load(folder)
        known = model.table("token")
        types, total = model.meta.get("token", (0, 0))
        for batch in slices(batches, 1):
            hashes, offsets = tokens(text_bytes(batch.column(1)))
            count = known.find(hashes)[:, 0]
            base = np.log10(count + 1.0) - np.log10(total + types + 1.0)
            starts = offsets[:-1]
            sums = [np.add.reduceat(x, starts) if len(starts) else x for x in (count > 0, base, model.log10(bigrams(hashes, offsets)))]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(np.diff(offsets)), pa.array(sums[0].astype(np.int64)), pa.array(np.full(batch.num_rows, total, np.int64)),
                pa.array(sums[1].astype(np.float64)), pa.array(sums[2].astype(np.float64))], names=[id_col, "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    slim = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, f"{id_col} long, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def lm_scores(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learn from the documents for which ``held_out`` is false and score all."""
    return score(docs, train(docs.where(~held_out), text_col), id_col, text_col)
