"""Language identification of spans: script ranges narrow the candidates, then Viterbi over the words.

Learned from labelled documents, counted in Spark: hashed character n-grams and whole words of each language, and how its
letters divide over scripts. A word's score for a language is the mean log-likelihood of its n-grams times its
n-grams' number over the orders; languages that hardly use the word's script are no candidates. Viterbi over a text's words, with a
penalty for each change of language, labels spans. The text's language is the one with most letters, the score its share
of them.

Counts are a table of 2^BINS bins for each language, whatever the size of the corpus.

Defined cases: ``und`` with score 0 for a null text, a text without letters, or if nothing was learned; a null label
teaches nothing; ties go to the language first in code-point order; texts of any length are read whole; repeated rows each
count and give a row; an empty table gives an empty result; other columns are not read.
"""
from __future__ import annotations

import io
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reqtrail.llm.common import SLICE_BYTES, mounted_path, offsets_of, shared_folder, slices, text_bytes, write_once

BINS, ORDERS = 16, (1, 2, 3)
PENALTY = 9.0  # of a change of language, in nats
LEAST_SHARE, NOT_CANDIDATE = 0.002, -40.0  # of a language's letters in a script; nats
WORDS = 400_000  # different words held by a worker
TOGETHER = 2048  # texts decoded side by side
#: First code points of script ranges, Latin first; what lies between is by the nearest start below.
SCRIPTS = [0x0000, 0x0370, 0x0400, 0x0530, 0x0590, 0x0600, 0x0700, 0x0900, 0x0980, 0x0A00, 0x0A80, 0x0B00, 0x0B80, 0x0C00, 0x0C80, 0x0D00,
           0x0D80, 0x0E00, 0x0E80, 0x0F00, 0x1000, 0x10A0, 0x1100, 0x1200, 0x1380, 0x1780, 0x1800, 0x1E00, 0x1F00, 0x2000, 0x3040, 0x30A0,
           0x3100, 0x3400, 0xA000, 0xAC00, 0xD7B0, 0xF900, 0xFB00, 0xFB50, 0xFE70, 0xFF00, 0x10000, 0x20000]
SAME = {27: 0, 28: 1, 39: 5, 40: 5, 41: 0, 31: 30, 37: 33, 43: 33}  # later ranges of a script already listed


def letters_only(chunk: bytes) -> str:
    return "".join(c if c.isalpha() else " " for c in chunk.decode("utf-8").lower()).strip()


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bins of the n-grams of many words, the number of the word of each, and every word's script and letters."""
    points = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le"), "<u4").astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    of = np.repeat(np.arange(len(words)), sizes)
    bins, word = [], []
    for k in ORDERS:
        n = len(points) - k + 1
        if n <= 0:
            continue
        key = np.full(n, k, np.uint64)
        for i in range(k):
            key = key * np.uint64(0x9E3779B97F4A7C15) + points[i:i + n]
        inside = of[:n] == of[k - 1:]
        bins.append(key[inside])
        word.append(of[:n][inside])
    place = np.arange(len(points)) - np.repeat(offsets_of(sizes)[:-1], sizes)
    with np.errstate(over="ignore"):
        whole = np.add.reduceat((points + np.uint64(7)) * (place.astype(np.uint64) * np.uint64(2) + np.uint64(1)) ** np.uint64(5), offsets_of(sizes)[:-1]) if len(words) else np.zeros(0, np.uint64)
    bins.append(whole * np.uint64(0x2545F4914F6CDD1D) + np.uint64(99))
    word.append(np.arange(len(words)))
    keys = np.concatenate(bins)
    keys ^= keys >> np.uint64(31)
    keys = (keys * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - BINS)
    script = np.searchsorted(SCRIPTS, points[offsets_of(sizes)[:-1] + 1], "right") - 1 if len(words) else np.zeros(0, np.int64)
    script = np.array([SAME.get(int(s), int(s)) for s in script], np.int64)
    return keys.astype(np.int64), np.concatenate(word), script, np.array([sum(map(str.isalpha, w)) for w in words], np.int64)


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> str:
    """Count labelled documents and write the model; returns its folder."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, chunks in held.items():
                total, scripts = np.zeros(1 << BINS, np.int64), np.zeros(len(SCRIPTS), np.int64)
                words: Counter[str] = Counter()
                for chunk, n in chunks.items():
                    for w in letters_only(chunk).split():
                        words[w] += n
                names, counts = list(words), np.array(list(words.values()), np.int64)
                for first in range(0, len(names), 50_000):
                    some = counts[first:first + 50_000]
                    bins, of, script, letters = grams(names[first:first + 50_000])
                    total += np.bincount(bins, some[of], 1 << BINS).astype(np.int64)
                    scripts += np.bincount(script, some * letters, len(SCRIPTS)).astype(np.int64)
                both = np.concatenate([total, scripts])
                seen = np.flatnonzero(both)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(seen), pa.string()), pa.array(seen.astype(np.int32)), pa.array(both[seen])], names=["lang", "bin", "n"])
            held.clear()

        for batch in slices(batches, 1):
            for lang, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
                held.setdefault(lang, Counter()).update(text.split())
            if sum(map(len, held.values())) > WORDS:
                yield from flush()
        yield from flush()

    slim = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    # at most 2^BINS rows and a few for each language
    rows = slim.mapInArrow(count, "lang string, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(rows["lang"].unique())
    table = np.zeros((len(langs), (1 << BINS) + len(SCRIPTS)))
    table[rows["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(np.int64), rows["bin"].to_numpy(np.int64)] = rows["n"].to_numpy()
    counts, scripts = table[:, :1 << BINS], table[:, 1 << BINS:]
    likely = np.log((counts + 0.5) / (counts.sum(1, keepdims=True) + 0.5 * (1 << BINS)))
    narrow = np.where(scripts >= LEAST_SHARE * np.maximum(scripts.sum(1, keepdims=True), 1), 0.0, NOT_CANDIDATE)
    narrow[:, (narrow < 0).all(0)] = 0.0  # a script that nothing was learned about narrows nothing
    folder = mounted_path(shared_folder(docs.sparkSession, "language-model"))
    out = io.BytesIO()
    np.savez(out, langs=np.array(langs, dtype=str), likely=likely.T.astype(np.float32), narrow=narrow.T.astype(np.float32))
    write_once(f"{folder}/model.npz", lambda f: f.write(out.getvalue()))
    return folder


class Scorer:
    """Scores of the white-space-free chunks a worker has seen, a row each."""

    def __init__(self, folder: str):
        with np.load(f"{folder}/model.npz") as model:
            self.langs, self.likely, self.narrow = model["langs"].tolist(), model["likely"], model["narrow"]
        self._clear()

    def _clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.scores = np.zeros((0, len(self.langs)), np.float32)
        self.letters = np.zeros(0, np.int64)

    def rows(self, texts: list[list[bytes]]) -> np.ndarray:
        if len(self.known) > WORDS:
            self._clear()
        new = list(set().union(*texts).difference(self.known))
        if new:
            words, of = [], []
            for i, chunk in enumerate(new):
                for w in letters_only(chunk).split():
                    words.append(w)
                    of.append(i)
            bins, word, script, letters = grams(words)
            of = np.array(of, np.int64)
            score = self.narrow[script]
            for k in range(len(self.langs)):
                score[:, k] += np.bincount(word, self.likely[bins, k], len(words)) / (len(ORDERS) + 1)
            rows = np.zeros((len(new), len(self.langs)), np.float32)
            np.add.at(rows, of, score)
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            self.scores = np.concatenate([self.scores, rows])
            self.letters = np.concatenate([self.letters, np.bincount(of, letters, len(new)).astype(np.int64)])
        get = self.known.__getitem__
        return np.fromiter((get(c) for t in texts for c in t), np.int64)


def viterbi(scores: np.ndarray, rows: np.ndarray, offsets: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of every word: texts side by side, longest first, one word of each at a time."""
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    start, sizes = offsets[:-1][order], lengths[order]
    active = np.searchsorted(-sizes, -np.arange(sizes[0] + 1 if len(sizes) else 1), "left")  # texts longer than t
    value = np.zeros((len(order), scores.shape[1]), np.float32)
    stays, jumps = [], []
    for t in range(len(active) - 1):
        a = active[t]
        now = scores[rows[start[:a] + t]]
        if t:
            v = value[:a]
            jump = v.argmax(1)
            switched = v[np.arange(a), jump][:, None] - np.float32(penalty)
            stay = v >= switched
            now += np.where(stay, v, switched)
            stays.append(stay)
            jumps.append(jump.astype(np.int16))
        value[:a] = now
    labels = np.zeros(len(rows), np.int64)
    state = value.argmax(1)
    for t in range(len(active) - 2, -1, -1):
        a = active[t]
        labels[start[:a] + t] = state[:a]
        if t:
            state[:a] = np.where(stays[t - 1][np.arange(a), state[:a]], state[:a], jumps[t - 1])
    return labels


@lru_cache(maxsize=1)
def load(folder: str) -> Scorer:
    return Scorer(folder)


def label(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", spans: bool = False, penalty: float = PENALTY) -> DataFrame:
    """(id, lang_pred, score) of every text; with ``spans`` also its spans (first word, end word, language)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = load(folder)
        names = [*scorer.langs, "und"]
        none = len(scorer.langs)
        for batch in slices(batches, 1, TOGETHER, 4 * SLICE_BYTES):
            texts = [t.split() for t in text_bytes(batch.column(1))]
            offsets = offsets_of([len(t) for t in texts])
            rows = scorer.rows(texts)
            labels = viterbi(scorer.scores, rows, offsets, penalty) if none and len(rows) else np.zeros(len(rows), np.int64)
            of = np.repeat(np.arange(len(texts)), np.diff(offsets))
            letters = scorer.letters[rows] if len(rows) else np.zeros(0, np.int64)
            shares = np.bincount(of * (none + 1) + labels, letters, len(texts) * (none + 1)).reshape(-1, none + 1)
            total = shares.sum(1)
            best = np.where((total > 0) & (none > 0), shares[:, :max(1, none)].argmax(1), none)
            score = np.where(best < none, shares[np.arange(len(texts)), np.minimum(best, max(0, none - 1))] / np.maximum(total, 1), 0.0)
            columns = [batch.column(0), pa.array([names[b] for b in best], pa.string()), pa.array(score)]
            if spans:
                found = []
                for a, b in zip(offsets, offsets[1:]):
                    cuts = [0, *(np.flatnonzero(np.diff(labels[a:b])) + 1).tolist(), b - a] if b > a else [0]
                    found.append([{"start": int(x), "end": int(y), "lang": names[labels[a + x] if none else 0]} for x, y in zip(cuts, cuts[1:])])
                columns.append(pa.array(found, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))))
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "lang_pred", "score", "spans"][:len(columns)])

    slim = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, f"{id_col} long, lang_pred string, score double" + ", spans array<struct<start:bigint,end:bigint,lang:string>>" * spans)


def languages(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from the documents for which ``held_out`` is false and label all."""
    return label(docs, learn(docs.where(~held_out), id_col, text_col, lang_col), id_col, text_col)
