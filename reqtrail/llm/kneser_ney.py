"""Interpolated modified Kneser-Ney n-gram models: counted in Spark, kept as sorted hash arrays.

An n-gram is one 64-bit key: ``order`` symbols of ``bits`` bits each, the last symbol in the lowest bits. Map tasks
sort and count the keys of their texts and send them on packed, by shard (a hash of the key, so a very common
context is spread evenly); reduce tasks merge a shard into one sorted array. What the shorter orders need is sent
on in the same packed way: how many different n-grams end in each shorter one (continuation counts) and,
for each context, its total and the numbers of its followers seen once, twice, and more often.

Model folder (in the shared folder, mounted by all workers): for every order ``k`` and shard files ``g{k}-NNNNN.npy``
with the rows (key) and ``v{k}-NNNNN.npy`` (value), contexts ``c{k}``/``s{k}`` likewise, and ``model.json`` with shard counts,
discounts and the vocabulary size. Workers memory-map them and look keys up by binary search, so a
worker's own memory does not grow with the model.
"""
from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reqtrail.llm.common import materialize, mounted_path, shared_folder, write_once

FLUSH = 4_000_000  # different keys a map task holds before it sends them on
SHARD_BYTES = 40_000_000  # of text for each shard
PART = "kind string, shard int, packed binary"


def mixed(keys: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix, so that shards are even whatever the symbols are."""
    x = keys ^ (keys >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (mixed(keys) >> np.uint64(32)) % np.uint64(shards)


def pack(keys: np.ndarray, values: np.ndarray) -> bytes:
    """Sorted keys and their value columns, compressed: high halves as differences, byte planes together."""
    high = np.diff((keys >> np.uint64(32)).astype(np.uint32), prepend=np.uint32(0))
    columns = [high, keys.astype(np.uint32), *values.reshape(len(keys), -1).T.astype(np.uint32)]
    planes = [np.ascontiguousarray(np.ascontiguousarray(c).view(np.uint8).reshape(-1, 4).T) for c in columns]
    return np.array([len(keys), len(columns)], "<u4").tobytes() + zstandard.ZstdCompressor(level=1).compress(b"".join(p.tobytes() for p in planes))


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, width = np.frombuffer(data, "<u4", 2)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[8:]), np.uint8).reshape(width, 4, n)
    columns = [np.ascontiguousarray(p.T).view(np.uint32).reshape(-1) for p in planes]
    keys = np.cumsum(columns[0].astype(np.uint64)) << np.uint64(32) | columns[1]
    return keys, np.stack(columns[2:], 1).astype(np.int64)


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order, values summed per key."""
    keys, values = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(values, first, axis=0) if len(first) else values


def dealt(kind: str, keys: np.ndarray, values: np.ndarray, shards: int) -> Iterator[tuple[str, int, bytes]]:
    """Sorted keys as packed rows by shard."""
    of = shard_of(keys, shards)
    order = np.argsort(of, kind="stable")
    bounds = np.searchsorted(of[order], np.arange(shards + 1))
    for s in range(shards):
        some = order[bounds[s]:bounds[s + 1]]
        if len(some):
            yield kind, s, pack(keys[some], values[some])


def rows_of(parts) -> pa.RecordBatch:
    kinds, shards, packed = zip(*parts) if parts else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(shards, pa.int32()), pa.array(packed, pa.binary())], names=["kind", "shard", "packed"])


class Counter:
    """Counts of keys by kind, sent on when many are held."""

    def __init__(self, shards: int):
        self.shards, self.held, self.size = shards, {}, 0

    def add(self, kind: str, keys: np.ndarray) -> None:
        self.held.setdefault(kind, []).append(keys)
        self.size += len(keys)

    def flush(self) -> Iterator[pa.RecordBatch]:
        for kind, some in self.held.items():
            keys, counts = np.unique(np.concatenate(some), return_counts=True)
            for row in dealt(kind, keys, counts.astype(np.int64), self.shards):
                yield rows_of([row])
        self.held, self.size = {}, 0


def shards_for(docs: DataFrame, text_col: str) -> int:
    size = docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    return 1 + size // SHARD_BYTES


def merge_shards(parts: DataFrame, shards: int, then: Callable[[str, int, np.ndarray, np.ndarray], Iterator[tuple[str, int, bytes]]]) -> DataFrame:
    """Merge each (kind, shard) in one task and apply ``then`` to it; its rows are written to the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for key, packed in zip(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), batch.column(2)):
                if key != now and held:
                    yield rows_of(list(then(*now, *merged(held))))
                    held = []
                now = key
                held.append(unpack(packed.as_py()))
                if len(held) > 8 and sum(len(h[0]) for h in held[1:]) > len(held[0][0]):
                    held = [merged(held)]
        if held:
            yield rows_of(list(then(*now, *merged(held))))

    return materialize(parts.repartition(4 * shards, "kind", "shard").sortWithinPartitions("kind", "shard").mapInArrow(run, PART), "ngrams")


def save(folder: str, name: str, shard: int, array: np.ndarray) -> None:
    write_once(f"{folder}/{name}-{shard:05d}.npy", lambda out: np.save(out, array))


def build(parts: DataFrame, folder: str, order: int, bits: int, shards: int, extra: dict | None = None) -> dict:
    """Write the model of packed counts of kind ``g`` (full-length n-grams) into the folder.

    Rows of other kinds are merged and written as tables of their own (``kind`` for keys, ``kind``-v for values).
    """
    mask = [(1 << (bits * k)) - 1 for k in range(order + 1)]
    model = {"order": order, "bits": bits, "shards": shards, "discounts": {}, "vocabulary": 0} | (extra or {})

    for k in range(order, 0, -1):
        def level(kind: str, shard: int, keys: np.ndarray, values: np.ndarray, k: int = k) -> Iterator[tuple[str, int, bytes]]:
            if kind != "g":
                save(folder, kind, shard, keys)
                save(folder, f"{kind}-v", shard, values.astype(np.uint32 if values.max(initial=0) < 1 << 32 else np.uint64))
                yield f"stat-{kind}", shard, np.array([len(keys), values[:, 0].sum()], "<i8").tobytes()
                return
            value = values[:, 0]
            save(folder, f"g{k}", shard, keys)
            save(folder, f"v{k}", shard, value.astype(np.uint32 if value.max(initial=0) < 1 << 32 else np.uint64))
            yield "stat", shard, np.array([len(keys), *((value == c).sum() for c in (1, 2, 3, 4))], "<i8").tobytes()
            context = keys >> np.uint64(bits)
            columns = np.stack([value, value == 1, value == 2, value >= 3], 1).astype(np.int64)
            yield from dealt(f"c{k}", *merged([(context, columns)]), shards)
            if k > 1:
                shorter, ends = np.unique(keys & np.uint64(mask[k - 1]), return_counts=True)
                yield from dealt("g", shorter, ends.astype(np.int64), shards)

        rows = merge_shards(parts, shards, level)
        stats = rows.where(F.col("kind").startswith("stat")).select("kind", "packed").collect()  # a few numbers for each shard
        for kind in {r.kind for r in stats} - {"stat"}:
            model[kind[5:]] = np.sum([np.frombuffer(r.packed, "<i8") for r in stats if r.kind == kind], axis=0).tolist()
        n = np.sum([np.frombuffer(r.packed, "<i8") for r in stats if r.kind == "stat"] or [np.zeros(5, np.int64)], axis=0)
        model["discounts"][str(k)] = discounts(n[1:].tolist())
        model["vocabulary"] = int(n[0])  # of the last level: single symbols
        contexts = rows.where(F.col("kind") == f"c{k}")

        def store(kind: str, shard: int, keys: np.ndarray, values: np.ndarray) -> Iterator[tuple[str, int, bytes]]:
            save(folder, kind, shard, keys)
            save(folder, f"s{kind[1:]}", shard, values.astype(np.uint32 if values.max(initial=0) < 1 << 32 else np.uint64))
            yield kind, shard, b""

        merge_shards(contexts, shards, store)
        parts = rows.where(F.col("kind") == "g")
    write_once(f"{folder}/model.json", lambda out: out.write(json.dumps(model).encode()))
    return model


def discounts(n: list[int]) -> list[float]:
    """The three discounts from the numbers of n-grams seen 1, 2, 3, 4 times.

    Where these do not fall off (few texts), so that a discount c would not be within 0 and c, they are 1/2, 1, 3/2.
    """
    if all(n):
        y = n[0] / (n[0] + 2 * n[1])
        out = [c - (c + 1) * y * n[c] / n[c - 1] for c in (1, 2, 3)]
        if all(0 < d <= c for c, d in enumerate(out, 1)):
            return out
    return [0.5, 1.0, 1.5]


class Table:
    """Memory-mapped shards of sorted keys with value columns."""

    def __init__(self, folder: str, keys: str, values: str, shards: int, width: int = 1):
        def load(name: str, s: int):
            path = f"{folder}/{name}-{s:05d}.npy"
            return np.load(path, mmap_mode="r") if os.path.exists(path) else None

        self.shards = [(load(keys, s), load(values, s)) for s in range(shards)]
        self.width = width  # of the values

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Values of each key, 0 where it is not there."""
        keys, back = np.unique(keys, return_inverse=True)
        out = np.zeros((len(keys), self.width), np.int64)
        of = shard_of(keys, len(self.shards))
        order = np.argsort(of, kind="stable")
        bounds = np.searchsorted(of[order], np.arange(len(self.shards) + 1))
        for s, (known, values) in enumerate(self.shards):
            some = order[bounds[s]:bounds[s + 1]]
            if known is None or not len(some) or not len(known):
                continue
            at = np.minimum(np.searchsorted(known, keys[some]), len(known) - 1)
            hit = known[at] == keys[some]
            out[some[hit]] = np.asarray(values[at[hit]]).reshape(-1, self.width)
        return out[back]


class Model:
    def __init__(self, folder: str):
        with open(f"{folder}/model.json") as f:
            self.meta = json.load(f)
        n, shards = self.meta["order"], self.meta["shards"]
        self.folder, self.order, self.bits = folder, n, self.meta["bits"]
        self.grams = {k: Table(folder, f"g{k}", f"v{k}", shards) for k in range(1, n + 1)}
        self.contexts = {k: Table(folder, f"c{k}", f"s{k}", shards, 4) for k in range(1, n + 1)}
        self.discounts = {k: np.array([0.0, *self.meta["discounts"][str(k)]]) for k in range(1, n + 1)}

    def table(self, kind: str) -> Table:
        return Table(self.folder, kind, f"{kind}-v", self.meta["shards"])

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """log10 probability of each key's last symbol after the symbols before it."""
        back, keys = pd.factorize(keys)
        p = np.full(len(keys), 1.0 / (self.meta["vocabulary"] + 1))
        for k in range(1, self.order + 1):
            own = keys & np.uint64((1 << (self.bits * k)) - 1)
            count = self.grams[k].find(own)[:, 0]
            total, once, twice, more = self.contexts[k].find(own >> np.uint64(self.bits)).T
            d = self.discounts[k]
            taken = d[1] * once + d[2] * twice + d[3] * more
            seen = np.maximum(total, 1)
            p = np.where(total > 0, np.maximum(count - d[np.minimum(count, 3)], 0) / seen + taken / seen * p, p)
        return np.log10(p)[back]


@lru_cache(maxsize=2)
def load(folder: str) -> Model:
    return Model(folder)


def new_folder(spark) -> str:
    return mounted_path(shared_folder(spark, "ngram-model"))
