"""Embedding near-dedup: cross-polytope hashing after fast Hadamard rotations, multiprobe buckets, verified pairs.

A vector is turned by three rounds of random signs and a fast Hadamard transform; its nearest corner of the cross-polytope
(the coordinate that is largest in size, with its sign) is one level of its bucket's code. ``levels`` grow with the logarithm of the
largest label, so that buckets of unlike vectors keep their size. Each of ``tables`` independent codes makes every vector at home in
one bucket and a guest in those it nearly fell into: the corners that are less than a margin behind the nearest one, where the
margin is the spread that a partner at the least cosine has there. Two vectors meet where one is at home and
the other at home or a guest, and every pair that meets is compared in double precision.

Equal vectors are one node with a weight. A bucket of more than ``block`` entries is cut into chunks, and each pair of chunks is
a group of its own, so no task gets more than two chunks at a time. A pair that meets more than once is counted in the first table, and there in
the smaller of its two buckets; codes are made again from the vectors to tell. Pairs never leave their task: a task returns sums by
node, and a spanning forest of what it linked.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite component, or have a null label, link with nothing and keep
their own id; vectors of different length are not compared; repeated rows are vectors of their own, linked like others; a null id is
never the smallest and is not kept; an empty table gives an empty result; other columns are not read.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import product
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reqtrail.llm.common import materialize
from reqtrail.llm.components import components

LEAST_COSINE = 0.98
TABLES = 2
BUCKET = 1024  # unlike vectors of a label that a bucket has at most
BLOCK = 4096  # entries of a chunk
STRIP = 512  # rows compared with a chunk at once
HELD = 20_000  # entries whose equals a map task adds up
SEED = 20_240_611


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of every row, of 2^k columns, scaled to keep lengths."""
    n, width, half = len(x), x.shape[1], 1
    while half < width:
        parts = x.reshape(n, -1, 2, half)
        x = np.stack([parts[:, :, 0] + parts[:, :, 1], parts[:, :, 0] - parts[:, :, 1]], 2).reshape(n, width)
        half *= 2
    return x / sqrt(width)


class Hash:
    """Codes of unit vectors of one length."""

    def __init__(self, length: int, tables: int, levels: int, least: float):
        self.width = 1 << max(0, length - 1).bit_length()
        self.tables, self.levels = tables, levels
        self.margin = (1 + 0.15 * (levels - 1)) * sqrt(2 * (1 - least * least) / self.width)
        rnd = np.random.default_rng(SEED)
        self.signs = rnd.choice([-1.0, 1.0], (tables, levels, 3, self.width))

    def corners(self, x: np.ndarray, table: int, level: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest corner of each row, and which corners are within the margin of it."""
        for signs in self.signs[table, level]:
            x = hadamard(x * signs)
        sides = np.concatenate([x, -x], 1)
        home = sides.argmax(1)
        return home, sides >= sides[np.arange(len(x)), home][:, None] - self.margin

    def places(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Home corners [tables, levels, rows], and within [tables, levels, rows, corners]: the corners of a row's buckets."""
        x = np.zeros((len(units), self.width))
        x[:, :units.shape[1]] = units
        home = np.zeros((self.tables, self.levels, len(x)), np.int64)
        within = np.zeros((self.tables, self.levels, len(x), 2 * self.width), bool)
        for table in range(self.tables):
            for level in range(self.levels):
                home[table, level], within[table, level] = self.corners(x, table, level)
        return home, within

    def bucket(self, corners) -> int:
        code = 0
        for corner in corners:
            code = code * 2 * self.width + int(corner)
        return code


def units_of(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision; scaled first, so that no square is lost."""
    x = vectors.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def usable(values: np.ndarray | None) -> bool:
    return values is not None and len(values) > 0 and bool(np.isfinite(values).all()) and bool(values.any())


def node_of(label: str, values: np.ndarray) -> bytes:
    """One name for all equal vectors of a label."""
    return hashlib.blake2b(values.tobytes(), digest_size=16, key=hashlib.sha256(label.encode("utf-8")).digest()).digest()


def nodes(batch: pa.RecordBatch) -> Iterator[tuple[object, str, np.ndarray | None, bytes | None]]:
    """(id, label, values, node) of the rows of (id, label, vector); no node for what links with nothing."""
    vectors, labels = batch.column(2), batch.column(1).to_pylist()
    kind = vectors.type.value_type.to_pandas_dtype()
    flat, offsets = vectors.values, vectors.offsets.to_numpy()
    null_part, empty = flat.is_null().to_numpy(zero_copy_only=False), vectors.is_null().to_numpy(zero_copy_only=False)
    flat = flat.fill_null(np.nan).to_numpy(zero_copy_only=False).astype(kind, copy=False)
    for i, id_ in enumerate(batch.column(0).to_pylist()):
        values = None if empty[i] or null_part[offsets[i]:offsets[i + 1]].any() else flat[offsets[i]:offsets[i + 1]]
        good = labels[i] is not None and usable(values)
        yield id_, labels[i], values, node_of(labels[i], values) if good else None


class Forest:
    """Which of n rows are linked, and the links that first joined two parts."""

    def __init__(self, n: int):
        self.part, self.links = np.arange(n), []

    def join(self, row: int, others: np.ndarray) -> None:
        parts, at = np.unique(self.part[others], return_index=True)
        new = parts != self.part[row]
        if new.any():
            self.links += [(row, int(others[i])) for i in at[new]]
            self.part[np.isin(self.part, parts)] = self.part[row]


def linked(a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """Whether the cosine of each row of ``a`` with each of ``b`` is at least ``least``; rows have length 1."""
    return a @ b.T >= least


def links_of_group(vectors: np.ndarray, home: np.ndarray, side: np.ndarray, weight: np.ndarray, hash_: Hash, table: int, bucket: int,
                   least: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Sums of the weights that each entry of a group links with, and a spanning forest of the links.

    Pairs have an entry that is at home, and where the group is a pair of chunks (``side`` 0 and 1), one of either.
    """
    units, sums, forest = units_of(vectors), np.zeros(len(vectors), np.int64), Forest(len(vectors))
    order = np.arange(len(vectors))
    places = None
    for first in range(0, len(vectors), STRIP):
        rows = order[first:first + STRIP]
        found = linked(units[rows], units, least) & (home[rows][:, None] | home[None, :]) & (order[None, :] > rows[:, None])
        if side.any():
            found &= side[rows][:, None] != side[None, :]
        for i in np.flatnonzero(found.any(1)):
            forest.join(int(rows[i]), np.flatnonzero(found[i]))
        i, j = np.nonzero(found)
        if not len(i):
            continue
        i += first
        if places is None:
            places = hash_.places(units)
        counted = first_meeting(places, hash_, i, j, table, bucket)
        np.add.at(sums, i[counted], weight[j[counted]])
        np.add.at(sums, j[counted], weight[i[counted]])
    return sums, forest.links


def first_meeting(places: tuple[np.ndarray, np.ndarray], hash_: Hash, i: np.ndarray, j: np.ndarray, table: int, bucket: int) -> np.ndarray:
    """Whether pairs (i, j) are counted in this bucket: they meet in no table before, and in no smaller bucket of this one."""
    home, within = places

    def visits(t: int, host: np.ndarray, guest: np.ndarray) -> np.ndarray:
        out = np.ones(len(host), bool)
        for level in range(hash_.levels):
            out &= within[t, level, guest, home[t, level, host]]
        return out

    out = np.ones(len(i), bool)
    for t in range(table):
        out &= ~(visits(t, i, j) | visits(t, j, i))
    code = np.zeros(home.shape[2], np.int64)
    for level in range(hash_.levels):
        code = code * 2 * hash_.width + home[table, level]
    far = np.iinfo(np.int64).max
    at = np.minimum(np.where(visits(table, i, j), code[i], far), np.where(visits(table, j, i), code[j], far))
    return out & (at == bucket)


KEYS = ["label", "length", "hash_table", "bucket"]


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
                    least: float = LEAST_COSINE, tables: int = TABLES, bucket_size: int = BUCKET, block: int = BLOCK) -> DataFrame:
    """(id, n_links, component_id, kept): links of every vector, the smallest id reachable by links, and whether that is its own."""
    kind = vectors.schema[vector_col].dataType.elementType.typeName()
    element = "float" if kind == "float" else "double"
    slim = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("string").alias("label"),
                          F.col(f"`{vector_col}`").cast(f"array<{element}>").alias("vector"))
    most = slim.where("label is not null").groupBy("label").count().agg(F.max("count")).first()[0] or 0
    length = slim.agg(F.min(F.when(F.size("vector") > 0, F.size("vector")))).first()[0] or 1
    levels, corners = 1, 2 * (1 << max(0, length - 1).bit_length())
    while most > bucket_size * corners ** levels:
        levels += 1
    number = np.float32 if element == "float" else np.float64

    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(id_, node) for id_, _, _, node in nodes(batch)]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in found], pa.int64()), pa.array([n for _, n in found], pa.binary())], names=["id", "node"])

    def enter(batches: Iterator[pa.RecordBatch], payload: bool) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}
        for batch in batches:
            for _, label, values, node in nodes(batch):
                if node is not None:
                    held.setdefault(node, [label, values.tobytes(), 0])[2] += 1
                    if len(held) == HELD:
                        yield from entries(held, payload)
                        held = {}
        yield from entries(held, payload)

    def entries(held: dict[bytes, list], payload: bool) -> Iterator[pa.RecordBatch]:
        by_length: dict[int, list[bytes]] = {}
        for node, (_, data, _) in held.items():
            by_length.setdefault(len(data) // number().itemsize, []).append(node)
        for length, group in by_length.items():
            hash_ = Hash(length, tables, levels, least)
            for start in range(0, len(group), 2048):
                names = group[start:start + 2048]
                home, within = hash_.places(units_of(np.frombuffer(b"".join(held[n][1] for n in names), number).reshape(len(names), length)))
                rows = []
                for i, name in enumerate(names):
                    label, data, weight = held[name]
                    for t in range(tables):
                        own = tuple(home[t, :, i].tolist())
                        for corners in product(*(np.flatnonzero(within[t, level, i]).tolist() for level in range(levels))):
                            rows.append((label, length, t, hash_.bucket(corners), corners == own, name, weight, data if payload else None))
                columns = list(zip(*rows))
                kinds = (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.binary(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                                 names=[*KEYS, "home", "node", "weight", "vector"])

    def verify(key: tuple, group: pa.Table) -> pa.Table:
        length, table, bucket, side_of = (key[i].as_py() for i in (1, 2, 3, 5))
        merged: dict[bytes, list] = {}
        columns = [group.column(c).to_pylist() for c in ("node", "weight", "home", "chunk", "vector")]
        for node, weight, home, chunk, data in zip(*columns):
            merged.setdefault(node, [0, home, chunk == side_of and key[4].as_py() != side_of, data])[0] += weight
        names, rows = list(merged), list(merged.values())
        out = ([], [], [], [])
        if len(rows) > 1:
            data = np.frombuffer(b"".join(r[3] for r in rows), number).reshape(len(rows), length)
            sums, forest = links_of_group(data, np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), np.array([r[0] for r in rows], np.int64),
                                          Hash(length, tables, levels, least), table, bucket, least)
            some = np.flatnonzero(sums)
            out = ([names[i] for i in some] + [None] * len(forest), sums[some].tolist() + [0] * len(forest),
                   [None] * len(some) + [names[a] for a, _ in forest], [None] * len(some) + [names[b] for _, b in forest])
        return pa.table({"node": pa.array(out[0], pa.binary()), "links": pa.array(out[1], pa.int64()), "a": pa.array(out[2], pa.binary()), "b": pa.array(out[3], pa.binary())})

    shape = "label string, length int, hash_table int, bucket long, home boolean, node binary, weight long, vector binary"
    ids = materialize(slim.mapInArrow(identify, "id long, node binary"), "vector-nodes")
    sizes = slim.mapInArrow(lambda b: enter(b, False), shape).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"))
    full = materialize(sizes.where(F.col("n") > block).select(*KEYS, F.ceil(F.col("n") / block).cast("int").alias("chunks")), "full-buckets")
    entered = slim.mapInArrow(lambda b: enter(b, True), shape).join(full, KEYS, "left")
    chunks = F.coalesce("chunks", F.lit(1))
    entered = entered.withColumn("chunk", F.pmod(F.xxhash64("node"), chunks).cast("int"))
    entered = entered.withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
    entered = entered.withColumns({"low": F.least("chunk", "other"), "high": F.greatest("chunk", "other")})
    found = entered.groupBy(*KEYS, "low", "high").applyInArrow(verify, "node binary, links long, a binary, b binary")
    found = materialize(found, "vector-links")

    links = found.where("node is not null").groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.where("a is not null"), "a", "b")
    classes = ids.where("node is not null").groupBy("node").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("least"))
    placed = classes.join(links, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = materialize(placed, "vector-classes")
    smallest = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    placed = placed.join(smallest, "root").select("node", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    linked_rows = ids.where("node is not null").join(placed, "node", "left").select("id", "n_links", "component_id")
    alone = ids.where("node is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept")
    return linked_rows.union(alone).select(F.col("id").alias(id_col), "n_links", "component_id", kept)


#: The same rows in DuckDB: all pairs of a label, and the ids that links reach.
ORACLE_SQL = """
with recursive v as (select vec_id, label, cast(embedding as double[]) as e from embeddings where label is not null and embedding is not null and len(embedding) > 0),
good as (select * from v where len([x for x in e if x is null or not isfinite(x)]) = 0 and len([x for x in e if x <> 0]) > 0),
links as (select a.vec_id as a, b.vec_id as b from good a join good b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
          where list_cosine_similarity(a.e, b.e) >= 0.98),
reach as (select vec_id as a, vec_id as b from embeddings union select r.a, l.b from reach r join links l on l.a = r.b),
least as (select a, min(b) as component_id from reach group by a), degree as (select a, count(*) as n from links group by a)
select e.vec_id, coalesce(d.n, 0) as n_links, c.component_id, e.vec_id = c.component_id as kept
from embeddings e join least c on c.a = e.vec_id left join degree d on d.a = e.vec_id
"""
