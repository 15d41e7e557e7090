"""SimHash near-duplicates: fingerprints, and a self-join of the binary trie that they form.

The join walks the trie of all different fingerprints against itself: from a pair of nodes to the pairs of their
children, adding a differing bit where the branches differ, and drops a pair once its bits exceed the budget. Spark deals
the walk out by node pairs. Two fingerprints with at most ``distance`` differing bits agree in one of
``distance + 1`` blocks of bits, so for each block the fingerprints are turned until the block comes first, and those
that share it are one trie of its own. A trie with more than ``TRIE_ROWS`` leaves is divided into the node pairs
some levels below its root, whose tasks get the differing bits so far. Tasks return a spanning forest of the links they
find, never all pairs; node pairs whose leaves already hang together are not walked again.

Defined cases: null and blank texts have fingerprint 0 and link like any other; fewer words than a shingle
make one shingle; equal fingerprints are one leaf, so copies cost nothing; repeated rows each give a row; a
null document id keeps its row and is never a component id while another id is there; an empty table gives an empty
result; other columns are not read.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reqtrail.llm.common import materialize, numbered, schema, slices, text_bytes
from reqtrail.llm.components import components

SEED = 42
TRIE_ROWS = 50_000  # leaves of a trie that one task walks from its root
DIVISIONS = (2, 4, 8, 12, 16)  # levels below the root at which a larger trie is divided into node pairs
PAIRS = 100_000  # node pairs expanded at once
HASHES = 50_000  # shingle hashes held at once as bits


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """XXH64 of the shingles of the words, ASCII letters in lower case."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(line, SEED)], np.uint64)
    starts = [0, *(ends[:-1] + 1).tolist()][:len(words) - width + 1]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[s:e], SEED) for s, e in zip(starts, ends[width - 1:].tolist())), np.uint64, len(starts))


def fingerprints(texts: list[bytes], width: int) -> np.ndarray:
    """A bit is 1 if it is set in over half of a text's shingle hashes."""
    ones, sizes = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64)
    held, rows, n = [], [], 0

    def flush() -> None:
        bits = np.unpackbits(np.concatenate(held).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        starts = np.cumsum([0, *map(len, held[:-1])])
        np.add.at(ones, rows, np.add.reduceat(bits, starts, axis=0, dtype=np.int64))

    for i, text in enumerate(texts):
        hashes = shingle_hashes(text, width)
        sizes[i] = len(hashes)
        for first in range(0, len(hashes), HASHES):
            held.append(hashes[first:first + HASHES])
            rows.append(i)
            n += len(held[-1])
            if n >= HASHES:
                flush()
                held, rows, n = [], [], 0
    if held:
        flush()
    return np.packbits(2 * ones > sizes[:, None], axis=1).view(">u8").astype(np.uint64).reshape(-1)


def with_fingerprint(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """(id, fingerprint as long) of every row; with ``row_col`` that column as ``_carried``."""
    out = schema(f"{id_col} long, fingerprint long", docs.schema[row_col].dataType if row_col else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            prints = fingerprints(text_bytes(batch.column(1)), width)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64)), *batch.columns[2:]], names=out.names)

    slim = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("text"),
                       *([F.col(row_col).alias("_carried")] if row_col else []))
    return slim.mapInArrow(run, out)


def blocks_of(distance: int) -> list[tuple[int, int]]:
    """(first bit, bits) of distance + 1 blocks."""
    cuts = [64 * i // (distance + 1) for i in range(distance + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def turned(prints: np.ndarray, first: int, bits: int) -> np.ndarray:
    """The fingerprints with a block of bits in front."""
    by = (64 - first - bits) % 64
    return prints if not by else (prints << np.uint64(by)) | (prints >> np.uint64(64 - by))


def turned_back(prints: np.ndarray, first: int, bits: int) -> np.ndarray:
    by = (64 - first - bits) % 64
    return prints if not by else (prints >> np.uint64(by)) | (prints << np.uint64(64 - by))


class Trie:
    """Sorted 64-bit keys as an implicit binary trie: a node is a range of keys that share their first bits."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.ones: dict[int, np.ndarray] = {}
        self.root = np.arange(len(keys))  # of the links found so far
        self._edges()

    def _edges(self) -> None:
        self.changes = np.concatenate(([0], np.cumsum(self.root[1:] != self.root[:-1])))

    def middle(self, low: np.ndarray, high: np.ndarray, depth: int) -> np.ndarray:
        if depth not in self.ones:
            bit = (self.keys >> np.uint64(63 - depth)) & np.uint64(1)
            self.ones[depth] = np.concatenate(([0], np.cumsum(bit.astype(np.int64))))
        ones = self.ones[depth]
        return high - (ones[high] - ones[low])

    def joined(self, p: np.ndarray) -> np.ndarray:
        """Node pairs all of whose leaves are in one component already."""
        same = lambda low, high: self.changes[high - 1] == self.changes[low]
        return same(p[:, 0], p[:, 1]) & same(p[:, 2], p[:, 3]) & (self.root[p[:, 0]] == self.root[p[:, 2]])

    def link(self, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
        """Join leaves; returns the links that joined two components."""
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := parent.get(x, x)) != x:
                parent[x] = parent.get(up, up)
                x = up
            return x

        found = []
        for i, j, x, y in zip(a.tolist(), b.tolist(), self.root[a].tolist(), self.root[b].tolist()):
            x, y = find(x), find(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
                found.append((i, j))
        if found:
            old = np.array(list(parent), np.int64)
            to = np.arange(len(self.keys))
            to[old] = [find(x) for x in old.tolist()]
            self.root = to[self.root]
            self._edges()
        return found

    def links(self, pairs: np.ndarray, depth: np.ndarray, distance: int) -> Iterator[tuple[int, int]]:
        """Walk node pairs (low, high, low, high, differing bits) that start at the given depths."""
        stack = [(d, pairs[depth == d]) for d in np.unique(depth).tolist()]
        while stack:
            d, p = stack.pop()
            if len(p) > PAIRS:
                stack.append((d, p[PAIRS:]))
                p = p[:PAIRS]
            p = p[~self.joined(p)]
            alone = (p[:, 1] - p[:, 0] == 1) & (p[:, 3] - p[:, 2] == 1)
            a, b = p[alone, 0], p[alone, 2]
            mask = np.uint64((1 << (64 - d)) - 1)  # the bits above are counted in the pair already
            near = np.bitwise_count((self.keys[a] ^ self.keys[b]) & mask) + p[alone, 4] <= distance
            yield from self.link(a[near], b[near])
            p = p[~alone]
            if not len(p):
                continue
            al, ah, bl, bh, e = p.T
            am, bm = self.middle(al, ah, d), self.middle(bl, bh, d)
            self_ = al == bl
            other = ~self_
            down = np.concatenate([
                np.stack([al, am, bl, bm, e], 1), np.stack([am, ah, bm, bh, e], 1),
                np.stack([al, am, bm, bh, e + 1], 1), np.stack([am, ah, bl, bm, e + 1], 1)[other]])
            keep = (down[:, 0] < down[:, 1]) & (down[:, 2] < down[:, 3]) & (down[:, 4] <= distance)
            keep &= ~((down[:, 0] == down[:, 2]) & (down[:, 1] - down[:, 0] == 1))  # a leaf with itself
            if keep.any():
                stack.append((d + 1, down[keep]))


def divided_tries(prints: DataFrame, blocks: list[tuple[int, int]], trie_rows: int) -> dict[tuple[int, int], int]:
    """(block number, block value) of every trie with too many leaves, and the level at which it is divided.

    The first of DIVISIONS where no node has too many leaves, or the last. At most 2^(bits of a block) rows a block come
    to the driver, and no more than leaves over ``trie_rows``.
    """
    parts = []
    for k, (first, bits) in enumerate(blocks):
        block = F.expr(f"shiftrightunsigned(fingerprint, {first}) & {(1 << bits) - 1}L")
        by = (64 - first - bits) % 64
        key = f"(shiftleft(fingerprint, {by}) | shiftrightunsigned(fingerprint, {64 - by}))" if by else "fingerprint"
        below = F.expr(f"shiftrightunsigned(shiftleft({key}, {bits}), {64 - DIVISIONS[-1]})")
        parts.append(F.struct(F.lit(k).alias("turn"), block.alias("block"), below.alias("below")))
    leaves = prints.select(F.explode(F.array(*parts)).alias("_x")).select("_x.*")
    many = leaves.groupBy("turn", "block").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > trie_rows).select("turn", "block")
    many = materialize(many, "large-tries")
    if many.isEmpty():
        return {}
    nodes = materialize(leaves.join(many, ["turn", "block"]).groupBy("turn", "block", "below").agg(F.count(F.lit(1)).alias("n")), "large-trie-nodes")
    out: dict[tuple[int, int], int] = {}
    for levels in DIVISIONS:
        node = nodes.groupBy("turn", "block", F.shiftrightunsigned("below", DIVISIONS[-1] - levels).alias("node")).agg(F.sum("n").alias("n"))
        most = node.groupBy("turn", "block").agg(F.max("n").alias("n"))
        for r in most.collect():
            if (r.turn, r.block) not in out and (r.n <= trie_rows or levels == DIVISIONS[-1]):
                out[r.turn, r.block] = levels
    return out


def near_links(prints: DataFrame, distance: int, trie_rows: int = TRIE_ROWS) -> DataFrame:
    """(a, b): links that connect all pairs of the different fingerprints within the distance."""
    if not distance:  # different fingerprints are never equal
        return prints.select(F.col("fingerprint").alias("a"), F.col("fingerprint").alias("b")).limit(0)
    blocks = blocks_of(distance)

    large = divided_tries(prints, blocks, trie_rows)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each node pair that a fingerprint belongs to: the pair of roots, or pairs some levels below."""
        flips = {}
        for batch in batches:
            prints = batch.column(0).to_numpy().view(np.uint64)
            for turn, (first, bits) in enumerate(blocks):
                keys = turned(prints, first, bits)
                block = keys >> np.uint64(64 - bits)
                deep = np.array([large.get((turn, int(x)), 0) for x in block], np.int64) if large else np.zeros(len(keys), np.int64)
                for levels in np.unique(deep).tolist():
                    own = keys[deep == levels]
                    node = (own << np.uint64(bits)) >> np.uint64(64 - levels) if levels else np.zeros(len(own), np.uint64)
                    if levels not in flips:
                        flips[levels] = [sum(1 << i for i in c) for k in range(min(distance, levels) + 1) for c in combinations(range(levels), k)]
                    for flip in flips[levels]:
                        other = node ^ np.uint64(flip)
                        yield pa.RecordBatch.from_arrays([
                            pa.array(np.full(len(own), turn, np.int32)), pa.array((own >> np.uint64(64 - bits)).view(np.int64)),
                            pa.array(np.full(len(own), levels, np.int32)), pa.array(np.minimum(node, other).view(np.int64)),
                            pa.array(np.maximum(node, other).view(np.int64)), pa.array((own ^ np.uint64(1 << 63)).view(np.int64))],
                            names=["turn", "block", "levels", "p", "q", "key"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            rows = np.stack([c.to_numpy().astype(np.int64) for c in batch.columns], 1)
            held.append(rows)
            if sum(map(len, held)) >= trie_rows:
                rows = np.concatenate(held)
                last = np.flatnonzero((rows[1:, :5] != rows[:-1, :5]).any(1))
                if len(last):
                    yield from groups(rows[:last[-1] + 1])
                    rows = rows[last[-1] + 1:]
                held = [rows]
        if held:
            yield from groups(np.concatenate(held))

    def groups(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(rows):
            return
        keys = rows[:, 5].view(np.uint64) ^ np.uint64(1 << 63)
        cuts = np.flatnonzero((rows[1:, :5] != rows[:-1, :5]).any(1)) + 1
        low, high = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(rows)]))
        turn, levels, p, q = rows[low, 0], rows[low, 2], rows[low, 3], rows[low, 4]
        depth = np.array([blocks[t][1] for t in turn.tolist()]) + levels
        single = p == q
        trie = Trie(keys)
        # the leaves of a group are sorted, so those below p come before those below q
        below_q = np.array([int(((keys[a:b] << np.uint64(blocks[t][1])) >> np.uint64(64 - n) == np.uint64(y)).sum()) if not s else 0
                            for a, b, t, n, y, s in zip(low, high, turn.tolist(), levels.tolist(), q.tolist(), single)], np.int64)
        middle = np.where(single, low, high - below_q)
        pairs = np.stack([low, np.where(single, high, middle), np.where(single, low, middle), high,
                          np.bitwise_count((p ^ q).view(np.uint64)).astype(np.int64)], 1)
        keep = (pairs[:, 0] < pairs[:, 1]) & (pairs[:, 2] < pairs[:, 3]) & ~(single & (high - low == 1))
        found = np.array(list(trie.links(pairs[keep], depth[keep], distance)), np.int64).reshape(-1, 2)
        if len(found):
            of = np.repeat(turn, high - low)
            out = keys.copy()
            for t, b in enumerate(blocks):
                out[of == t] = turned_back(keys[of == t], *b)
            yield pa.RecordBatch.from_arrays([pa.array(out[found[:, 0]].view(np.int64)), pa.array(out[found[:, 1]].view(np.int64))], names=["a", "b"])

    dealt = prints.select("fingerprint").mapInArrow(deal, "turn int, block long, levels int, p long, q long, key long")
    keys = ["turn", "block", "levels", "p", "q"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys, "key").mapInArrow(walk, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 3, distance: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint as long, component_id: the smallest id reachable over links) of every row."""
    prints = materialize(with_fingerprint(docs, width, id_col, text_col), "fingerprints")
    return prints.join(print_components(prints, distance, id_col), "fingerprint").select(id_col, "fingerprint", "component_id")


def one_of_each(docs: DataFrame, width: int = 3, distance: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their group: those with its component id; of several such rows, one.

    Which rows stay is decided on ids and fingerprints alone; then the rows are filtered by a row number.
    """
    rows = numbered(docs)
    text = F.col("_carried").getField(text_col)
    # the text's hash settles which of several rows with one id stays
    slim = rows.select(F.col("_carried").getField(id_col).alias(id_col), text.alias("text"),
                       F.struct(F.xxhash64(text).alias("hash"), "_row").alias("_row"))
    slim = materialize(with_fingerprint(slim, width, id_col, "text", "_row"), "fingerprints")
    first = slim.join(print_components(slim, distance, id_col), "fingerprint").where(F.col(id_col).eqNullSafe(F.col("component_id")))
    one = first.groupBy("group").agg(F.min("_carried")["_row"].alias("_row"))
    return rows.join(one.select("_row"), "_row", "left_semi").select("_carried.*")


def print_components(prints: DataFrame, distance: int, id_col: str = "doc_id") -> DataFrame:
    """(fingerprint, group, component_id) of every different fingerprint; a group is named by its least fingerprint."""
    leaves = materialize(prints.groupBy("fingerprint").agg(F.min(id_col).alias("_least")), "fingerprint-leaves")
    roots = components(near_links(leaves, distance), "a", "b").toDF("fingerprint", "_root")
    rooted = leaves.join(roots, "fingerprint", "left").select("fingerprint", "_least", F.coalesce("_root", "fingerprint").alias("_root"))
    rooted = materialize(rooted, "fingerprint-roots")
    return rooted.join(rooted.groupBy("_root").agg(F.min("_least").alias("component_id")), "_root").select(
        "fingerprint", F.col("_root").alias("group"), "component_id")
