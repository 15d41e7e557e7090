"""Token-id files: static range asymmetric numeral system (rANS) with shared frequency tables.

A corpus becomes a folder: ``table.npy`` (one quantised frequency table for all files) and
``ids-NNNNNN.rans`` files, each with the ids of documents next to each other in ascending id order. A file is a
row of independent blocks of ``BLOCK`` ids. Inside a block, id number i belongs to lane ``i % LANES``; every lane has a
state of its own and all lanes share one stream of 32-bit words, so one step of the coder handles all
lanes of many blocks at once. For each block the index keeps word offset, checksum and the lanes' states
at ``BLOCK / CHECKPOINT_STEP`` checkpoints: decoding can start at any checkpoint of any block, in
parallel, and each block proves itself by its crc32.

Layout (little-endian): magic ``RANSIDS1``; uint64 counts (ids, documents, blocks, words); words uint32;
checkpoint states uint64 [blocks, checkpoints, lanes]; checkpoint word offsets uint64 [blocks, checkpoints];
block crc32 uint32; document ids int64, null flags uint8, lengths int64.

Defined cases: a null text is the empty text and has the end id alone; texts of any length are written
whole (a document may span blocks); rows with the same document id are ordered by their packed ids, identical
rows are all written; a null document id comes first and stays null; an empty table makes an empty result; other
columns of the table are not read.
"""
from __future__ import annotations

import io
import posixpath
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reqtrail.llm import bpe
from reqtrail.llm.common import materialize, offsets_of, running_total, shared_folder, slices, text_bytes

LANES, BLOCK, CHECKPOINT_STEP = 128, 65_536, 16_384  # ids; a checkpoint after every CHECKPOINT_STEP ids
SCALE = 22  # bits of the quantised frequencies
LOW = np.uint64(1 << 31)  # states stay in [2^31, 2^63)
TOGETHER = 64  # blocks coded side by side
MAGIC = b"RANSIDS1"
FILE_BYTES = 16_000_000  # of packed ids aimed at in a file
CHUNK_CACHE, PIECE_CACHE = 150_000, 350_000  # entries of a worker


class Table:
    """Quantised frequencies that sum to 2^SCALE; every id that occurs has at least 1."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.start = offsets_of(freq.astype(np.int64))[:-1].astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64))

    @classmethod
    def from_counts(cls, counts: np.ndarray) -> Table:
        counts = counts.astype(np.int64)
        total, seen = int(counts.sum()), counts > 0
        if not total:
            return cls(np.zeros(len(counts), np.int64))
        room = (1 << SCALE) - int(seen.sum())
        freq = np.array([c * room // total for c in counts.tolist()], np.int64) + seen
        freq[int(np.argmax(counts))] += (1 << SCALE) - int(freq.sum())
        return cls(freq)


def encode_blocks(ids: np.ndarray, table: Table) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """For each block of the ids: words, checkpoint states, checkpoint word offsets, crc32."""
    out = []
    for first in range(0, len(ids), BLOCK * TOGETHER):
        part = ids[first:first + BLOCK * TOGETHER]
        n = -(-len(part) // BLOCK)
        grid = np.full(n * BLOCK, -1, np.int64)
        grid[:len(part)] = part
        steps = BLOCK // LANES
        grid = grid.reshape(n, steps, LANES)
        state = np.full((n, LANES), LOW, np.uint64)
        words = np.zeros((steps, n, LANES), np.uint32)
        given = np.zeros((steps, n, LANES), bool)
        per = CHECKPOINT_STEP // LANES
        states = np.zeros((n, steps // per, LANES), np.uint64)
        for s in range(steps - 1, -1, -1):
            symbol = grid[:, s]
            real = symbol >= 0
            f, c = table.freq[symbol], table.start[symbol]
            full = real & (state >= (f << np.uint64(63 - SCALE)))
            words[s], given[s] = state.astype(np.uint32), full
            state = np.where(full, state >> np.uint64(32), state)
            q, r = np.divmod(state, np.maximum(f, np.uint64(1)))
            state = np.where(real, (q << np.uint64(SCALE)) + r + c, state)
            if s % per == 0:
                states[:, s // per] = state
        for b in range(n):
            before = offsets_of(given[:, b].sum(1))
            raw = part[b * BLOCK:(b + 1) * BLOCK].astype("<u4").tobytes()
            out.append((words[:, b][given[:, b]], states[b], before[:-1:per], zlib.crc32(raw)))
    return out


def decode_spans(words: np.ndarray, at: np.ndarray, state: np.ndarray, lengths: np.ndarray, table: Table) -> np.ndarray:
    """Ids of spans that each start at a checkpoint (word offset, lane states), side by side."""
    n, steps = len(at), int(-(-lengths.max() // LANES)) if len(lengths) else 0
    state, at = state.copy(), at.astype(np.int64).copy()
    out = np.zeros((n, steps, LANES), np.uint32)
    words = np.append(words, np.zeros(LANES + 1, np.uint32)).astype(np.uint64)
    mask, lane = np.uint64((1 << SCALE) - 1), np.arange(LANES)
    for s in range(steps):
        real = lane[None, :] < (lengths - s * LANES)[:, None]
        slot = state & mask
        symbol = table.symbol[slot]
        out[:, s] = symbol
        state = np.where(real, table.freq[symbol] * (state >> np.uint64(SCALE)) + slot - table.start[symbol], state)
        need = real & (state < LOW)
        place = np.minimum(at[:, None] + np.cumsum(need, 1) - need, len(words) - 1)
        state = np.where(need, (state << np.uint64(32)) | words[place], state)
        at += need.sum(1)
    return np.concatenate([out[i].reshape(-1)[:k] for i, k in enumerate(lengths)] + [np.zeros(0, np.uint32)])


class Writer:
    """One file; ids come in any pieces and are coded as blocks fill."""

    def __init__(self, table: Table):
        self.table, self.rest, self.blocks, self.docs = table, np.zeros(0, np.int64), [], []
        self.total = self.documents = 0

    def add(self, doc_ids: list, lengths: np.ndarray, ids: np.ndarray) -> None:
        self.docs.append((doc_ids, lengths))
        self.total += len(ids)
        self.documents += len(doc_ids)
        self.rest = np.concatenate([self.rest, ids])
        whole = len(self.rest) // (BLOCK * TOGETHER) * BLOCK * TOGETHER
        if whole:
            self.blocks += encode_blocks(self.rest[:whole], self.table)
            self.rest = self.rest[whole:]

    def finish(self) -> bytes:
        blocks = self.blocks + encode_blocks(self.rest, self.table)
        base = offsets_of([len(b[0]) for b in blocks])
        doc_ids = [d for ids, _ in self.docs for d in ids]
        lengths = np.concatenate([x for _, x in self.docs] or [np.zeros(0, np.int64)])
        out = io.BytesIO()
        out.write(MAGIC + np.array([self.total, len(doc_ids), len(blocks), base[-1]], "<u8").tobytes())
        for words, *_ in blocks:
            out.write(words.astype("<u4").tobytes())
        for _, states, _, _ in blocks:
            out.write(states.astype("<u8").tobytes())
        for b, (_, _, offsets, _) in enumerate(blocks):
            out.write((offsets + base[b]).astype("<u8").tobytes())
        out.write(np.array([b[3] for b in blocks], "<u4").tobytes())
        out.write(np.array([d or 0 for d in doc_ids], "<i8").tobytes())
        out.write(np.array([d is None for d in doc_ids], "u1").tobytes())
        out.write(lengths.astype("<i8").tobytes())
        return out.getvalue()


class Reader:
    """A file's index; ``ids`` decodes any range of its ids, ``blocks`` all of them in bounded pieces."""

    def __init__(self, data: bytes, table: Table):
        if data[:8] != MAGIC:
            raise ValueError("not a token-id file")
        self.table, self.at = table, 8
        self.data = data
        self.total, docs, blocks, words = (int(x) for x in self._take("<u8", 4))
        points = BLOCK // CHECKPOINT_STEP
        self.words = self._take("<u4", words)
        self.states = self._take("<u8", blocks * points * LANES).reshape(blocks, points, LANES)
        self.offsets = self._take("<u8", blocks * points).reshape(blocks, points)
        self.sums = self._take("<u4", blocks)
        ids, null = self._take("<i8", docs), self._take("u1", docs)
        self.doc_ids = [None if n else d for d, n in zip(ids.tolist(), null.tolist())]
        self.lengths = self._take("<i8", docs)

    def _take(self, kind: str, n: int) -> np.ndarray:
        out = np.frombuffer(self.data, kind, n, self.at)
        self.at += out.nbytes
        return out

    def blocks(self) -> Iterator[np.ndarray]:
        """The ids, some blocks at a time; a block whose checksum differs is an error."""
        for first in range(0, len(self.sums), TOGETHER):
            some = np.arange(first, min(first + TOGETHER, len(self.sums)))
            lengths = np.minimum(self.total - some * BLOCK, BLOCK)
            ids = decode_spans(self.words, self.offsets[some, 0], self.states[some, 0], lengths, self.table)
            for b, piece in zip(some, np.split(ids, np.cumsum(lengths)[:-1])):
                if zlib.crc32(piece.astype("<u4").tobytes()) != self.sums[b]:
                    raise ValueError(f"block {b}: checksum differs")
            yield ids

    def ids(self, start: int, count: int) -> np.ndarray:
        """A range of ids, decoded from the checkpoints it touches alone."""
        if count <= 0:
            return np.zeros(0, np.uint32)
        points = np.arange(start // CHECKPOINT_STEP, (start + count - 1) // CHECKPOINT_STEP + 1)
        per = BLOCK // CHECKPOINT_STEP
        lengths = np.minimum(self.total - points * CHECKPOINT_STEP, CHECKPOINT_STEP)
        ids = decode_spans(self.words, self.offsets[points // per, points % per], self.states[points // per, points % per], lengths, self.table)
        return ids[start - points[0] * CHECKPOINT_STEP:][:count]


def put(uri: str, data: bytes) -> None:
    """Write under a private name, then rename: a repeated task replaces the file by the same bytes."""
    system, path = fs.FileSystem.from_uri(uri if ":/" in uri else f"file://{uri}")
    system.create_dir(posixpath.dirname(path), recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with system.open_output_stream(part) as out:
        out.write(data)
    system.move(part, path)


def get(uri: str) -> bytes:
    system, path = fs.FileSystem.from_uri(uri if ":/" in uri else f"file://{uri}")
    with system.open_input_stream(path) as f:
        return f.read()


@lru_cache(maxsize=2)
def load_table(folder: str) -> Table:
    return Table(np.load(io.BytesIO(get(f"{folder}/table.npy"))))


class _Chunks(bpe.Remembered):
    """Ids, as the tokenizers library merges them, of the white-space-free chunks a worker has seen."""

    def __init__(self, path: str):
        super().__init__(CHUNK_CACHE)
        self.vocabulary = bpe.vocabulary(path)
        self.pieces = _Pieces(self.vocabulary)
        self.plain = self.vocabulary.lower

    def make(self, chunk: bytes) -> bytes:
        # mostly a word of ASCII letters, perhaps with one mark after it, which is a pre-token of its own
        if self.plain and chunk.isalpha():
            return self.pieces[chunk.lower()]
        if self.plain and chunk[:-1].isalpha() and 32 < chunk[-1] < 127:
            return self.pieces[chunk[:-1].lower()] + self.pieces[chunk[-1:]]
        text, v, out = chunk.decode("utf-8"), self.vocabulary, []
        # letters below U+0250 are in normal form, and all but one have a lower case of one letter
        if self.plain and text[:-1].isalpha() and (text[-1].isalpha() or "!" <= text[-1] <= "~") and max(text) < "\u0250" and "\u0130" not in text:
            text = text.lower()
            parts = (text,) if text.isalpha() else (text[:-1], text[-1])
            return b"".join([self.pieces[p.encode("utf-8")] for p in parts])
        for part in v.at_special.split(text) if v.at_special and "<" in text else (text,):
            if part in v.special:
                out.append(np.array([v.special[part]], "<u4").tobytes())
            else:
                out += [self.pieces[p.encode("utf-8")] for p in v.pieces_of(part)]
        return b"".join(out)

    def encode(self, texts: list[bytes], end_id: int) -> list[bytes]:
        """Ids of each text and the end id, uint32. The tokenizer's pre-tokens never reach over ASCII white space."""
        end, ids_of = struct.pack("<I", end_id), self.__getitem__
        return [b"".join(map(ids_of, t.split())) + end for t in texts]


class _Pieces(bpe.Remembered):
    """Ids of pre-tokens, by their UTF-8 bytes."""

    def __init__(self, vocabulary: bpe.Vocabulary):
        super().__init__(PIECE_CACHE)
        self.merge, self.letters = vocabulary.library.model.tokenize, vocabulary.letters

    def make(self, piece: bytes) -> bytes:
        text = piece.decode("latin-1")
        found = self.merge(text if text.isascii() and text.isprintable() else text.translate(self.letters))
        return struct.pack(f"<{len(found)}I", *[x.id for x in found])


@lru_cache(maxsize=2)
def _chunks(path: str) -> _Chunks:
    return _Chunks(path)


def id_kind(path: str, end_id: int) -> str:
    """Two bytes hold an id of most vocabularies while ids are staged."""
    from tokenizers import Tokenizer

    return "<u2" if max(Tokenizer.from_file(path).get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"


def tokenized(docs: DataFrame, path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(counts, doc_id, packed): the ids of each text and the end id, compressed one by one.

    A task's last row has ``counts`` true and holds how often each id occurred in the task.
    """
    kind = id_kind(path, end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1, write_checksum=False).compress
        total = np.zeros(1 << (8 * np.dtype(kind).itemsize) if kind == "<u2" else 0, np.int64)
        for batch in slices(batches, 1):
            ids = _chunks(path).encode(text_bytes(batch.column(1)), end_id)
            small = np.frombuffer(b"".join(ids), "<u4").astype(kind)
            ends = offsets_of([len(x) // 4 for x in ids])
            packed = [pack(small[a:b].tobytes()) for a, b in zip(ends, ends[1:])]
            new = np.bincount(small, minlength=len(total))
            new[:len(total)] += total
            total = new
            yield pa.RecordBatch.from_arrays([pa.array([False] * batch.num_rows), batch.column(0), pa.array(packed, pa.binary())], names=["counts", "doc_id", "packed"])
        yield pa.RecordBatch.from_arrays([pa.array([True]), pa.array([None], pa.int64()), pa.array([pack(total.tobytes())], pa.binary())], names=["counts", "doc_id", "packed"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, "counts boolean, doc_id long, packed binary")


def unpack(packed: list[bytes], kind: str) -> list[np.ndarray]:
    read = zstandard.ZstdDecompressor().decompress
    return [np.frombuffer(read(x), kind) for x in packed]


def _counts(staged: DataFrame) -> np.ndarray:
    """How often each id occurs: the tasks' counts summed; at most one row per vocabulary entry comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for total in unpack(batch.column(0).to_pylist(), "<i8"):
                seen = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["id", "n"])

    rows = staged.where("counts").select("packed").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(max([r.id for r in rows], default=0) + 1, np.int64)
    for r in rows:
        out[r.id] = r.n
    return out


def write_token_files(docs: DataFrame, path: str, folder: str, end_id: int = 2, files: int | None = None,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode all texts and write them to ``folder``; returns the manifest (file, uri, documents, ids, start).

    ``files``: how many; by default from the size of the packed ids, about FILE_BYTES each.
    """
    kind = id_kind(path, end_id)
    staged = materialize(tokenized(docs, path, end_id, id_col, text_col), "token-ids")
    counts, staged = _counts(staged), staged.where("not counts").select("doc_id", "packed")
    if files is None:
        files = 1 + (staged.agg(F.sum(F.octet_length("packed"))).first()[0] or 0) // FILE_BYTES
    put(f"{folder}/table.npy", _npy(Table.from_counts(counts).freq.astype(np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, number, some = Writer(load_table(folder)), TaskContext.get().partitionId(), False
        for batch in slices(batches):
            ids, some = unpack(batch.column(1).to_pylist(), kind), some or batch.num_rows > 0
            writer.add(batch.column(0).to_pylist(), np.array([len(x) for x in ids], np.int64), np.concatenate([*ids, np.zeros(0, kind)]).astype(np.int64))
        if some:
            uri = f"{folder}/ids-{number:06d}.rans"
            put(uri, writer.finish())
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in (
                (number, pa.int32()), (uri, pa.string()), (writer.documents, pa.int64()), (writer.total, pa.int64()))], names=["file", "uri", "documents", "ids"])

    # rows with one document id: by their packed ids, so that reruns agree
    ordered = staged.repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id", "packed")
    manifest = materialize(ordered.mapInArrow(run, "file int, uri string, documents long, ids long"), "token-manifest")
    return running_total(manifest, "file", "ids", "start")


def _npy(array: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, array)
    return out.getvalue()


def read_token_files(manifest: DataFrame, folder: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of every document, decoded from the files of a manifest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                reader, rest, doc = Reader(get(uri), load_table(folder)), np.zeros(0, np.uint32), 0
                ends = offsets_of(reader.lengths)
                done = 0  # ids before the first document not yet given out
                for ids in reader.blocks():
                    rest = np.concatenate([rest, ids])
                    last = int(np.searchsorted(ends, done + len(rest), "right")) - 1
                    if last > doc:
                        bounds = ends[doc:last + 1] - done
                        pieces = [rest[a:b].astype("<u4") for a, b in zip(bounds, bounds[1:])]
                        columns = [pa.array(reader.doc_ids[doc:last], pa.int64()), pa.array(ends[doc:last] + start), pa.array(reader.lengths[doc:last]),
                                   pa.array([zlib.crc32(p.tobytes()) for p in pieces], pa.int64())]
                        if with_ids:
                            columns.append(pa.ListArray.from_arrays(pa.array(bounds - bounds[0], pa.int32()), pa.array(rest[bounds[0]:bounds[-1]].astype(np.int32))))
                        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][:len(columns)])
                        rest, done, doc = rest[bounds[-1]:], int(ends[last]), last

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    return manifest.select("uri", "start").repartition(max(1, manifest.count()), "uri").mapInArrow(run, schema)


def encode_corpus(spark: SparkSession, docs: DataFrame, path: str, end_id: int = 2, files: int | None = None) -> DataFrame:
    """Write the token-id files of a table into a new shared folder and read them back, without the ids themselves."""
    folder = shared_folder(spark, "token-files")
    return read_token_files(write_token_files(docs, path, folder, end_id, files), folder, with_ids=False)
