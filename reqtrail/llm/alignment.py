"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes of a text.

Both tokenizers encode the whole text. Where a token of A and one of B end at the same byte and the next
tokens of both begin with a space, the text is cut: such anchors are checked byte by byte, never assumed, and split a
document into short windows of token ids. A window is aligned once for each tuple of ids and then remembered, in a
table that is bounded in bytes.

A first pass encodes, writes the packed ids, and counts the links of the whole corpus for every pair of ids: tasks add up windows and send
the sums of their pairs. Ids are written once for each different part (below) of some texts, with the parts of each text as numbers, and
cut into windows once: both tokenizers end at the end of a part, and the next part begins with a space, so it is an anchor. The counts are kept as sorted arrays in the shared folder, which the tasks of the second pass memory-map to
find what each link's pair counts.

No token of either vocabulary holds a space after a letter that is not white space, so a text is encoded in parts cut before single
spaces between other letters; parts are encoded by the libraries, and short ones that come again are remembered. A vocabulary of which
this is not true is used on whole texts. Parts of a byte-level vocabulary whose merges are in the order of its ids go through the tiktoken
library with the same vocabulary, five times as fast (tests hold its ids against the other library, on every code point and on texts).

Defined cases: null and empty texts, and texts that either tokenizer does not reproduce (B writes U+2581 and some letters
in another way), have no tokens, zeros and an empty digest; texts of any length are whole; strings of special tokens are plain
text; repeated rows each give a row and count each; an empty table gives an empty result; other columns are not read.
"""
from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reqtrail.llm.bpe import byte_letters
from reqtrail.llm.common import materialize, mounted_path, offsets_of, shared_folder, slices, write_once

LONGEST_KEY = 64  # letters of a part that is remembered
CACHE_BYTES = 80_000_000  # of remembered parts, and of remembered windows
ENTRY_BYTES = 160  # that an entry of a table takes besides its key
MET_BYTES = 1 << 22  # of the bit table of parts met before; a power of 2
RARE_SPACES = ("  ", " \n", "\n ", "\t", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f")
TOGETHER = 512  # parts encoded at once
SEPARATOR = 0xFFFFFFFF
SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")
SPACE_AFTER_LETTER = re.compile(r"\S ")
UNSAFE = re.compile(r"\A\s| \s|\s |\s\Z")
OTHER_SPACES = tuple(x for x in map(chr, range(0x80, 0x3001)) if x.isspace())
LONGEST_QUICK = 4096  # letters of a part that the quick library takes
# Fixed value: the pattern that byte-level vocabularies of this kind cut texts by.
BYTE_LEVEL_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def single_spaces(text: str) -> bool:
    """Whether every space of a text stands between two letters that are not white space, by cheap tests first."""
    rare = (text[:1].isspace() or text[-1:].isspace() or any(map(text.__contains__, RARE_SPACES))
            or not text.isascii() and any(map(text.__contains__, OTHER_SPACES)))
    return not rare or not UNSAFE.search(text)


class Tokenizer:
    """A vocabulary: the bytes of every token, and the ids of parts of texts."""

    def __init__(self, pieces: list[bytes]):
        self.pieces = pieces
        self.lengths = np.array([len(p) for p in pieces], np.int64)
        self.pool, self.starts = np.frombuffer(b"".join(pieces), np.uint8), offsets_of(self.lengths)[:-1]
        self.spaced = np.array([p[:1] == b" " for p in pieces])
        self.by_parts = not any(SPACE_AFTER_LETTER.search(p.decode("utf-8", "replace")) for p in pieces)

    def ids_of(self, texts: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def ids_of_joined(self, joined: str) -> list[int]:
        """Ids of short parts joined by spaces."""
        return self.ids_of([joined])[0]

    def written(self, ids: np.ndarray) -> np.ndarray:
        """The bytes that ids stand for."""
        lengths = self.lengths[ids]
        place = np.arange(lengths.sum()) + np.repeat(self.starts[ids] - offsets_of(lengths)[:-1], lengths)
        return self.pool[place]

    def encode(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all parts in one array, their number in each part, and which parts they reproduce.

        Parts without spaces are encoded many at once, as a text that their ids are cut from again.
        """
        ids, counts, whole = [], np.zeros(len(parts), np.int64), np.ones(len(parts), bool)
        for first in range(0, len(parts), TOGETHER):
            some = parts[first:first + TOGETHER]
            joined = " ".join(some)
            data = np.frombuffer((" " + joined).encode("utf-8"), np.uint8)
            spaces = np.flatnonzero(data == 32)
            if self.by_parts and len(spaces) == len(some) and single_spaces(joined):
                short = max(map(len, some)) <= LONGEST_QUICK
                found = np.array(self.ids_of_joined(joined) if short else self.ids_of([joined])[0], np.int64)
                if np.array_equal(self.written(found), data):
                    at = np.searchsorted(np.cumsum(self.lengths[found]), np.append(spaces[1:], len(data))) + 1
                    ids.append(found)
                    counts[first:first + len(some)] = np.diff(np.append(0, at))
                    continue
            for i, (part, found) in enumerate(zip(some, self.ids_of(some)), first):
                found = np.array(found, np.int64)
                ids.append(found)
                counts[i], whole[i] = len(found), self.written(found).tobytes() == (" " + part).encode("utf-8")
        return np.concatenate([*ids, np.zeros(0, np.int64)]), counts, whole


class ByteTokenizer(Tokenizer):
    """A byte-level vocabulary of the tokenizers library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer as Library

        self.library = Library.from_file(path)
        self.library.encode_special_tokens = True
        byte_of = {x: b for b, x in enumerate(byte_letters())}
        names = {i: t for t, i in self.library.get_vocab().items()}
        special = {i for i, t in self.library.get_added_tokens_decoder().items() if t.special}
        super().__init__([b"" if i in special or i not in names else bytes(byte_of[x] for x in names[i]) for i in range(max(names) + 1)])
        self.quick = self._quick(json.loads(self.library.to_str()))

    def _quick(self, spec: dict):
        """The same vocabulary in the tiktoken library; None if its merges are not in the order of ids, or it cuts texts in another way."""
        model, cuts = spec["model"], spec["pre_tokenizer"]
        made = [model["vocab"].get("".join(m if isinstance(m, list) else m.split(" ")), -1) for m in model.get("merges", [])]
        plain = not (spec["normalizer"] or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")))
        if not (plain and cuts and cuts["type"] == "ByteLevel" and cuts["use_regex"] and not cuts["add_prefix_space"]
                and made == list(range(256, 256 + len(made))) and len(model["vocab"]) - len(made) in (256, 257)):
            return None
        import tiktoken

        ranks = {p: i for i, p in enumerate(self.pieces) if p and i < 256 + len(made)}
        return tiktoken.Encoding("own", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids_of_joined(self, joined: str) -> list[int]:
        return self.quick.encode_ordinary(" " + joined) if self.quick else super().ids_of_joined(joined)

    def ids_of(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


class PieceTokenizer(Tokenizer):
    """A sentencepiece model, which puts a space before each text by itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model, n = self.library, self.library.get_piece_size()
        super().__init__([bytes([int(model.id_to_piece(i)[3:-1], 16)]) if model.is_byte(i) else b"" if model.is_control(i)
                          else model.id_to_piece(i).replace("▁", " ").encode("utf-8") for i in range(n)])

    def ids_of(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1) if texts else []


@lru_cache(maxsize=2)
def tokenizers(path_a: str, path_b: str) -> tuple[Tokenizer, Tokenizer]:
    return ByteTokenizer(path_a), PieceTokenizer(path_b)


class Cut(NamedTuple):
    """Windows as keys (ids of A, a separator, ids of B), the windows of each text, and shared ends by text."""

    keys: list[bytes]
    offsets: np.ndarray
    n_groups: np.ndarray


def cut_windows(ids_a: np.ndarray, n_a: np.ndarray, ids_b: np.ndarray, n_b: np.ndarray, a: Tokenizer, b: Tokenizer) -> Cut:
    """Cut the ids of many texts, which both tokenizers reproduce, at anchors."""
    if not len(ids_a):
        return Cut([], np.zeros(len(n_a) + 1, np.int64), np.zeros(len(n_a), np.int64))
    at_a = offsets_of(n_a)
    # offsets run on from text to text; both tokenizers give each text the same bytes
    ends_a, ends_b = np.cumsum(a.lengths[ids_a]), np.cumsum(b.lengths[ids_b])
    near = np.searchsorted(ends_b, ends_a)
    i = np.flatnonzero(ends_b[near] == ends_a)
    j = near[i]
    last = np.zeros(len(ids_a) + 1, bool)
    last[at_a] = True
    spaced_a, spaced_b = np.append(a.spaced[ids_a], True), np.append(b.spaced[ids_b], True)
    anchors = last[i + 1] | (spaced_a[i + 1] & spaced_b[j + 1])
    to_a, to_b = i[anchors] + 1, j[anchors] + 1
    from_a, from_b = np.append(0, to_a[:-1]), np.append(0, to_b[:-1])
    count = np.arange(len(to_a))
    place = from_a + from_b + count
    row = np.full(len(ids_a) + len(ids_b) + len(count), SEPARATOR, "<u4")
    row[np.arange(len(ids_a)) + np.repeat(from_b + count, to_a - from_a)] = ids_a
    row[np.arange(len(ids_b)) + np.repeat(to_a + count + 1, to_b - from_b)] = ids_b
    data, bounds = row.tobytes(), (4 * np.append(place, len(row))).tolist()
    keys = [data[x:y] for x, y in zip(bounds, bounds[1:])]
    return Cut(keys, np.searchsorted(to_a, at_a, "right"), np.diff(np.searchsorted(i + 1, at_a, "right")))


class Numbers:
    """Numbers that are appended to, and cut off again."""

    def __init__(self):
        self.data, self.size = np.zeros(1024, np.int64), 0

    def extend(self, values: np.ndarray) -> None:
        need = self.size + len(values)
        if need > len(self.data):
            self.data = np.append(self.data, np.zeros(max(need - len(self.data), len(self.data)), np.int64))
        self.data[self.size:need] = values
        self.size = need

    def values(self) -> np.ndarray:
        return self.data[:self.size]


def gathered(pool: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of each row, which lie in ``pool`` up to its end, and their offsets."""
    starts = np.append(0, ends[:-1])
    length = (ends - starts)[rows]
    total = offsets_of(length)
    return pool[np.repeat(starts[rows] - total[:-1], length) + np.arange(total[-1])], total


class Coded(NamedTuple):
    """The number of parts of each text, all their parts as numbers, and the ids of A and B of the different parts, with their counts."""

    n_parts: np.ndarray
    index: np.ndarray
    ids_a: np.ndarray
    n_a: np.ndarray
    ids_b: np.ndarray
    n_b: np.ndarray

    def packed(self) -> bytes:
        row = np.concatenate([[len(self.n_a)], self.index, self.n_a, self.n_b, self.ids_a, self.ids_b]).astype("<u4")
        return zstandard.compress(row.view("<u2").reshape(-1, 2).T.tobytes(), 1)

    @classmethod
    def unpacked(cls, n_parts: np.ndarray, data: bytes) -> Coded:
        low, high = np.frombuffer(zstandard.decompress(data), "<u2").reshape(2, -1)
        row = low + high.astype(np.int64) * 65536
        different, total = int(row[0]), int(n_parts.sum())
        index, n_a, n_b, ids = np.split(row[1:], np.cumsum([total, different, different]))
        return cls(n_parts, index, ids[:n_a.sum()], n_a, ids[n_a.sum():], n_b)

    def of_texts(self, values: np.ndarray) -> np.ndarray:
        """Sums by text of a value of each different part."""
        return np.diff(np.append(0, np.cumsum(values[self.index]))[offsets_of(self.n_parts)])


class Parts:
    """Ids of the parts of texts. Parts that come a second time are kept, until the table is full; others are for their batch alone."""

    def __init__(self, a: Tokenizer, b: Tokenizer):
        self.a, self.b = a, b
        self.number: dict[str, int] = {}
        self.whole, self.end_a, self.end_b, self.ids_a, self.ids_b = (Numbers() for _ in range(5))
        self.size, self.met = 0, bytearray(MET_BYTES)

    def parts_of(self, text: str) -> list[str]:
        if not (self.a.by_parts and self.b.by_parts):
            return [text]
        return text.split(" ") if single_spaces(text) else SINGLE_SPACE.split(text)

    def _met_before(self, part: str) -> bool:
        """Whether a short part (or, rarely, another of its hash) was met in an earlier batch: one that comes once takes no place."""
        place = hash(part) & (8 * len(self.met) - 1)
        byte, bit = place >> 3, 1 << (place & 7)
        if len(part) > LONGEST_KEY or self.met[byte] & bit:
            return len(part) <= LONGEST_KEY
        self.met[byte] |= bit
        return False

    def learn(self, parts: list[str]) -> None:
        (ids_a, n_a, whole_a), (ids_b, n_b, whole_b) = self.a.encode(parts), self.b.encode(parts)
        self.whole.extend(whole_a & whole_b)
        for ids, n, pool, ends in ((ids_a, n_a, self.ids_a, self.end_a), (ids_b, n_b, self.ids_b, self.end_b)):
            ends.extend(pool.size + np.cumsum(n))
            pool.extend(ids)
        self.number.update(zip(parts, range(len(self.number), len(self.number) + len(parts))))
        self.size += sum(map(len, parts)) + len(parts) * ENTRY_BYTES + 8 * (len(ids_a) + len(ids_b))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A of all texts and their number in each, and the same of B; a text not reproduced has none."""
        coded = self.coded(texts)
        out = []
        for ids, n in ((coded.ids_a, coded.n_a), (coded.ids_b, coded.n_b)):
            out += [gathered(ids, np.cumsum(n), coded.index)[0], coded.of_texts(n)]
        return tuple(out)

    def coded(self, texts: list[str]) -> Coded:
        """The parts of texts and their ids; a text not reproduced has no parts."""
        cut = [self.parts_of(t) if t else [] for t in texts]
        new = list(set().union(*cut).difference(self.number))
        known = [self._met_before(p) for p in new]
        before = self._mark()
        self.learn([p for p, k in zip(new, known) if k])
        kept = self._mark()
        self.learn([p for p, k in zip(new, known) if not k])
        parts = np.fromiter(map(self.number.__getitem__, chain.from_iterable(cut)), np.int64)
        offsets = offsets_of([len(c) for c in cut])
        if not self.whole.values().all():  # as a whole, a text may be reproduced all the same; else it has no tokens
            good = self.whole.values()[parts]
            for i in [i for i, c in enumerate(cut) if c and not good[offsets[i]:offsets[i + 1]].all()]:
                if texts[i] not in self.number:
                    self.learn([texts[i]])
                    new.append(texts[i])
                cut[i] = [texts[i]] if self.whole.values()[self.number[texts[i]]] else []
            parts = np.fromiter(map(self.number.__getitem__, chain.from_iterable(cut)), np.int64)
            offsets = offsets_of([len(c) for c in cut])
        met = np.zeros(len(self.number) + 1, bool)
        met[parts] = True
        used, place = np.flatnonzero(met), np.cumsum(met) - 1
        out = [np.diff(offsets), place[parts]]
        for ids, ends in ((self.ids_a, self.end_a), (self.ids_b, self.end_b)):
            found, at = gathered(ids.values(), ends.values(), used)
            out += [found, np.diff(at)]
        self._back(kept if kept[3] <= CACHE_BYTES else before, new)
        return Coded(*out)

    def _mark(self) -> tuple[int, int, int, int]:
        return len(self.number), self.ids_a.size, self.ids_b.size, self.size

    def _back(self, mark: tuple[int, int, int, int], new: list[str]) -> None:
        n, self.ids_a.size, self.ids_b.size, self.size = mark
        for part in new:
            if self.number.get(part, -1) >= n:
                del self.number[part]
        self.whole.size = self.end_a.size = self.end_b.size = n


class Windows:
    """Numbers of windows by their tuples of ids, so that each is aligned once; a full table starts anew."""

    def __init__(self):
        self.number: dict[bytes, int] = {}
        self.keys: list[bytes] = []
        self.size = 0

    def of(self, keys: list[bytes]) -> np.ndarray:
        for key in set(keys).difference(self.number):
            self.number[key] = len(self.keys)
            self.keys.append(key)
            self.size += len(key) + 2 * ENTRY_BYTES
        return np.fromiter(map(self.number.__getitem__, keys), np.int64, len(keys))

    def full(self) -> bool:
        return self.size > CACHE_BYTES


def links(keys: list[bytes], a: Tokenizer, b: Tokenizer) -> tuple[np.ndarray, np.ndarray]:
    """Pair (A id << 32 | B id) and number of the window of every link, window by window.

    The ends of both tokenizations cut a window into stretches; each lies in one token of A and one of B, which it links.
    """
    row, size = np.frombuffer(b"".join(keys), "<u4").astype(np.int64), np.array([len(k) // 4 for k in keys])
    window = np.repeat(np.arange(len(keys)), size)
    marks = np.flatnonzero(row == SEPARATOR)
    place = np.arange(len(row))
    is_a, is_b = place < marks[window], place > marks[window]
    ids_a, ids_b = row[is_a], row[is_b]
    ends_a, ends_b = np.cumsum(a.lengths[ids_a]), np.cumsum(b.lengths[ids_b])
    ends = np.union1d(ends_a, ends_b)
    i, j = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
    return ids_a[i] << 32 | ids_b[j], window[is_a][i]


def groups_text(key: bytes, a: Tokenizer, b: Tokenizer) -> str:
    """The groups of one window: `a1,a2|b1;a3|b2,b3`."""
    row = np.frombuffer(key, "<u4").tolist()
    mark = row.index(SEPARATOR)
    ids_b, out = row[mark + 1:], []
    first_a = first_b = at_b = end_a = end_b = 0
    for at_a, token in enumerate(row[:mark], 1):
        end_a += len(a.pieces[token])
        while end_b < end_a:
            end_b += len(b.pieces[ids_b[at_b]])
            at_b += 1
        if end_b == end_a:
            out.append(",".join(map(str, row[first_a:at_a])) + "|" + ",".join(map(str, ids_b[first_b:at_b])))
            first_a, first_b = at_a, at_b
    return ";".join(out)


class Counted:
    """The pairs' counts in the shared folder: files of sorted pairs, in order, opened when first used."""

    def __init__(self, files: list[tuple[int, str]]):
        self.first = np.array([first for first, _ in files], np.int64)
        self.paths, self.open = [path for _, path in files], {}

    def find(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count of each pair, and whether it is the highest of its B id."""
        count, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), bool)
        of = np.searchsorted(self.first, pairs, "right") - 1
        for f in np.unique(of).tolist():
            if f not in self.open:
                self.open[f] = np.load(self.paths[f], mmap_mode="r")
            table, some = self.open[f], of == f
            at = np.searchsorted(table[0], pairs[some])
            count[some], best[some] = np.abs(table[1][at]), table[1][at] < 0  # a count below 0 marks the best
        return count, best


class Aligned:
    """Windows that were aligned, with their groups as text and the sums of their links; a full table starts anew."""

    def __init__(self, files: list[tuple[int, str]]):
        self.counted = Counted(files)
        self.clear()

    def clear(self) -> None:
        self.table, self.texts, self.best, self.total = Windows(), [], Numbers(), Numbers()

    def of(self, keys: list[bytes], a: Tokenizer, b: Tokenizer) -> np.ndarray:
        if self.table.full():
            self.clear()
        found = self.table.of(keys)
        new = self.table.keys[len(self.texts):]
        if new:
            pairs, window = links(new, a, b)
            n, is_best = self.counted.find(pairs)
            starts = np.searchsorted(window, np.arange(len(new)))
            self.best.extend(np.add.reduceat(is_best.astype(np.int64), starts))
            self.total.extend(np.add.reduceat(n, starts))
            self.texts += [groups_text(k, a, b) for k in new]
            self.table.size += sum(map(len, self.texts[-len(new):]))
        return found


KEPT = {}


def kept(key: tuple, make):
    """The table that a worker keeps from task to task: one at a time, bounded in bytes by itself."""
    if key not in KEPT:
        KEPT.clear()
        KEPT[key] = make()
    return KEPT[key]


def added(done: tuple[np.ndarray, np.ndarray], keys: list[bytes], n: np.ndarray, a: Tokenizer, b: Tokenizer) -> tuple[np.ndarray, np.ndarray]:
    """Sums by pair, and the pairs of windows that were seen n times."""
    if not keys:
        return done
    pairs, window = links(keys, a, b)
    found, at = np.unique(np.append(done[0], pairs), return_inverse=True)
    sums = np.zeros(len(found), np.int64)
    np.add.at(sums, at, np.append(done[1], n[window]))
    return found, sums


ENCODED = "ids array<long>, n_parts array<long>, coded binary, pair long, n long"


def encode_and_count(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """From (id, text): rows with the packed ids of some texts each, and rows (pair, n) of links counted by a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = tokenizers(path_a, path_b)
        parts, table, seen = kept(("parts", path_a, path_b), lambda: Parts(a, b)), Windows(), np.zeros(0, np.int64)
        done = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in slices(batches, 1):
            coded = parts.coded(batch.column(1).to_pylist())
            cut = cut_windows(coded.ids_a, coded.n_a, coded.ids_b, coded.n_b, a, b)
            found = table.of(cut.keys)
            times = np.repeat(np.bincount(coded.index, minlength=len(coded.n_a)), np.diff(cut.offsets))
            now = np.zeros(len(table.keys), np.int64)
            np.add.at(now, found, times)
            now[:len(seen)] += seen
            seen = now
            if table.full():
                done, table, seen = added(done, table.keys, seen, a, b), Windows(), seen[:0]
            yield row([batch.column(0).to_pylist()], [coded.n_parts.tolist()], [coded.packed()], [None], [None])
        pairs, n = added(done, table.keys, seen, a, b)
        nothing = [None] * len(pairs)
        yield row(nothing, nothing, nothing, pairs, n)

    def row(*columns) -> pa.RecordBatch:
        kinds = (pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["ids", "n_parts", "coded", "pair", "n"])

    return docs.mapInArrow(run, ENCODED)


def store_counts(counts: DataFrame) -> list[tuple[int, str]]:
    """Write pair counts as sorted files; (first pair, path) of each, in order: one entry for each partition."""
    folder = mounted_path(shared_folder(counts.sparkSession, "pair-counts"))
    counts = materialize(counts, "pairs")
    highest = counts.groupBy((F.col("pair").bitwiseAND(0xFFFFFFFF)).alias("b")).agg(F.max("n").alias("most"))
    marked = counts.withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF)).join(highest, "b")
    marked = marked.select("pair", F.when(F.col("n") == F.col("most"), -F.col("n")).otherwise(F.col("n")).alias("n"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if parts:
            table = np.stack([np.concatenate(x) for x in zip(*parts)])
            path = os.path.join(folder, f"{int(table[0][0]):020d}.npy")
            write_once(path, lambda out: np.save(out, table))
            yield pa.RecordBatch.from_arrays([pa.array([int(table[0][0])]), pa.array([path])], names=["first", "path"])

    files = marked.repartitionByRange("pair").sortWithinPartitions("pair").mapInArrow(write, "first long, path string")
    return sorted((r.first, r.path) for r in files.select(F.col("first"), "path").toLocalIterator())


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every text."""
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    encoded = materialize(encode_and_count(slim, path_a, path_b), "encoded-twice")
    files = store_counts(encoded.where("pair is not null").groupBy("pair").agg(F.sum("n").alias("n")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = tokenizers(path_a, path_b)
        aligned = kept(("windows", path_a, path_b, tuple(files[:1])), lambda: Aligned(files))  # the first path tells runs apart
        for batch in slices(batches, rows=1):
            ids = batch.column(0)[0].as_py()
            coded = Coded.unpacked(np.array(batch.column(1)[0].as_py(), np.int64), batch.column(2)[0].as_py())
            cut = cut_windows(coded.ids_a, coded.n_a, coded.ids_b, coded.n_b, a, b)
            found = aligned.of(cut.keys, a, b)
            of_part = lambda column: np.diff(np.append(0, np.cumsum(column.values()[found]))[cut.offsets])
            written, bounds = list(map(aligned.texts.__getitem__, found.tolist())), cut.offsets.tolist()
            written = [";".join(written[x:y]) for x, y in zip(bounds, bounds[1:])]
            written, bounds = list(map(written.__getitem__, coded.index.tolist())), offsets_of(coded.n_parts).tolist()
            digests = [hashlib.sha256(";".join(written[x:y]).encode("ascii")).hexdigest() if y > x else "" for x, y in zip(bounds, bounds[1:])]
            columns = [coded.of_texts(c) for c in (coded.n_a, coded.n_b, cut.n_groups, coded.n_a + coded.n_b - cut.n_groups, of_part(aligned.best), of_part(aligned.total))]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array(c, pa.int64()) for c in columns), pa.array(digests, pa.string())],
                                             names=[id_col, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    coded = encoded.where("coded is not null").select("ids", "n_parts", "coded")
    return coded.mapInArrow(run, f"{id_col} long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
