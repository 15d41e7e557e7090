"""BPE encoding and decoding: backtracking over Aho-Corasick longest matches.

Encoding: the automaton finds, for every position of a pre-token, the longest vocabulary entry that
starts there. The encoder takes it if it may follow the token before, and else a shorter prefix or
a step back; a table of pair compatibility says whether two tokens can stand side by side in
a merged sequence. Positions that failed are never tried again, so the work is linear in the pre-token. The
result is exactly that of applying the merges by rank.

Decoding: one offset table into the concatenated strings of all tokens, gathered in one step for a whole batch.

The vocabulary file is a parameter; it must be a byte-level BPE whose merged tokens each have one merge.

Defined cases: a null text is encoded as the empty text (no ids, empty decoding); texts of any
length are encoded whole; repeated rows each give a row; an empty table gives an empty table; columns other than
id and text are not read, whatever their names.
"""
from __future__ import annotations

import json
import struct
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reqtrail.llm.common import offsets_of, slices, text_bytes

#: White-space-free chunks whose ids a worker remembers; when full, it starts anew.
CHUNK_CACHE = 200_000
END = "\n"  # stands for the word-end suffix; no byte is written as it


def byte_letters() -> list[str]:
    """The letter that a byte-level vocabulary writes for each byte: printable bytes as themselves, others from 256 up."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Tokens, merges and the tables made from them. Internal token numbers rise with merge rank."""

    def __init__(self, path: str):
        import ahocorasick
        import regex
        from tokenizers import Regex, Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        suffix = model["end_of_word_suffix"] or ""
        vocab = model["vocab"]
        letters = byte_letters()
        base = [x for x in letters if x in vocab] + ([x + suffix for x in letters if x + suffix in vocab] if suffix else [])
        number = {t: i for i, t in enumerate(base)}
        self.symbols = [t[0] + (END if t != t[0] else "") for t in base]
        self.split: list[tuple[int, int]] = [(i, i) for i in range(len(base))]
        self.pairs: dict[tuple[int, int], int] = {}
        for merge in model["merges"]:
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            a, b, whole = number[left], number[right], left + right
            if whole in number:
                raise ValueError(f"token {whole!r} has two merges; pair compatibility needs one")
            number[whole] = self.pairs[a, b] = len(self.split)
            self.split.append((a, b))
            self.symbols.append(self.symbols[a] + self.symbols[b])
        self.ids = [vocab[token] for token in number]  # in the order of the numbers
        self.lengths = [len(s) for s in self.symbols]
        by_symbols = {s: i for i, s in enumerate(self.symbols)}
        self.automaton = ahocorasick.Automaton()
        for s, i in by_symbols.items():
            self.automaton.add_word(s, i)
        self.automaton.make_automaton()
        #: The next shorter token that is a prefix of a token, -1 if none.
        self.shorter = [next((by_symbols[s[:k]] for k in range(len(s) - 1, 0, -1) if s[:k] in by_symbols), -1)
                        for s in self.symbols]
        self.compatible: dict[tuple[int, int], bool] = {}
        self.suffix = suffix
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.nfc, self.lower = self._normalizers(spec["normalizer"])
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(pattern.replace(r"\s", r"\p{White_Space}")).findall
        self.library = Tokenizer.from_file(path)
        self.library_pieces = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        self.letters = {b: x for b, x in enumerate(letters)}
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        strings = [(names.get(i, "") + " ").encode() for i in range(max(names) + 1)]
        self.pool = np.frombuffer(b"".join(strings), np.uint8)
        self.pool_lengths = np.array([len(s) for s in strings], np.int32)
        self.pool_offsets = offsets_of(self.pool_lengths)

    @staticmethod
    def _normalizers(spec: dict | None) -> tuple[bool, bool]:
        kinds = [x["type"] for x in (spec or {}).get("normalizers", [spec] if spec else [])]
        if not set(kinds) <= {"NFC", "Replace", "Lowercase"}:
            raise ValueError(f"normalizers {kinds} are not supported")
        return "NFC" in kinds, "Lowercase" in kinds

    def may_follow(self, left: int, right: int) -> bool:
        """Whether merging the two tokens' symbols by rank leaves exactly these two tokens."""
        a, b, limit, answer = left, right, len(self.split), True
        while True:
            merged = self.pairs.get((a, b))
            if merged is not None and merged < limit:
                answer = False
                break
            # undo the later of the two tokens' last merges; what stood at the border before must not have merged earlier
            if a > b:
                limit, a = a, self.split[a][1]
                if a == limit:
                    limit, b = b + 1, self.split[b][0]
                    if b + 1 == limit:
                        break
            else:
                limit, b = b + 1, self.split[b][0]
                if b + 1 == limit:
                    limit, a = a, self.split[a][1]
                    if a == limit:
                        break
        self.compatible[left, right] = answer
        return answer

    def encode_piece(self, piece: str) -> list[int]:
        """Internal tokens of one pre-token, written in byte letters and the end mark."""
        n, lengths, shorter = len(piece), self.lengths, self.shorter
        longest = [-1] * n
        for end, token in self.automaton.iter(piece):
            longest[end + 1 - lengths[token]] = token  # ends rise, so the longest comes last
        open_ = bytearray(b"\1") * (n + 1)
        if self.suffix:
            open_[n - 1] = 0  # the end mark is part of the last symbol
        tokens: list[int] = []
        at, token, last, known = 0, longest[0], -1, self.compatible
        while at < n:
            while token >= 0:
                if open_[at + lengths[token]]:
                    fits = last < 0 or known.get((last, token))
                    if fits or fits is None and self.may_follow(last, token):
                        break
                token = shorter[token]
            if token >= 0:
                tokens.append(token)
                at += lengths[token]
                last, token = token, longest[at] if at < n else -1
            else:
                if last < 0:
                    raise ValueError(f"{piece!r} has symbols outside the vocabulary")
                open_[at] = 0
                token = tokens.pop()
                at -= lengths[token]
                last = tokens[-1] if tokens else -1
        return tokens

    def encode_word(self, piece: str) -> bytes:
        """Ids (little-endian int32) of one pre-token."""
        if not (piece.isascii() and piece.isprintable()):
            piece = piece.encode("utf-8").decode("latin-1").translate(self.letters)
        tokens = self.encode_piece(piece + END if self.suffix else piece)
        return struct.pack(f"<{len(tokens)}i", *map(self.ids.__getitem__, tokens))

    def encode_chunk(self, chunk: bytes, ids_of: Callable[[str], bytes] | None = None) -> bytes:
        """Ids (little-endian int32) of a chunk of text without ASCII white space; ``ids_of``: of a pre-token."""
        text = chunk.decode("utf-8")
        out: list[bytes] = []
        for part in self.at_special.split(text) if self.at_special and "<" in text else (text,):
            if part in self.special:
                out.append(struct.pack("<i", self.special[part]))
            else:
                out += map(ids_of or self.encode_word, self.pieces_of(part))
        return b"".join(out)

    def pieces_of(self, part: str) -> list[str]:
        """Pre-tokens of the normalized part."""
        if part.isascii():
            return self.pieces(part.lower() if self.lower else part)
        if "Cn" in map(unicodedata.category, part):  # letters newer than this Python: by the library's own tables
            part = self.library.normalizer.normalize_str(part) if self.library.normalizer else part
            return [part[slice(*span)] for _, span in self.library_pieces.pre_tokenize_str(part)]
        if self.nfc:
            part = unicodedata.normalize("NFC", part)
        # letter by letter: the case of a letter does not depend on its neighbours
        return self.pieces("".join(map(str.lower, part)) if self.lower else part)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes of many id sequences and their offsets: token strings joined by one space."""
        starts, lengths = self.pool_offsets[ids], self.pool_lengths[ids]
        ends_out = offsets_of(lengths)
        place = np.repeat((starts - ends_out[:-1]).astype(np.int32), lengths)  # a slice of rows stays far below 2 GB
        place += np.arange(ends_out[-1], dtype=np.int32)
        data, bounds = self.pool[place], ends_out[offsets]
        keep = np.ones(len(data), bool)
        filled = offsets[1:] > offsets[:-1]
        keep[bounds[1:][filled] - 1] = False  # no space after a text's last token
        return data[keep], bounds - np.concatenate(([0], np.cumsum(filled)))


class Remembered(dict):
    """Values made once for the keys seen first, and each time for others once it is full.

    Words that are frequent come early, so a full table keeps them; if many keys are missed all the same, the text
    has changed and it starts anew.
    """

    def __init__(self, size: int):
        self.size, self.missed = size, 0

    def make(self, key: bytes) -> bytes:
        raise NotImplementedError

    def __missing__(self, key: bytes) -> bytes:
        value = self.make(key)
        if len(self) < self.size:
            self[key] = value
        else:
            self.missed += 1
            if self.missed > 10 * self.size:
                self.clear()
                self.missed = 0
        return value


class Chunks(Remembered):
    """Ids of the chunks seen so far, and of their pre-tokens."""

    def __init__(self, vocabulary: Vocabulary, size: int = CHUNK_CACHE):
        super().__init__(size)
        pieces = Remembered(2 * size)
        pieces.make = vocabulary.encode_word
        self.make = lambda chunk: vocabulary.encode_chunk(chunk, pieces.__getitem__)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=2)
def chunks(path: str) -> Chunks:
    return Chunks(vocabulary(path))


def encode_texts(texts: list[bytes], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of many texts in one array, and the offsets of each text.

    No merge, normal form or pre-token reaches over ASCII white space, so chunks between it are encoded one by one.
    """
    ids_of = chunks(path).__getitem__
    out = [b"".join(map(ids_of, text.split())) for text in texts]
    return np.frombuffer(b"".join(out), "<i4"), offsets_of([len(x) // 4 for x in out])


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """(id, ids array<int>) of every text; with ``decoded`` also the string that the ids decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            ids, offsets = encode_texts(text_bytes(batch.column(1)), path)
            columns = [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))]
            if decoded:
                data, bounds = vocabulary(path).decode(ids, offsets)
                columns.append(pa.StringArray.from_buffers(batch.num_rows, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)))
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "ids", "decoded"][:len(columns)])

    slim = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, f"{id_col} long, ids array<int>" + ", decoded string" * decoded)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) from (id, ids); null ids decode to the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [np.array(x or (), np.int32) for x in batch.column(1).to_pylist()]
            ids = np.concatenate([*rows, np.zeros(0, np.int32)])
            data, bounds = vocabulary(path).decode(ids, offsets_of([len(x) for x in rows]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.StringArray.from_buffers(
                batch.num_rows, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data))], names=[id_col, "text"])

    slim = encoded.select(F.col(id_col).cast("long").alias(id_col), F.col(ids_col).alias("ids"))
    return slim.mapInArrow(run, f"{id_col} long, text string")
