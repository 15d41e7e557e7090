"""Cross-tokenizer alignment against a byte-by-byte form that uses the libraries on whole texts."""
from __future__ import annotations

import hashlib
from collections import Counter

import llm_cases as C
import numpy as np
import pytest

from reqtrail.llm import alignment, queries
from reqtrail.llm.bpe import byte_letters

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
HARD = ["a  b", " lead", "trail ", "x▁y z", "a\n b\n\nc d \n", "<|endoftext|> <s> <unk> <0x41>", "漢字かな交じり文" * 300,
        "\xa0a b \x1c c\x00", " ", "  ", "tab\tsep\r\nnew x' s't 're", "é ́ x", "\U0001F600 \U0001F600"]


def spans(tokens: list[tuple[int, bytes]]) -> list[tuple[int, int, int]]:
    out, at = [], 0
    for i, b in tokens:
        out.append((at, at + len(b), i))
        at += len(b)
    return out


def brute(data: list[tuple]) -> list[tuple]:
    import sentencepiece
    from tokenizers import Tokenizer

    of_a, of_b = Tokenizer.from_file(queries.tokenizer_path(A)), sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer_path(B))
    of_a.encode_special_tokens = True
    byte_of = {x: b for b, x in enumerate(byte_letters())}
    docs, count = [], Counter()
    for doc_id, text in data:
        text, a, b, links = text or "", [], [], []
        if text:
            e = of_a.encode(" " + text, add_special_tokens=False)
            a = [(i, bytes(byte_of[x] for x in t)) for i, t in zip(e.ids, e.tokens)]
            b = [(i, bytes([int(of_b.id_to_piece(i)[3:-1], 16)]) if of_b.is_byte(i) else of_b.id_to_piece(i).replace("▁", " ").encode()) for i in of_b.encode(text)]
            if any(b"".join(x for _, x in t) != (" " + text).encode() for t in (a, b)):
                a = b = []
        a, b, first = spans(a), spans(b), 0
        for low, high, i in a:
            while b[first][1] <= low:
                first += 1
            at = first
            while at < len(b) and b[at][0] < high:
                links.append((i, b[at][2]))
                at += 1
        groups, x, y = [], 0, 0
        for end in sorted({e for _, e, _ in a} & {e for _, e, _ in b}):
            parts = [[], []]
            while x < len(a) and a[x][1] <= end:
                parts[0].append(str(a[x][2]))
                x += 1
            while y < len(b) and b[y][1] <= end:
                parts[1].append(str(b[y][2]))
                y += 1
            groups.append("|".join(map(",".join, parts)))
        docs.append((doc_id, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
        count.update(links)
    top = Counter()
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    return [(d, na, nb, g, len(ls), sum(count[p] == top[p[1]] for p in ls), sum(count[p] for p in ls), h) for d, na, nb, g, ls, h in docs]


def align(docs):
    return alignment.align(docs, queries.tokenizer_path(A), queries.tokenizer_path(B))


def test_equals_brute_force(spark):
    data = [(r[0], r[1]) for r in C.rows()] + [(900 + i, t) for i, t in enumerate(HARD)]
    got = align(C.frame(spark, [(d, t, None, None, None) for d, t in data]))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute(data), key=repr)


def pair():
    return alignment.ByteTokenizer(queries.tokenizer_path(A)), alignment.PieceTokenizer(queries.tokenizer_path(B))


@pytest.mark.parametrize("size", [0, 40_000, 10**9])
def test_full_tables_give_the_same(spark, monkeypatch, size):
    """Parts beyond the table's bytes are used for their own batch alone; a full table of windows starts anew."""
    texts = [C.prose(i, 400) for i in range(12)] + HARD + ["x" * 500]
    a, b = pair()
    want = [[t.ids_of([x])[0] for t in (a, b)] for x in texts]
    bad = [any(t.written(np.array(ids, np.int64)).tobytes() != (" " + x).encode() for t, ids in zip((a, b), w)) for x, w in zip(texts, want)]
    monkeypatch.setattr(alignment, "CACHE_BYTES", size)
    parts = alignment.Parts(a, b)
    for text, ids, wrong in zip(texts * 3, want * 3, bad * 3):
        got = parts.encode([text])
        assert [got[0].tolist(), got[2].tolist()] == ([[], []] if wrong else ids)
        assert parts.size <= size and all(len(p) <= alignment.LONGEST_KEY for p in parts.number)
        assert len(parts.number) == parts.whole.size == parts.end_a.size
    assert size < 10**9 or parts.number


def test_parts_give_the_ids_of_whole_texts():
    a, b = pair()
    assert a.by_parts and b.by_parts
    parts = alignment.Parts(a, b)
    for tokenizer in (a, b):
        for text in [t for _, t, *_ in C.rows() if t] + HARD:
            ids, counts, _ = tokenizer.encode(parts.parts_of(text))
            assert ids.tolist() == tokenizer.ids_of([text])[0] and counts.sum() == len(ids), text
            assert counts.tolist() == [len(x) for x in tokenizer.ids_of(parts.parts_of(text))]


def test_quick_library_gives_the_same_ids():
    a, _ = pair()
    assert a.quick
    points = [chr(i) for i in range(1, 0x110000) if not 0xD800 <= i < 0xE000]
    for i in range(0, len(points), 4000):  # after and before letters, digits, signs, breaks and spaces
        text = "".join(f" x{c}y7{c}8!{c}?\n{c} {c}" for c in points[i:i + 4000])
        assert a.quick.encode_ordinary(" " + text) == a.ids_of([text])[0], hex(ord(points[i]))
    for text in [t for _, t, *_ in C.rows() if t] + HARD + ["ab" * 3000, "漢字" * 2000]:
        assert a.quick.encode_ordinary(" " + text) == a.ids_of([text])[0]


def test_empty_table(spark):
    assert align(C.frame(spark, [])).collect() == []


@pytest.mark.parametrize("text", ["the cat", "unbelievable thing's", "1234567 antidisestablishmentarianism"])
def test_links_follow_from_the_groups(text):
    a, b = pair()
    ids_a, n_a, ids_b, n_b = alignment.Parts(a, b).encode([text])
    cut = alignment.cut_windows(ids_a, n_a, ids_b, n_b, a, b)
    pairs, window = alignment.links(cut.keys, a, b)
    assert len(pairs) == n_a[0] + n_b[0] - cut.n_groups[0] and window.max() == len(cut.keys) - 1
    assert ";".join(alignment.groups_text(k, a, b) for k in cut.keys).count(";") == cut.n_groups[0] - 1
