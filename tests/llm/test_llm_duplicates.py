"""SimHash fingerprints, the trie self-join and components, against all pairs."""
from __future__ import annotations

import llm_cases as C
import numpy as np
import pytest
import xxhash

from reqtrail.llm import simhash
from reqtrail.llm.components import components


def fingerprint(text, width=3) -> int:
    w = [C.lower(x) for x in C.words(text)]
    shingles = [" ".join(w[i:i + width]) for i in range(len(w) - width + 1)] if len(w) >= width else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints: np.ndarray, distance: int) -> list[int]:
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= distance
    label = np.arange(len(prints))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return label.tolist()
        label = new


def test_near_duplicates_edge_cases(spark):
    got = sorted(((r.doc_id is not None, r.doc_id or 0, r.fingerprint & (2**64 - 1), r.component_id) for r in simhash.near_duplicates(C.frame(spark)).collect()), key=str)
    data = C.rows()
    prints = [fingerprint(r[1]) for r in data]
    label = groups(np.array(prints, np.uint64), 3)
    least = {g: min((r[0] for r, x in zip(data, label) if x == g and r[0] is not None), default=None) for g in set(label)}
    assert got == sorted(((r[0] is not None, r[0] or 0, p, least[g]) for r, p, g in zip(data, prints, label)), key=str)
    assert simhash.near_duplicates(C.frame(spark, [])).count() == 0


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    text = C.prose(9, 500).encode()
    whole = simhash.fingerprints([text, b"", text], 3)
    monkeypatch.setattr(simhash, "HASHES", 37)
    assert (simhash.fingerprints([text, b"", text], 3) == whole).all() and int(whole[0]) == fingerprint(text.decode())


@pytest.mark.parametrize("trie_rows", [50_000, 30])
@pytest.mark.parametrize("distance", [0, 1, 3])
def test_trie_join_finds_every_link(spark, trie_rows, distance):
    """Random groups, and many fingerprints that share a block (small tries divide them below their root)."""
    rng = np.random.default_rng(distance)
    out = []
    for base in rng.integers(0, 2**63, 15):
        for _ in range(30):
            x = int(base)
            for k in rng.integers(0, 64, rng.integers(0, 4)):
                x ^= 1 << int(k)
            out.append(x)
    out += [int(x) & 0xFFFFFFFF0000FFFF | 0x12340000 for x in rng.integers(0, 2**63, 300)] + [0, 2**64 - 1]
    prints = np.unique(np.array(out, np.uint64))
    df = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fingerprint long")
    links = [(r.a & (2**64 - 1), r.b & (2**64 - 1)) for r in simhash.near_links(df, distance, trie_rows).collect()]
    assert all((a ^ b).bit_count() <= distance for a, b in links)
    parent = {int(x): int(x) for x in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    label = groups(prints, distance)
    assert len(set(zip(label, map(find, map(int, prints))))) == len(set(label)) == len({find(int(x)) for x in prints})
    assert len(links) <= (distance + 1) * len(prints)  # forests, never all pairs


def test_a_dense_group_gives_a_forest(spark):
    base = 0x0123456789ABCDEF
    dense = sorted({base ^ (1 << i) ^ (1 << j) for i in range(40) for j in range(i, 40)})
    df = spark.createDataFrame([(x - 2**64 if x >= 2**63 else x,) for x in dense], "fingerprint long")
    assert simhash.near_links(df, 3).count() < 4 * len(dense)


def test_components(spark):
    chain = [(i, i + 1) for i in range(30)] + [(100, 90), (90, 95), (7, 7), (None, 3), (200, 201), (201, 200), (200, 201)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(1, 31)}, 95: 90, 100: 90, 201: 200}
    star = spark.range(1, 2000).selectExpr("id as a", "0L as b")
    assert components(star, "a", "b").where("root = 0").count() == 1999
    assert components(star.where("a < 0"), "a", "b").count() == 0


def test_one_of_each_keeps_one_row_of_a_group(spark):
    data = C.rows()
    kept = [(r.doc_id, r.text) for r in simhash.one_of_each(C.frame(spark)).collect()]
    label = groups(np.array([fingerprint(r[1]) for r in data], np.uint64), 3)
    assert len(kept) == len(set(label))
    for d, t in kept:
        group = [r for r, g in zip(data, label) if g == label[[x[:2] for x in data].index((d, t))]]
        assert d == min((r[0] for r in group if r[0] is not None), default=None)
    assert simhash.one_of_each(C.frame(spark, [])).columns == C.frame(spark, []).columns
