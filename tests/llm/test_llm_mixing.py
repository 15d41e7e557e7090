"""Targets, budget fitting and selection, against plain Python."""
from __future__ import annotations

from collections import Counter, defaultdict

import llm_cases as C
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reqtrail.llm import mixing


def aims(sizes: dict) -> dict:
    """Targets by sharing out the excess again until no source is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, open_, out = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if weight[s] * level > 2 * sizes[s]}
        if not above:
            return out | {s: weight[s] * level for s in open_}
        out |= {s: 2.0 * sizes[s] for s in above}
        left -= sum(2 * sizes[s] for s in above)
        open_ -= above
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 60), st.integers(1, 5)), max_size=8, unique_by=lambda x: x[0]), st.integers(0, 400))
def test_programme_reaches_the_best_sum(items, budget):
    lengths, counts = [x for x, _ in items], [n for _, n in items]
    got = mixing.fit_programme(budget, lengths, counts)
    sums = {0}
    for length, n in items:
        sums = {s + k * length for s in sums for k in range(n + 1) if s + k * length <= budget}
    assert sum(k * v for k, v in got.items()) == max(sums)
    assert all(v <= dict(items)[k] for k, v in got.items())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3000), st.integers(1, 3000)), min_size=1, max_size=30, unique_by=lambda x: x[0]), st.floats(0, 2))
def test_fit_is_near_its_target(items, share):
    sizes, counts = np.array([x for x, _ in items]), np.array([n for _, n in items])
    total = int((sizes * counts).sum())
    whole, extra = mixing.fit(sizes, counts, share * total)
    taken = whole * total + int((sizes * extra).sum())
    assert (extra >= 0).all() and (extra <= counts).all() and whole + (extra > 0).max() <= 2
    assert taken <= share * total + 1 and taken >= share * total - sizes.max() - 1


@pytest.mark.parametrize("items, target, taken", [
    ({2_000_000: 3}, 10_000_000, 10_000_000),  # beyond the programme's reach
    ({7_000_000: 1, 6_000_000: 1, 4_000_000: 1}, 27_000_000, 27_000_000),  # the longest is not part of the best choice
    ({7_000_001: 1, 6_000_000: 1, 4_000_000: 1, 3: 2000}, 27_009_000, 27_008_998),
    ({50_000_000: 2}, 149_999_999, 100_000_000),
])
def test_long_documents_fit(items, target, taken):
    sizes, counts = np.array(list(items)), np.array(list(items.values()))
    whole, extra = mixing.fit(sizes, counts, target)
    assert int((sizes * (whole * counts + extra)).sum()) == taken and (extra <= counts).all()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3000), st.integers(1, 40)), min_size=1, max_size=12, unique_by=lambda x: x[0]), st.floats(0, 2))
def test_fit_beyond_the_programme(items, share):
    """With a programme of 64 words nearly every document is a long one."""
    sizes, counts = np.array([x for x, _ in items]), np.array([n for _, n in items])
    total = int((sizes * counts).sum())
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(mixing, "PROGRAMME", 64)
        whole, extra = mixing.fit(sizes, counts, share * total)
    taken = whole * total + int((sizes * extra).sum())
    assert (extra >= 0).all() and (extra <= counts).all() and whole + (extra > 0).max() <= 2
    assert share * total - sizes.max() - 1 <= taken <= share * total + 1


def test_rows_of_one_id_are_chosen_by_their_columns(spark):
    """A third of all rows has one id; texts of one length and other columns differ. Any order of rows gives the same mix."""
    rows = [(7 if i % 3 == 0 else i, f"word{i % 5} and {i % 11}", "s" if i % 2 else None, i) for i in range(300)]
    bag = []
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "doc_id long, text string, source string, other long").repartition(3)
        bag.append(sorted(tuple(map(str, r)) for r in mixing.mixed(df).collect()))
    assert bag[0] == bag[1] and bag[0]


def check(got, data):
    size = Counter()
    for _, t, _, s, _ in data:
        size[s] += len(C.words(t))
    want = aims(size)
    source = {(d, len(C.words(t))): s for d, t, _, s, _ in data}
    taken, most = Counter(), defaultdict(int)
    for r in got:
        s = source[r.doc_id, r.size]
        assert 0 <= r.taken <= 2 * r.size and r.source_size == size[s] and r.target == pytest.approx(want[s])
        taken[s] += r.taken
        most[s] = max(most[s], r.size)
    for s in want:
        assert want[s] - most[s] - 1 <= taken[s] <= want[s] + 1
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in got) == sorted((d is None, d or 0, len(C.words(t))) for d, t, *_ in data)


def test_mix_edge_cases_and_reruns(spark):
    got = mixing.mix(C.frame(spark)).collect()
    check(got, C.rows())
    assert sorted(map(str, mixing.mix(C.frame(spark).repartition(7)).collect())) == sorted(map(str, got))
    assert mixing.mix(C.frame(spark, [])).count() == 0
    blank = [(1, None, "en", "a", None), (2, " ", "en", None, 1)]
    assert {(r.size, r.target, r.taken) for r in mixing.mix(C.frame(spark, blank)).collect()} == {(0, 0.0, 0)}


def test_one_length_of_one_source_is_divided_into_buckets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 16)
    data = [(i, "a b c", "en", "x" if i % 10 else "y", 5) for i in range(2000)]
    check(mixing.mix(C.frame(spark, data, clashing=False)).collect(), data)


def test_mixed_repeats_rows(spark):
    data = C.rows()
    copies = Counter((r.doc_id, r.text) for r in mixing.mixed(C.frame(spark)).collect())
    have = Counter((d, t) for d, t, *_ in data)
    assert all(n <= 2 * have[k] for k, n in copies.items())
    taken = sum(len(C.words(t)) * n for (_, t), n in copies.items())
    assert taken == sum(r.taken for r in mixing.mix(C.frame(spark)).collect())
    assert mixing.mixed(C.frame(spark)).columns == C.frame(spark).columns
