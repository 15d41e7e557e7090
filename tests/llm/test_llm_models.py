"""Kneser-Ney scoring, quality rules and language identification, against brute force and held-out accuracy."""
from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter, defaultdict

import llm_cases as C
import numpy as np
import pytest
from pyspark.sql import functions as F

from reqtrail.llm import kneser_ney as kn
from reqtrail.llm import language_id, lm_scoring, quality
from reqtrail.llm.common import offsets_of, remainder


class BruteModel:
    """Interpolated modified Kneser-Ney over sequences of any symbols, by dictionaries."""

    def __init__(self, sequences, order, begin):
        self.order, self.begin = order, begin
        grams = Counter()
        for s in sequences:
            padded = [begin] * (order - 1) + s
            grams.update(tuple(padded[i:i + order]) for i in range(len(s)))
        self.levels = {}
        for k in range(order, 0, -1):
            d = [0.0, *kn.discounts([sum(v == c for v in grams.values()) for c in (1, 2, 3, 4)])]
            contexts = defaultdict(lambda: [0, 0, 0, 0])
            for g, v in grams.items():
                c = contexts[g[:-1]]
                c[0] += v
                c[min(v, 3)] += 1
            self.levels[k] = (grams, contexts, d)
            if k == 1:
                self.types = len(grams)
            grams = Counter(g[1:] for g in grams)

    def log10(self, s):
        padded, total = [self.begin] * (self.order - 1) + s, 0.0
        for i in range(len(s)):
            gram = tuple(padded[i:i + self.order])
            p = 1 / (self.types + 1)
            for k in range(1, self.order + 1):
                grams, contexts, d = self.levels[k]
                own = gram[self.order - k:]
                c = contexts.get(own[:-1])
                if c:
                    v = grams.get(own, 0)
                    p = max(v - d[min(v, 3)], 0) / c[0] + (d[1] * c[1] + d[2] * c[2] + d[3] * c[3]) / c[0] * p
            total += math.log10(p)
        return total


def tokens(t):
    return [C.lower(w) for w in C.words(t)] + ["\n"]


def test_lm_scores_against_brute_force(spark):
    data = C.rows()
    rest = lambda d, n: zlib.crc32(("" if d is None else str(d)).encode()) % n
    learned = [tokens(t) for d, t, *_ in data if rest(d, 7) != 2]
    counts = Counter(w for t in learned for w in t)
    n, v, model = sum(counts.values()), len(counts), BruteModel(learned, 2, "\t")
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in
                 lm_scoring.lm_scores(C.frame(spark), remainder(F.col("doc_id"), 7) == 2).collect())
    want = sorted((d is not None, d or 0, len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n,
                   sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t)), model.log10(tokens(t))) for d, t, *_ in data)
    for r, w in zip(got, want, strict=True):
        assert r == pytest.approx(w, rel=1e-6)


def test_probabilities_sum_to_one(spark):
    folder = lm_scoring.train(C.frame(spark).where("doc_id > 99"))
    model = kn.Model(folder)
    words = {w for d, t, *_ in C.rows() if (d or 0) > 99 for w in tokens(t)}
    hashes = [lm_scoring.tokens([w.encode()])[0][0] if w != "\n" else np.uint64(lm_scoring.END) for w in words] + [np.uint64(12345)]
    for context in (np.uint64(lm_scoring.BEGIN), hashes[0], hashes[3], np.uint64(999)):
        keys = np.array([(context & lm_scoring.LOW) << np.uint64(32) | (h & lm_scoring.LOW) for h in hashes], np.uint64)
        assert (10 ** model.log10(keys)).sum() == pytest.approx(1.0, abs=1e-9)


def test_nothing_to_learn_or_score(spark):
    assert lm_scoring.lm_scores(C.frame(spark, []), F.lit(False)).count() == 0
    r = lm_scoring.lm_scores(C.frame(spark, C.rows()[:1]), F.lit(True)).first()
    assert (r.n_known, r.train_tokens, r.base_score, r.score) == (0, 0, 0.0, 0.0)


def test_packing_and_merging():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 2**64 - 1, 1000, dtype=np.uint64))
    values = rng.integers(1, 2**31, (len(keys), 2))
    back = kn.unpack(kn.pack(keys, values))
    assert (back[0] == keys).all() and (back[1] == values).all()
    both, sums = kn.merged([(keys, values), (keys[::2], values[::2])])
    assert (both == keys).all() and (sums[::2] == 2 * values[::2]).all() and (sums[1::2] == values[1::2]).all()
    rows = list(kn.dealt("g", keys, values, 7))
    assert sorted(k for _, _, p in rows for k in kn.unpack(p)[0].tolist()) == keys.tolist()


def rules(t):
    w = C.words(t)
    windows = list(zip(w, w[1:], w[2:]))
    often, inside = Counter(windows), set()
    for i, x in enumerate(windows):
        if often[x] > 1:
            inside |= {i, i + 1, i + 2}
    seen, repeated = set(), 0
    for line in (t or "").split("\n"):
        if C.words(line):
            repeated += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), repeated, len(inside)


def test_quality_rules_and_perplexity_against_brute_force(spark):
    data = C.rows()
    got = sorted(((r.doc_id is not None, r.doc_id or 0, *(r[c] for c in quality.RULES), r.perplexity), r) for r in quality.quality(C.frame(spark)).collect())
    prose = [t for _, t, *_ in data if quality.is_prose(rules(t))]
    symbols = lambda t: ["0" if "0" <= c <= "9" else ord(c) & 0xFFFF for c in t or ""] + [2]
    fold = lambda t: zlib.crc32((t or "").encode()) % 2
    models = [BruteModel([symbols(t) for t in prose if fold(t) != own], quality.ORDER, 1) for own in (0, 1)]  # of the other half
    want = sorted((((d is not None, d or 0, *rules(t), -models[fold(t)].log10(symbols(t)) / len(symbols(t))), t, lang) for d, t, lang, *_ in data), key=lambda x: x[0])
    for (key, r), (other, t, _) in zip(got, want, strict=True):
        assert key == pytest.approx(other, rel=1e-6) and r.base_failed == quality.base_failed(rules(t))
        assert not (r.base_failed and r.kept)
    bands = defaultdict(list)
    for (_, r), (_, _, lang) in zip(got, want):
        if not r.base_failed:
            bands[lang].append(r.perplexity)
    middle_of = lambda p: sorted(p)[(len(p) - 1) // 2]
    for (_, r), (_, _, lang) in zip(got, want):
        if not r.base_failed:
            different = set(bands[lang])
            middle = middle_of(different)
            below, above = (middle_of([s * (x - middle) for x in different if s * (x - middle) >= 0]) for s in (-1, 1))
            wide = lambda side, m=middle: max(quality.WIDTH * 1.4826 * side, quality.LEAST * m)
            assert r.kept == (middle - wide(below) <= r.perplexity <= middle + wide(above))
    assert quality.quality(C.frame(spark, [])).count() == 0


def test_quality_bands_reject_junk_and_keep_prose(spark):
    good = [(i, C.prose(i, 150), "en", "a", 0) for i in range(60)]
    junk = [(100 + i, " ".join(w + "!%$*"[i % 4] * 3 for w in C.words(C.prose(300 + i, 90))), "en", "a", 0) for i in range(8)]
    kept = {r.doc_id for r in quality.quality(C.frame(spark, good + junk)).where("kept").collect()}
    assert kept >= set(range(60)) and len(kept) <= 60 + 2  # exclamation marks are no symbols


def test_quality_bands_reject_on_both_sides(spark):
    good = [(i, C.prose(i, 150), "en", "a", 0) for i in range(200)]
    copies = [(1000 + i, C.prose(0, 150), "en", "a", 0) for i in range(5)]
    low = [(2000 + i, C.prose(400 + i, 150, "th the"), "en", "a", 0) for i in range(3)]
    high = [(3000 + i, C.prose(500 + i, 1500, " ".join(a + b for a in "bcfgjkmpqvwxz" for b in "bcfgjkmpqvwxz")), "en", "a", 0) for i in range(3)]
    rows = quality.quality(C.frame(spark, good + copies + low + high)).collect()
    assert not any(r.base_failed for r in rows)
    assert {r.doc_id for r in rows if r.kept} == {d for d, *_ in good + copies}
    middle = sorted(r.perplexity for r in rows if r.doc_id < 1000)[100]
    assert all(0.4 * middle < r.perplexity < middle for r in rows if 2000 <= r.doc_id < 3000)  # not far enough for a floor on each side


def test_quality_texts_do_not_speak_for_themselves(spark):
    """A document without symbols, of letters that no other has, is rejected though it is short or comes many times."""
    letters = [a + b for a in "bcfgjkmpqvwxz" for b in "bcfgjkmpqvwxz"]
    good = [(i, C.prose(i, 150), "en", "a", 0) for i in range(200)]
    odd = [(3000 + i, C.prose(500 + i, 60, " ".join(letters[40 * i:40 * i + 40])), "en", "a", 0) for i in range(4)]
    copies = [(4000 + i, odd[0][1], "en", "a", 0) for i in range(30)]
    rows = quality.quality(C.frame(spark, good + odd + copies)).collect()
    assert not any(r.base_failed or r.n_symbols for r in rows)
    assert {r.doc_id for r in rows if r.kept} == {d for d, *_ in good}


@pytest.mark.parametrize("seed", range(5))
def test_viterbi_is_the_best_path(seed):
    rng = np.random.default_rng(seed)
    scores = (rng.normal(size=(40, 3)) * 3).astype(np.float32)
    lengths = [0, 1, 6, 4, 0, 7, 7, 2]
    rows, offsets = rng.integers(0, 40, sum(lengths)), offsets_of(lengths)
    labels = language_id.viterbi(scores, rows, offsets, 2.5)
    for a, b in zip(offsets, offsets[1:]):
        value = lambda p, a=a: sum(scores[rows[a + i], s] for i, s in enumerate(p)) - 2.5 * sum(x != y for x, y in zip(p, p[1:]))
        if b > a:
            assert value(labels[a:b]) == pytest.approx(max(map(value, itertools.product(range(3), repeat=b - a))), abs=1e-4)


FRENCH = "le la de que ou en eau é è ai ment tion au eux un re"
GREEK = "και το η αν στ λο γο μα τι κα ρι"


def test_language_spans_and_scripts(spark):
    data = [(i, C.prose(i, 80), "en", "a", 0) for i in range(30)] + [(100 + i, C.prose(i, 80, FRENCH), "fr", "a", 0) for i in range(30)]
    data += [(200 + i, C.prose(i, 80, GREEK), "el", "a", 0) for i in range(10)] + [(300, C.prose(1, 20), None, "a", 0)]
    folder = language_id.learn(C.frame(spark, data))
    asked = [(1, C.prose(900, 60), "x", "a", 0), (2, C.prose(901, 60, FRENCH), None, "a", 0), (3, C.prose(902, 30, GREEK), "en", "a", 0),
             (4, C.prose(903, 40) + " " + C.prose(904, 60, FRENCH), "en", "a", 0), (5, None, "en", "a", 0), (6, "12 -- 34 !", "en", "a", 0), (7, "", "en", "a", 0)]
    got = {r.doc_id: r for r in language_id.label(C.frame(spark, asked), folder, spans=True).collect()}
    assert {d: r.lang_pred for d, r in got.items()} == {1: "en", 2: "fr", 3: "el", 4: "fr", 5: "und", 6: "und", 7: "und"}
    assert 0.4 < got[4].score < 0.85 and got[3].score == 1.0 and got[5].score == 0.0
    assert [s.lang for s in got[4].spans] == ["en", "fr"] and abs(got[4].spans[0].end - 40) <= 3
    edge = language_id.label(C.frame(spark), folder).collect()
    assert len(edge) == len(C.rows()) and all(0 <= r.score <= 1 for r in edge)
    assert language_id.languages(C.frame(spark, []), F.lit(False)).count() == 0
    assert {r.lang_pred for r in language_id.languages(C.frame(spark), F.lit(True)).collect()} == {"und"}
