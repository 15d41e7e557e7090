"""Merge operators against a plain-Python model of the document-store updates."""
from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from reqtrail.operators import merge

KEYS = st.sampled_from([f"k{i}" for i in range(8)])
VAL = st.one_of(st.none(), st.sampled_from(["x", "y", "z"]))
ROWS = st.dictionaries(KEYS, st.tuples(VAL, st.integers(0, 5)), max_size=8)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
SCHEMA = "k string, a string, b long"


def frame(spark, rows):
    return spark.createDataFrame([(k, a, b) for k, (a, b) in rows.items()], SCHEMA)


@SETTINGS
@given(tgt=ROWS, src=ROWS)
def test_upsert_matches_model(spark, tgt, src):
    model = {k: (src[k][0], v[1]) if k in src else v for k, v in tgt.items()}
    model.update({k: (v[0], None) for k, v in src.items() if k not in tgt})
    got = {r["k"]: (r["a"], r["b"]) for r in merge.upsert(frame(spark, tgt), frame(spark, src), ["k"], ["a"]).collect()}
    assert got == model


@SETTINGS
@given(tgt=ROWS, src=ROWS)
def test_update_only_matches_model(spark, tgt, src):
    model = {k: (src[k][0], v[1]) if k in src else v for k, v in tgt.items()}
    out = merge.update_only(frame(spark, tgt), frame(spark, src), ["k"], ["a"])
    assert {r["k"]: (r["a"], r["b"]) for r in out.collect()} == model
    assert {r["k"] for r in merge.unmatched(frame(spark, tgt), frame(spark, src), ["k"]).collect()} == set(src) - set(tgt)


CHILD = st.lists(st.tuples(KEYS, st.sampled_from(["p", "q"]), st.integers(0, 3)), max_size=12)


@SETTINGS
@given(old=CHILD, new=CHILD, dedup=st.booleans())
def test_replace_children_matches_model(spark, old, new, dedup):
    schema = "k string, v string, _ord long"
    new_rows = [(k, v, i) for i, (k, v, _) in enumerate(new)]
    old_rows = [(k, v, o) for k, v, o in old]
    keys = {k for k, _, _ in new_rows}
    kept = [r for r in old_rows if r[0] not in keys]
    if dedup:
        first = {}
        for k, v, o in new_rows:
            first.setdefault((k, v), o)
        added = [(k, v, o) for (k, v), o in first.items()]
    else:
        added = new_rows
    out = merge.replace_children(spark.createDataFrame(old_rows, schema), spark.createDataFrame(new_rows, schema),
                                 ["k"], dedup_fields=["v"] if dedup else None, order="_ord" if dedup else None)
    assert sorted(tuple(r) for r in out.collect()) == sorted(kept + added)


@SETTINGS
@given(items=ROWS, rows=st.lists(st.tuples(KEYS, st.integers(0, 9)), max_size=10))
def test_reset_and_set_matches_model(spark, items, rows):
    last = {}
    for i, (k, q) in enumerate(rows):
        last[k] = q
    model = {k: float(last.get(k, 0)) for k in items}
    tgt = spark.createDataFrame([(k, float(b)) for k, (_, b) in items.items()], "k string, q double")
    src = spark.createDataFrame([(k, float(q), i) for i, (k, q) in enumerate(rows)], "k string, q double, o long")
    out = merge.reset_and_set(tgt, src, ["k"], "q", ["o"], default=0.0)
    assert {r["k"]: r["q"] for r in out.collect()} == model


ORDERED = st.lists(st.tuples(KEYS, st.one_of(st.none(), st.integers(0, 3)), VAL), max_size=14)


@SETTINGS
@given(rows=ORDERED)
def test_first_and_last_per_key_match_model(spark, rows):
    from reqtrail.operators import keyed
    # order = (o1 ascending with NULLs last, then the row number) -- total within a key
    data = [(k, o1, i, v) for i, (k, o1, v) in enumerate(rows)]

    def sort_key(r):
        return (r[1] is None, r[1] if r[1] is not None else 0, r[2])

    first, last = {}, {}
    for r in sorted(data, key=sort_key):
        first.setdefault(r[0], r[3])
        last[r[0]] = r[3]
    df = spark.createDataFrame(data, "k string, o1 long, o2 long, v string")
    got_first = {r["k"]: r["v"] for r in keyed.first_per_key(df, ["k"], ["o1", "o2"], cols=["v"]).collect()}
    got_last = {r["k"]: r["v"] for r in keyed.last_per_key(df, ["k"], ["o1", "o2"], cols=["v"]).collect()}
    assert got_first == first and got_last == last


LINE_KEYS = st.tuples(st.integers(0, 3), st.integers(1, 3))


@SETTINGS
@given(lines=st.lists(st.tuples(LINE_KEYS, st.one_of(st.none(), st.sampled_from(["old1", "old2"]))), max_size=10),
       xwalk=st.lists(st.tuples(LINE_KEYS, st.sampled_from(["P1", "P2", "P3"])), max_size=10))
def test_attach_link_matches_model(spark, lines, xwalk):
    from reqtrail.operators import link
    last = {}
    for key, po in xwalk:          # rows in order: the last one per key wins
        last[key] = po
    model = sorted((((r, n), last.get((r, n), old)) for (r, n), old in lines), key=repr)
    ln = spark.createDataFrame([(r, n, old) for (r, n), old in lines], "REQ_No long, Line_No long, PO string")
    xw = spark.createDataFrame([(r, n, po, i) for i, ((r, n), po) in enumerate(xwalk)],
                               "Req_ID long, REQ_Line long, PO_No string, o long")
    out = link.attach_link(ln, xw, ["REQ_No", "Line_No"], ["Req_ID", "REQ_Line"], {"PO_No": "PO"}, ["o"])
    assert sorted((((r["REQ_No"], r["Line_No"]), r["PO"]) for r in out.collect()), key=repr) == model
