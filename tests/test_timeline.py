"""Golden micro-fixtures for classification and timeline rules (FIXTURES.md §4)."""
from __future__ import annotations

from functools import partial

import pytest
from conftest import rows, ts

from pyspark.sql import Window
from pyspark.sql import functions as F

from reqtrail.operators import timeline as T

REQ = "REQ_No long, Business_Unit string, Buyer string, REQ_Date timestamp_ntz, Approved_By string, Approved_On timestamp_ntz"
LINK = "REQ_No long, PO_Number string"
PO = ("PO_No string, Business_Unit string, Buyer string, Approved_By string, PO_Date timestamp_ntz, Status string, "
      "PO_Approval_Date timestamp_ntz")
PO_LINE = "PO_No string, Req_ID long"
WL = ("PO_No string, Appr_Inst long, Work_List string, Approval_Number string, Appr_Stat string, "
      "Event_Date_Time timestamp_ntz, User string")
AS_OF = ts(2030, 1, 1)

timeline_of = partial(T.requisition_timeline, worklist_order="Appr_Inst")  # unique in these rows


def req_row(n, bu="A"):
    return (n, bu, f"buyer{n}", ts(2020, 1, 1), f"boss{n}", ts(2020, 1, 3))


def po_row(p, bu="A", status="A", appr=ts(2020, 1, 6), created=ts(2020, 1, 5)):
    return (p, bu, "pb", "pa", created, status, appr)


def classify(spark, reqs, links, pos, po_lines, **kw):
    return T.classify_requests(spark.createDataFrame(reqs, REQ), spark.createDataFrame(links, LINK),
                               spark.createDataFrame(pos, PO), spark.createDataFrame(po_lines, PO_LINE), **kw)


def cls_of(df):
    return {r["REQ_No"]: (r["cls"], r["cause"]) for r in df.collect()}


def test_complete_request_events(spark):
    wl = [("P1", 10, "Central Procurement", "1", "I", ts(2020, 1, 7), "u1"),
          ("P1", 11, "Budget", "2", "A", ts(2020, 1, 8), "u2"),
          ("P1", 12, "Budget", "1", "A", ts(2020, 1, 8), "u3")]
    req, pos = spark.createDataFrame([req_row(1)], REQ), spark.createDataFrame([po_row("P1")], PO)
    classified, ev = timeline_of(req, spark.createDataFrame([(1, "P1")], LINK), pos,
                                            spark.createDataFrame([("P1", 1)], PO_LINE),
                                            spark.createDataFrame(wl, WL), as_of=AS_OF)
    assert cls_of(classified) == {1: ("complete", None)}
    got = rows(ev, "seq")
    assert [r["seq"] for r in got] == list(range(7))
    assert [r["EventType"] for r in got] == ["Creation", "Approval", "Creation", "Approval", "Initiated",
                                             "Approved", "Approved"]
    assert got[0]["Text"] == "REQ Creation by buyer1" and got[1]["Text"] == "REQ Approved by boss1"
    assert got[3]["Text"] == "PO Approved by pa"
    assert got[4]["Text"] == "PO Initiated." and got[4]["Internal"] is True
    # worklist order is (time, approval number): Appr_Inst 12 ("1") before 11 ("2"); 11 repeats the time
    assert [r["ID"] for r in got[4:]] == ["10", "12", "11"]
    assert [r["Auto"] for r in got[4:]] == [False, False, True]
    assert got[5]["Text"] == "Budget, 1."
    # End follows time order; the last event ends at as_of
    by_time = sorted(got, key=lambda r: (r["Start_DTTM"], r["seq"]))
    for a, b in zip(by_time, by_time[1:]):
        assert a["End_DTTM"] == b["Start_DTTM"]
    assert by_time[-1]["End_DTTM"] == AS_OF


def test_construction_order_kept_and_ties(spark):
    # PO created before the REQ approval: stored order stays construction order
    req = spark.createDataFrame([req_row(1)], REQ)
    pos = spark.createDataFrame([po_row("P1", created=ts(2020, 1, 2), appr=ts(2020, 1, 3))], PO)
    _, ev = timeline_of(req, spark.createDataFrame([(1, "P1")], LINK), pos,
                                   spark.createDataFrame([("P1", 1)], PO_LINE), spark.createDataFrame([], WL),
                                   as_of=AS_OF)
    got = rows(ev, "seq")
    assert [r["Lifecycle"] for r in got] == ["REQ", "REQ", "PO", "PO"]
    # REQ approval (seq 1) and PO approval (seq 3) tie at Jan 3: the first by seq ends at that same time
    assert got[1]["End_DTTM"] == ts(2020, 1, 3)
    assert got[2]["End_DTTM"] == ts(2020, 1, 3)
    assert got[3]["End_DTTM"] == AS_OF


def test_split_duplicate_link_and_no_link(spark):
    out = classify(spark, [req_row(1), req_row(2), req_row(3)], [(1, "P1"), (1, "P2"), (2, "P1"), (2, "P1")],
                   [po_row("P1"), po_row("P2")], [("P1", 2), ("P2", 1)])
    got = {r["REQ_No"]: r for r in out.collect()}
    assert got[1]["cls"] == "SPLITREQ"
    assert got[1]["Complicated"] == "[SPLITREQ] REQ 1 has 2 POs associated with it."
    assert got[1]["PO_No"] == "" and got[1]["Business_Unit"] == ""
    assert got[2]["cls"] == "complete" and got[2]["PO_No"] == "P1" and got[2]["Complicated"] == ""
    assert (got[3]["cls"], got[3]["cause"]) == ("NoValidPO", "none")
    assert got[3]["Complicated"] == "No POs associated with REQ 3 are valid. Did not insert in DB."


def test_bundled(spark):
    out = classify(spark, [req_row(1), req_row(2)], [(1, "P1"), (2, "P1")], [po_row("P1")], [("P1", 1), ("P1", 2)])
    got = {r["REQ_No"]: r for r in out.collect()}
    assert got[1]["cls"] == got[2]["cls"] == "BundledPO"
    assert got[1]["Complicated"] == "[BundledPO] 2 REQs found with P1."


@pytest.mark.parametrize("mode,lines,expected", [
    ("each", [("P1", 1), ("P1", None)], "BundledPO"),
    ("one", [("P1", 1), ("P1", None)], "BundledPO"),
    ("ignore", [("P1", 1), ("P1", None)], "complete"),
    ("each", [("P1", None), ("P1", None)], "BundledPO"),
    ("one", [("P1", None), ("P1", None)], "complete"),
    ("ignore", [("P1", None), ("P1", None)], "complete"),
])
def test_unlinked_po_lines(spark, mode, lines, expected):
    out = classify(spark, [req_row(1)], [(1, "P1")], [po_row("P1")], lines, null_req=mode)
    assert cls_of(out)[1][0] == expected


def test_unit_mismatch_beats_bundled(spark):
    out = classify(spark, [req_row(1, "A"), req_row(2, "B")], [(1, "P1"), (2, "P1")], [po_row("P1", bu="B")],
                   [("P1", 1), ("P1", 2)])
    assert cls_of(out)[1] == ("NoValidPO", "mismatch")  # D17: unit checked before the bundled test
    assert cls_of(out)[2] == ("BundledPO", None)


@pytest.mark.parametrize("status,appr,expected", [
    ("C", None, ("NoValidPO", "invalid")),
    ("D", None, ("NoValidPO", "invalid")),
    ("X", None, ("complete", None)),          # D7: only C/D without approval are invalid
    ("D", ts(2020, 1, 6), ("complete", None)),
])
def test_validity(spark, status, appr, expected):
    out = classify(spark, [req_row(1)], [(1, "P1")], [po_row("P1", status=status, appr=appr)], [("P1", 1)])
    assert cls_of(out)[1] == expected


def test_cancelled_has_no_po_approval_event(spark):
    req = spark.createDataFrame([req_row(1)], REQ)
    pos = spark.createDataFrame([po_row("P1", status="X", appr=None)], PO)
    _, ev = timeline_of(req, spark.createDataFrame([(1, "P1")], LINK), pos,
                                   spark.createDataFrame([("P1", 1)], PO_LINE), spark.createDataFrame([], WL),
                                   as_of=AS_OF)
    assert [r["EventType"] for r in rows(ev, "seq")] == ["Creation", "Approval", "Creation"]


def test_worklist_rule(spark):
    req = spark.createDataFrame([req_row(1), req_row(2)], REQ)
    rw = spark.createDataFrame([(2, 5, ts(2020, 1, 1))], "REQ_No long, Appr_Inst long, Date_Time timestamp_ntz")
    out = T.classify_requests(req, spark.createDataFrame([(1, "P1"), (2, "P1")], LINK),
                              spark.createDataFrame([po_row("P1")], PO), spark.createDataFrame([], PO_LINE),
                              req_worklist=rw, require_worklist=True)
    got = {r["REQ_No"]: r for r in out.collect()}
    assert got[1]["cls"] == "NoWorklist"
    assert got[1]["Complicated"] == "[NoWorklist] Req 1 does not have a worklist."
    assert got[2]["cls"] == "complete"


def test_null_start_sorts_last(spark):
    req = spark.createDataFrame([(1, "A", "b", None, "a", ts(2020, 1, 3))], REQ)
    _, ev = timeline_of(req, spark.createDataFrame([(1, "P1")], LINK),
                                   spark.createDataFrame([po_row("P1")], PO),
                                   spark.createDataFrame([("P1", 1)], PO_LINE), spark.createDataFrame([], WL),
                                   as_of=AS_OF)
    got = rows(ev, "seq")
    assert got[0]["Start_DTTM"] is None and got[0]["End_DTTM"] is None  # D12
    assert got[3]["End_DTTM"] == AS_OF


def test_partitioning_does_not_change_results(spark):
    wl = [("P1", i, "Procurement" if i % 2 else "Other", str(i % 3), "A", ts(2020, 1, 7 + i % 4), "u")
          for i in range(40)]
    args = dict(as_of=AS_OF)
    base = None
    for n in (1, 7):
        req = spark.createDataFrame([req_row(1)], REQ).repartition(n)
        _, ev = timeline_of(req, spark.createDataFrame([(1, "P1")], LINK),
                                       spark.createDataFrame([po_row("P1")], PO),
                                       spark.createDataFrame([("P1", 1)], PO_LINE),
                                       spark.createDataFrame(wl, WL).repartition(n), **args)
        got = rows(ev, "seq")
        base = base or got
        assert got == base


def test_timeline_documents(spark):
    req = spark.createDataFrame([req_row(1), req_row(2)], REQ)
    cls, ev = timeline_of(req, spark.createDataFrame([(1, "P1")], LINK),
                                     spark.createDataFrame([po_row("P1")], PO),
                                     spark.createDataFrame([("P1", 1)], PO_LINE), spark.createDataFrame([], WL),
                                     as_of=AS_OF)
    docs = {r["REQ_No"]: r for r in T.timeline_documents(cls, ev).collect()}
    assert len(docs[1]["events"]) == 4 and docs[1]["events"][0]["Text"] == "REQ Creation by buyer1"
    assert docs[2]["events"] == [] and docs[2]["cls"] == "NoValidPO"


def test_worklist_events_standalone(spark):
    wl = spark.createDataFrame([("P1", 1, "x", "1", "D", ts(2020, 1, 1), "u"),
                                ("P1", 2, "procurement", "0", "Z", ts(2020, 1, 1), "u"),
                                ("P2", 3, None, None, "A", None, "u"),
                                ("P2", 4, None, None, "A", None, "u")], WL)
    got = {r["ID"]: r for r in T.worklist_events(wl, "Appr_Inst").collect()}
    assert got["2"]["seq"] == 0 and got["1"]["seq"] == 1 and got["1"]["Auto"] and not got["2"]["Auto"]
    assert got["1"]["EventType"] == "Denied" and got["2"]["EventType"] == "Z" and got["2"]["Internal"]
    assert got["3"]["Text"] == ", ." and not got["3"]["Auto"] and got["4"]["Auto"]


def window_end_times(ev):
    """W1 with one plain window per requisition."""
    w = Window.partitionBy("REQ_No").orderBy(F.col("Start_DTTM").asc_nulls_last(), "seq")
    return ev.withColumn("End_DTTM", F.when(F.col("Start_DTTM").isNotNull(), F.coalesce(
        F.lead("Start_DTTM").over(w), F.lit(AS_OF).cast("timestamp_ntz"))))


def test_end_times_equal_general_definition_with_ties(spark):
    import random
    rnd = random.Random(7)
    day = lambda: ts(2020, 1, rnd.randint(1, 4))  # noqa: E731  tiny domain: many ties
    reqs = [(i, "A", f"b{i}", day() if rnd.random() > 0.1 else None, "a", day()) for i in range(40)]
    pos = [(f"P{i}", "A", "pb", "pa", day(), "A", day() if rnd.random() > 0.4 else None) for i in range(40)]
    wl = [(f"P{rnd.randint(0, 39)}", n, "w", str(rnd.randint(0, 2)), "A", day() if rnd.random() > 0.1 else None, "u")
          for n in range(300)]
    _, ev = timeline_of(spark.createDataFrame(reqs, REQ),
                                   spark.createDataFrame([(i, f"P{i}") for i in range(40)], LINK),
                                   spark.createDataFrame(pos, PO),
                                   spark.createDataFrame([(f"P{i}", i) for i in range(40)], PO_LINE),
                                   spark.createDataFrame(wl, WL), as_of=AS_OF)
    general = window_end_times(ev.drop("End_DTTM"))
    got = sorted(((r["REQ_No"], r["seq"], r["End_DTTM"]) for r in ev.collect()), key=repr)
    want = sorted(((r["REQ_No"], r["seq"], r["End_DTTM"]) for r in general.collect()), key=repr)
    assert got == want and len(got) > 400


def test_hot_requisition_spans_partitions(spark):
    """One PO holds most worklist steps; positions, flags and End times equal plain windows."""
    import random
    rnd = random.Random(11)
    reqs = [req_row(i) for i in range(6)]
    pos = [po_row(f"P{i}", appr=None if i % 2 else ts(2020, 1, 6)) for i in range(6)]
    wl = [("P0" if rnd.random() < 0.8 else f"P{rnd.randint(1, 5)}", n, rnd.choice(["x procurement", "y"]),
           str(rnd.randint(0, 3)), rnd.choice(["I", "A", "D"]), ts(2020, 1, rnd.randint(1, 9), rnd.randint(0, 3)), "u")
          for n in range(700)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        _, ev = timeline_of(spark.createDataFrame(reqs, REQ),
                                       spark.createDataFrame([(i, f"P{i}") for i in range(6)], LINK),
                                       spark.createDataFrame(pos, PO),
                                       spark.createDataFrame([(f"P{i}", i) for i in range(6)], PO_LINE),
                                       spark.createDataFrame(wl, WL).repartition(5), as_of=AS_OF)
        got = sorted((tuple(r) for r in ev.collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    again = sorted((tuple(r) for r in window_end_times(ev.drop("End_DTTM")).select(*ev.columns).collect()), key=repr)
    assert got == again and len(got) > 700
    steps = {}
    for po, n, *_, at, _u in sorted(wl, key=lambda w: (w[0], w[5], w[3], w[1])):
        steps.setdefault(po, []).append((str(n), at))
    by_po = {}
    for r in ev.where("EventType not in ('Creation', 'Approval') or Text not like '% by %' and Text <> 'PO Creation'").orderBy("seq").collect():
        by_po.setdefault(r["PO_No"], []).append((r["ID"], r["Auto"]))
    for po, want in steps.items():
        auto = [i > 0 and want[i - 1][1] == at for i, (_, at) in enumerate(want)]
        assert by_po[po] == [(n, a) for (n, _), a in zip(want, auto)]
