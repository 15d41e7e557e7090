"""Results kept up to date against full rebuilds."""
from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from reqtrail.operators import counts, incremental, timeline
from reqtrail.plans import fixtures as fx
from reqtrail.plans import increments
from reqtrail.session import materialize

SF = "/root/testdata/sf0.001"
LINES = "PO_No string, Req_ID long"


def bag(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def test_counts_after_inserts_replacements_and_removals(spark):
    """Every step equals the counts of the stored lines, in all modes of D3; a pair named twice survives the loss of one."""
    rnd = random.Random(4)
    lines = [(f"P{rnd.randrange(8)}", rnd.choice([1, 2, 3, None])) for _ in range(60)] + [(None, 5)]
    df = lambda rows: spark.createDataFrame(rows, LINES)
    keys, member = ["PO_No"], "Req_ID"
    state = counts.pair_counts(df(lines), keys, member)
    result = counts.distinct_counts(state, keys, member)
    for step in range(4):
        new = [(f"P{rnd.randrange(3 * step, 3 * step + 5)}", rnd.choice([1, 4, None])) for _ in range(9)]
        gone = {f"P{step}"}
        pos = {p for p, _ in new}
        lines = [x for x in lines if x[0] not in pos] + new
        for deltas_of in (lambda s: counts.replacement_deltas(s, df(new), keys, member),
                          lambda s: counts.removal_deltas(s, spark.createDataFrame([(p,) for p in gone], "PO_No string"), keys, member)):
            deltas = materialize(deltas_of(state), "deltas")
            state = materialize(counts.apply_deltas(state, deltas, keys, member), "state")
            result = materialize(counts.updated_counts(result, state, deltas, keys, member), "counts")
        lines = [x for x in lines if x[0] not in gone]
        known = df([x for x in lines if x[0] is not None])
        assert bag(state) == bag(counts.pair_counts(known, keys, member))
        assert bag(result) == bag(timeline.req_counts_per_po(known))


def test_counts_never_read_the_lines(spark, tmp_path, capsys):
    spark.createDataFrame([("P1", 1), ("P2", None)], LINES).write.parquet(f"{tmp_path}/lines")
    stored = spark.read.parquet(f"{tmp_path}/lines")
    state = materialize(counts.pair_counts(stored, ["PO_No"], "Req_ID"), "state")
    deltas = counts.replacement_deltas(state, spark.createDataFrame([("P1", 7)], LINES), ["PO_No"], "Req_ID")
    counts.apply_deltas(state, deltas, ["PO_No"], "Req_ID").explain()
    assert f"{tmp_path}/lines" not in capsys.readouterr().out


def small(spark):
    """Tables of five requisitions: 1-2 share a PO, 3 has two POs, 4 an invalid one, 5 none."""
    t = lambda *a: dt.datetime(2020, 1, *a)
    req = [(r, 1, f"B{r}", t(r), "M", t(r + 1)) for r in range(1, 6)]
    link = [(1, "A"), (2, "A"), (3, "B"), (3, "C"), (4, "D"), (5, None)]
    po = [(p, 1, "PB", "Chief", t(10 + i), s, None if s == "C" else t(20)) for i, (p, s) in enumerate([("A", "A"), ("B", "A"), ("C", "A"), ("D", "C")])]
    line = [("A", 1), ("A", 2), ("B", 3), ("C", 3), ("D", 4)]
    steps = [("A", 1, "Team", "0", "I", t(12), "u"), ("D", 2, "Procurement", "1", "A", t(13), "v")]
    return {"req": spark.createDataFrame(req, "REQ_No long, Business_Unit long, Buyer string, REQ_Date timestamp_ntz, Approved_By string, Approved_On timestamp_ntz"),
            "req_line": spark.createDataFrame(link, "REQ_No long, PO_Number string"),
            "po": spark.createDataFrame(po, "PO_No string, Business_Unit long, Buyer string, Approved_By string, PO_Date timestamp_ntz, Status string, PO_Approval_Date timestamp_ntz"),
            "po_line": spark.createDataFrame(line, LINES),
            "po_worklist": spark.createDataFrame(steps, "PO_No string, Appr_Inst long, Work_List string, Approval_Number string, Appr_Stat string, Event_Date_Time timestamp_ntz, User string")}


LOADS = {
    "header of a requisition": ({"req": lambda t: t.withColumn("Buyer", F.when(F.col("REQ_No") == 5, "new").otherwise(F.col("Buyer")))}, {5}),
    "requisition gone": ({"req": lambda t: t.where("REQ_No <> 4"), "req_line": lambda t: t.where("REQ_No <> 4")}, {4}),
    "link taken away": ({"req_line": lambda t: t.where("PO_Number <> 'C' or PO_Number is null")}, {3}),
    "line of a shared PO": ({"po_line": lambda t: t.where("PO_No <> 'A' or Req_ID <> 2")}, {1, 2}),
    "PO becomes valid": ({"po": lambda t: t.withColumn("Status", F.lit("A"))}, {4}),
    "step of a PO": ({"po_worklist": lambda t: t.where("PO_No <> 'D'")}, {4}),
    "PO and link in one load": ({"po": lambda t: t.where("PO_No <> 'A'"), "req_line": lambda t: t.where("REQ_No <> 1")}, {1, 2}),
    "row order alone": ({"req_line": lambda t: t.orderBy(F.desc("REQ_No")), "po_line": lambda t: t.repartition(3)}, set()),
}


@pytest.fixture(scope="module")
def built(spark):
    old = small(spark)
    return old, increments.build(old)


@pytest.mark.parametrize("name", LOADS)
def test_one_load_recomputes_what_it_can_change(built, name):
    (old, before), (edits, wanted) = built, LOADS[name]
    new = old | {table: edit(old[table]) for table, edit in edits.items()}
    after, affected = incremental.update_timeline(before, old, new, as_of=increments.AS_OF, worklist_order="Appr_Inst")
    full = increments.build(new)
    assert {r["REQ_No"] for r in affected.collect()} == wanted
    assert bag(after.classified) == bag(full.classified) and bag(after.events) == bag(full.events)


def test_three_mixed_loads_equal_a_full_rebuild(spark):
    t = fx.Tables(spark, SF)
    loads = increments.timeline_loads(t)
    now, counted = increments.build(loads[0]), []
    for old, new in zip(loads, loads[1:]):
        now, affected = incremental.update_timeline(now, old, new, as_of=increments.AS_OF, worklist_order="Appr_Inst")
        counted.append(affected.count())
    full = increments.build(loads[-1])
    assert bag(now.classified) == bag(full.classified) and bag(now.events) == bag(full.events)
    every = loads[-1]["req"].count()
    assert 0 < counted[2] < every and counted[1] <= every
