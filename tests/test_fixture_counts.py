"""Class and event counts against the numbers published in FIXTURES.md §3.3 (all three scales)."""
from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from reqtrail.operators import timeline as T
from reqtrail.plans import fixtures as fx
from reqtrail.plans.catalogue import AS_OF

# (SPLITREQ, BundledPO, none, mismatch, invalid, complete, worklist events, Auto, Internal)
EXPECTED = {
    "0.001": (289, 22, 643, 266, 87, 193, 154, 49, 69),
    "0.01": (2881, 203, 6578, 2802, 879, 1657, 1098, 678, 416),
    "0.1": (28763, 1872, 67230, 27071, 8265, 16799, 11310, 7490, 4516),
}


@pytest.mark.parametrize("sf", sorted(EXPECTED))
def test_counts_match_published_numbers(spark, sf):
    d = f"/root/testdata/sf{sf}"
    if not os.path.isdir(d):
        pytest.skip("driver tables not present")
    t = fx.Tables(spark, d)
    cls, ev = T.requisition_timeline(fx.fx_req(t), fx.fx_link(t), fx.fx_po(t), fx.fx_po_line(t),
                                     fx.fx_po_worklist(t), as_of=AS_OF, worklist_order="Appr_Inst")
    c = {(r["cls"], r["cause"]): r["n"] for r in cls.groupBy("cls", "cause").agg(F.count("*").alias("n")).collect()}
    got = (c.get(("SPLITREQ", None), 0), c.get(("BundledPO", None), 0), c.get(("NoValidPO", "none"), 0),
           c.get(("NoValidPO", "mismatch"), 0), c.get(("NoValidPO", "invalid"), 0), c.get(("complete", None), 0))
    wl = ev.where(~F.col("EventType").isin("Creation", "Approval"))
    w = wl.agg(F.count("*").alias("n"), F.count_if("Auto").alias("auto"), F.count_if("Internal").alias("internal")).first()
    assert got + (w["n"], w["auto"], w["internal"]) == EXPECTED[sf]
