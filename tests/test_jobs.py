"""End-to-end loaders (L1-L16) on hand-written report snapshots, in the required run order."""
from __future__ import annotations

import datetime as dt

from conftest import rows, ts

from reqtrail import schemas as S
from reqtrail.plans import jobs

AS_OF = ts(2030, 1, 1)


def snapshot(spark, spec: list[tuple[str, str]], data: list[dict]):
    """Build a raw report snapshot: printed headers, given types, defaults for unset cells, plus _ord."""
    names = [n for n, _ in spec]
    tuples = [tuple(d.get(n) for n in names) + (i,) for i, d in enumerate(data)]
    ddl = ", ".join(f"`{n}` {t}" for n, t in spec) + ", `_ord` long"
    return spark.createDataFrame(tuples, ddl)


def spec_of(mapping, first=(("Item", "string"),), types=None):
    """Printed headers for a field map: cleaned names back to spaces, typed as given (default string)."""
    types = types or {}
    return list(first) + [(src.replace("_", " "), types.get(src, "string")) for src in mapping]


REQ_SPEC = [("Req ID", "long"), ("Account", "string"), ("Unit", "string"), ("Buyer", "string"),
            ("Currency", "string"), ("Dept/Loc", "string"), ("Fund", "string"), ("Origin", "string"),
            ("Req Date", "timestamp_ntz"), ("Requester", "string"), ("Descr", "string"), ("Address 1", "string"),
            ("Address 2", "string"), ("City", "string"), ("St", "string"), ("Postal", "string"), ("Cntry", "string"),
            ("Status", "string"), ("By", "string"), ("Date", "timestamp_ntz"), ("Vendor", "string"),
            ("Name", "string"), ("Line", "int"), ("Base Price", "double"), ("Amount", "double"),
            ("Sched Num", "int"), ("Req Qty", "double"), ("Due", "timestamp_ntz"), ("More Info", "string"),
            ("UOM", "string"), ("Item", "string")]
PO_SPEC = [("PO No.", "string"), ("Business Unit", "string"), ("Buyer", "string"), ("Status", "string"),
           ("PO Date", "timestamp_ntz"), ("Origin", "string"), ("Approved By", "string"), ("Vendor Name", "string"),
           ("PO AprvDate", "timestamp_ntz"), ("Last Dttm", "timestamp_ntz"), ("Vendor", "string"),
           ("PO Line", "int"), ("Mfg ID", "string"), ("Mfg Itm ID", "string"), ("Sum Amount", "double"),
           ("Level 1", "string"), ("Level 2", "string"), ("Descr", "string"), ("More Info", "string"),
           ("QuoteLink", "string"), ("Req ID", "long"), ("REQ Line", "int"), ("PO Qty", "double")]
XW_SPEC = [("Req ID", "long"), ("Unit", "string"), ("Line", "int"), ("PO No.", "string"), ("Line ", "int")]
WL_SPEC = [("PO No.", "string"), ("Appr Inst", "long"), ("Work List", "string"), ("Approval Number", "string"),
           ("Appr Stat", "string"), ("Event Date Time", "timestamp_ntz"), ("User", "string"), ("Unit", "string"),
           ("PO HDR Status", "string"), ("WF APPR Status", "string"), ("Dispatch DTTM", "timestamp_ntz"),
           ("Threshold", "string"), ("Buyer", "string"), ("PO Hdr Created Date", "timestamp_ntz"),
           ("SUM MERCHANDISE AMT", "double")]


def req_rows():
    base = {"Unit": "A", "Buyer": "bob", "Req Date": ts(2020, 1, 1), "By": "ann", "Date": ts(2020, 1, 2),
            "Address 2": None}
    return [dict(base, **{"Req ID": 100, "Line": 1, "Item": "i1", "Amount": 5.0}),
            dict(base, **{"Req ID": 100, "Line": 2, "Item": "i2", "Amount": 6.0}),
            dict(base, **{"Req ID": 100, "Line": 2, "Item": "i2", "Amount": 6.0}),   # exact repeat: add-to-set
            dict(base, **{"Req ID": 200, "Line": 1, "Item": "i3", "Buyer": "cy"})]


def po_rows():
    base = {"Business Unit": "A", "Buyer": "pb", "Status": "A", "PO Date": ts(2020, 1, 3), "Approved By": "pa",
            "PO AprvDate": ts(2020, 1, 4)}
    return [dict(base, **{"PO No.": "P1", "PO Line": 1, "Req ID": 100, "REQ Line": 1}),
            dict(base, **{"PO No.": "P1", "PO Line": 2, "Req ID": 100, "REQ Line": 2}),
            dict(base, **{"PO No.": "P2", "PO Line": 1, "Req ID": 200, "REQ Line": 1}),
            dict(base, **{"PO No.": "P2", "PO Line": 2, "Req ID": 999, "REQ Line": 1})]


def test_procurement_pipeline(spark):
    req, req_line = jobs.load_req(snapshot(spark, REQ_SPEC, req_rows()), None, None)
    assert {r["REQ_No"]: r["Ship_To"]["Address_2"] for r in req.collect()} == {100: "", 200: ""}
    assert sorted((r["REQ_No"], r["Line_No"]) for r in req_line.collect()) == [(100, 1), (100, 2), (200, 1)]
    assert {r["Due_Date"] for r in req_line.collect()} == {ts(2001, 1, 1)}

    po, po_line = jobs.load_po(snapshot(spark, PO_SPEC, po_rows()), None, None)
    po2, po_line2 = jobs.load_po(snapshot(spark, PO_SPEC, po_rows()), po, po_line)
    assert rows(po2, "PO_No") == rows(po, "PO_No")                              # idempotent
    assert sorted(r["Line_No"] for r in po_line2.collect()) == [1, 1, 2, 2]

    xw = snapshot(spark, XW_SPEC, [{"Req ID": 100, "Unit": "A", "Line": 1, "PO No.": "P1", "Line ": 1},
                                   {"Req ID": 100, "Unit": "A", "Line": 2, "PO No.": "P1", "Line ": 2},
                                   {"Req ID": 200, "Unit": "A", "Line": 1, "PO No.": "PX", "Line ": 9},
                                   {"Req ID": 200, "Unit": "A", "Line": 1, "PO No.": "P2", "Line ": 1}])
    req_line = jobs.link_po_into_req_lines(xw, req, req_line)
    links = {(r["REQ_No"], r["Line_No"]): r["PO"]["PO_Number"] for r in req_line.collect()}
    assert links == {(100, 1): "P1", (100, 2): "P1", (200, 1): "P2"}             # last crosswalk row wins

    wl = snapshot(spark, WL_SPEC, [
        {"PO No.": "P1", "Appr Inst": 1, "Work List": "Central Procurement", "Approval Number": "1",
         "Appr Stat": "I", "Event Date Time": ts(2020, 1, 5), "User": "u1"},
        {"PO No.": "P1", "Appr Inst": 2, "Work List": None, "Approval Number": None, "Appr Stat": "A",
         "Event Date Time": ts(2020, 1, 6), "User": "u2"},
        {"PO No.": "P9", "Appr Inst": 3, "Appr Stat": "A", "Event Date Time": ts(2020, 1, 6)}])
    po_worklist = jobs.load_po_approvals(wl, po, None)
    assert sorted(r["PO_No"] for r in po_worklist.collect()) == ["P1", "P1"]     # P9 has no PO: ignored
    assert {r["Work_List"] for r in po_worklist.collect()} == {"Central Procurement", ""}

    docs, events = jobs.build_timelines(req, req_line, po, po_line, po_worklist, as_of=AS_OF, documents=True)
    d = {r["REQ_No"]: r for r in docs.collect()}
    assert d[100]["cls"] == "complete" and d[100]["PO_No"] == "P1"
    assert [e["Text"] for e in d[100]["events"]] == ["REQ Creation by bob", "REQ Approved by ann", "PO Creation",
                                                     "PO Approved by pa", "PO Initiated.", ", ."]
    assert d[100]["events"][-1]["End_DTTM"] == AS_OF
    assert d[200]["cls"] == "BundledPO" and d[200]["Complicated"] == "[BundledPO] 2 REQs found with P2."

    # reloading REQs erases their PO links until the crosswalk runs again
    _, relined = jobs.load_req(snapshot(spark, REQ_SPEC, req_rows()[:1]), req, req_line)
    after = {(r["REQ_No"], r["Line_No"]): (r["PO"]["PO_Number"] if r["PO"] else None) for r in relined.collect()}
    assert after == {(100, 1): None, (200, 1): "P2"}


def test_item_loaders(spark):
    alias = snapshot(spark, [("Item", "string"), ("Descr", "string"), ("Item Group", "string"), ("GDescr", "string"),
                             ("Status Current", "string"), ("Std UOM", "string"), ("Itm Status Dt", "timestamp_ntz"),
                             ("Mfg ID", "string"), ("Mfg Itm ID", "string")],
                     [{"Item": " 0007\t", "Descr": "bolt", "Mfg ID": "m1", "Mfg Itm ID": "x1"},
                      {"Item": "0007", "Descr": "other", "Mfg ID": "m2", "Mfg Itm ID": "x2"}])
    item, subs = jobs.load_item_aliases(alias, None, None)
    assert [(r["Item_No"], r["Item_Description"]) for r in item.collect()] == [("0007", "bolt")]
    assert sorted(r["Mfg_ID"] for r in subs.collect()) == ["m1", "m2"]

    hist = snapshot(spark, spec_of(S.ITEM_PREV_PO, types={"PO_Date": "timestamp_ntz", "PO_Qty": "double"}),
                    [{"Item": "0007", "PO No": "P1"}, {"Item": "0008", "PO No": "P2"}])
    item, prev = jobs.load_item_po_history(hist, item, None)
    got = {r["Item_No"]: r["Item_Description"] for r in item.collect()}
    assert got == {"0007": "bolt", "0008": None}                                # stub item (D21)

    wh = snapshot(spark, spec_of(S.ITEM_WAREHOUSE, types={"Qty_On_Hand": "double", "Last_Ptwy": "timestamp_ntz"}),
                  [{"Item": "0007", "Unit": "W1", "Qty On Hand": 3.0}, {"Item": "9999", "Unit": "W1"}])
    warehouse = jobs.load_item_warehouse(wh, item, None)
    assert [r["Item_No"] for r in warehouse.collect()] == ["0007"]

    bo = snapshot(spark, [("Item", "string"), ("Qty Req", "double")],
                  [{"Item": "0008", "Qty Req": 3.0}, {"Item": "0008", "Qty Req": 9.0}])
    item = jobs.load_item_backorders(bo, item)
    assert {r["Item_No"]: r["Total_Backorder"] for r in item.collect()} == {"0007": 0.0, "0008": 9.0}


def test_dashboard_early_warning_missing_po(spark):
    dash = snapshot(spark, spec_of(S.DASHBOARD, first=(), types={"Requisition_ID": "long", "Nbr_Lines_Not_Sourced": "int",
                                                                 "Transmitted_Time": "timestamp_ntz"}),
                    [{"Requisition ID": 1, "Hold Status": "first"}, {"Requisition ID": 1, "Hold Status": "last"}])
    out = jobs.refresh_dashboard(dash).collect()
    assert [(r["REQ_No"], r["Req_ID"], r["Hold_Status"]) for r in out] == [(1, 1, "last")]
    ew = snapshot(spark, spec_of(S.EARLY_WARNING, first=(), types={"Req_ID": "long", "Date": "timestamp_ntz"}),
                  [{"Req ID": 1}, {"Req ID": 1}])
    assert jobs.refresh_early_warnings(ew).count() == 2
    loc = snapshot(spark, spec_of(S.ITEM_LOCATIONS, types={"Qty": "double"}),
                   [{"Item": "0007", "Unit": "U", "Qty": 1.0}, {"Item": "0007", "Unit": "U", "Qty": 1.0}])
    item, locations = jobs.load_item_locations(loc, None, None)
    assert item.count() == 1 and locations.count() == 2                         # push keeps duplicates
    mp = snapshot(spark, [("PO No.", "string"), ("Vendor", "string")],
                  [{"PO No.": "P1", "Vendor": "v1"}, {"PO No.": "P1", "Vendor": "v2"}])
    stored = jobs.accumulate_missing_pos(mp, None)
    mp2 = snapshot(spark, [("PO No.", "string"), ("Vendor", "string")], [{"PO No.": "P2", "Vendor": "v3"}])
    acc = {r["PO_No"]: r["Vendor"] for r in jobs.accumulate_missing_pos(mp2, stored).collect()}
    assert acc == {"P1": "v1", "P2": "v3"}                                      # first row wins; never cleared


def test_contracts_and_req_approvals(spark):
    c = snapshot(spark, spec_of(S.CONTRACT_HEADER, first=(), types={"Expire_Dt": "timestamp_ntz"})
                 + spec_of(S.CONTRACT_LINE, first=(), types={"Line": "int", "Max_Amt": "double"}),
                 [{"Contract": "C1", "Line": 1, "Max Amt": 5.0}, {"Contract": "C1", "Line": 1, "Max Amt": 5.0},
                  {"Contract": "C1", "Line": 2}])
    contract, lines = jobs.load_contracts(c, None, None)
    assert contract.count() == 1 and lines.count() == 2
    req = spark.createDataFrame([(100,)], "REQ_No long")
    ra = snapshot(spark, spec_of(S.REQ_APPROVAL, first=(("Req ID", "long"),), types={"Appr_Inst": "long"}),
                  [{"Req ID": 100, "Appr Inst": 1}, {"Req ID": 555, "Appr Inst": 2}])
    out = jobs.load_req_approvals(ra, req, None).collect()
    assert [(r["REQ_No"], r["Work_List"]) for r in out] == [(100, "")]
    legacy = snapshot(spark, spec_of(S.PO_APPROVAL_LEGACY, first=(("PO No.", "string"),),
                                     types={"Appr_Inst": "long", "Denial_Date_Time": "timestamp_ntz"}),
                      [{"PO No.": "P5", "Appr Inst": 1, "Denial Date Time": dt.datetime(2020, 1, 1), "User": "u"},
                       {"PO No.": "P5", "Appr Inst": 2, "User": "v"}])
    po, wl = jobs.load_po_approvals_legacy(legacy, spark.createDataFrame([("P1",)], "PO_No string"), None)
    assert sorted(r["PO_No"] for r in po.collect()) == ["P1", "P5"]
    assert sorted((r["Lv_Appr"], r["Denial_Date_Time"]) for r in wl.collect()) == [
        ("u", dt.datetime(2020, 1, 1)), ("v", None)]                             # per-row dates (D4)
