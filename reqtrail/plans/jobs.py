"""One function per snapshot loader, composed from the operators.

Every loader takes the raw snapshot (report headers as printed, plus the row
order column ``_ord`` the source adds) and the current tables, and returns the
new tables. Nothing is written here: the caller stores each result with
``merge.write_version`` (or ``fan_out`` for several targets) and stamps the
freshness register with ``merge.stamp(control, [schemas.FRESHNESS[name]])``.

Canonical storage is flat: header tables keyed by business key, child tables
(lines, worklists, item arrays) keyed by the parent key plus ``_ord``.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reqtrail import schemas as S
from reqtrail.functions.headers import clean_headers
from reqtrail.functions.nulls import DEFAULT_DUE, text_or_empty, ts_literal
from reqtrail.functions.text import strip_ws
from reqtrail.operators import keyed, link, merge, timeline
from reqtrail.sources.snapshot import ORD


def _clean(snapshot: DataFrame, dataset: str) -> DataFrame:
    return clean_headers(snapshot, S.RULES[dataset])


def _without(mapping, key_src: str):
    return type(mapping)((s, d) for s, d in mapping.items() if s != key_src)


def _children(df: DataFrame, key_src: str, key: str, mapping) -> DataFrame:
    return S.project(df.withColumn("_key_", F.col(key_src)), _without(mapping, key_src), keep=["_key_", ORD]) \
            .withColumnRenamed("_key_", key)


def _header_upsert(target: DataFrame | None, snap: DataFrame, key_src: str, key: str, mapping) -> DataFrame:
    """A3 (first row per key) + K1 upsert of the listed header fields. ``target=None``: first load."""
    rows = keyed.in_slices(snap.where(F.col(key_src).isNotNull()), [key_src])
    first = keyed.first_per_key(rows, [key_src], [ORD])
    src = S.project(first.withColumn("_key_", F.col(key_src)), _without(mapping, key_src), keep=["_key_"]) \
           .withColumnRenamed("_key_", key)
    if target is None:
        return src
    return merge.upsert(target, src, [key], [c for c in S.targets(mapping) if c != key])


def _stub_upsert(target: DataFrame | None, snap: DataFrame, key_src: str, key: str) -> DataFrame:
    """K1 stub: keys missing from the target are inserted with only the key."""
    keys = keyed.distinct_keys(snap, [key_src]).withColumnRenamed(key_src, key)
    return keys if target is None else merge.upsert(target, keys, [key], [])


def _replace(children: DataFrame | None, rows: DataFrame, keys, **kw) -> DataFrame:
    """K7 + K5/K6; ``children=None``: first load (no stored children yet)."""
    if children is None:
        children = rows.limit(0)
    return merge.replace_children(children, rows, keys, **kw)


def load_req(snapshot: DataFrame, req: DataFrame, req_line: DataFrame) -> tuple[DataFrame, DataFrame]:
    """L1: REQ headers (K1, first row) and lines (K7 reset + K6 add-to-set)."""
    snap = snapshot.withColumn("Due", F.coalesce(F.col("Due"), ts_literal(DEFAULT_DUE)))   # P6
    snap = _clean(snap, "req").withColumn("Address_2", text_or_empty("Address_2"))       # P1, P7
    new_req = _header_upsert(req, snap, "Req_ID", "REQ_No", S.REQ_HEADER)
    lines = _children(snap.where(F.col("Req_ID").isNotNull()), "Req_ID", "REQ_No", S.REQ_LINE)
    fields = S.targets(S.REQ_LINE)
    new_lines = _replace(req_line, lines, ["REQ_No"], dedup_fields=fields, order=ORD)
    return new_req, new_lines


def load_po(snapshot: DataFrame, po: DataFrame, po_line: DataFrame) -> tuple[DataFrame, DataFrame]:
    """L2: PO headers (K1, first row; ``worklist`` is not touched) and lines (K7 + K5 push).

    The missing-requisition fill of the source is a no-op there (D3): blanks stay NULL.
    """
    snap = _clean(snapshot, "po")
    new_po = _header_upsert(po, snap, "PO_No", "PO_No", S.PO_HEADER)
    lines = _children(snap.where(F.col("PO_No").isNotNull()), "PO_No", "PO_No", S.PO_LINE)
    return new_po, _replace(po_line, lines, ["PO_No"])


def link_po_into_req_lines(snapshot: DataFrame, req: DataFrame, req_line: DataFrame) -> DataFrame:
    """L3: set lines[].PO on every REQ line matching (REQ, unit, line number); last row wins.

    ``snapshot`` columns are positional (the report repeats ``Line``): see ``schemas.XWALK_COLUMNS``.
    """
    x = snapshot.toDF(*S.XWALK_COLUMNS, *snapshot.columns[len(S.XWALK_COLUMNS):])
    lines = req_line.join(req.select("REQ_No", F.col("Business_Unit").alias("_bu")), "REQ_No", "left")
    po_struct = F.struct(F.col("PO_No").alias("PO_Number"), F.col("PO_Line").alias("Line_No"))
    x = x.withColumn("_po", po_struct)
    out = link.attach_link(lines, x, ["REQ_No", "_bu", "Line_No"], ["Req_ID", "Unit", "REQ_Line"],
                           {"_po": "PO"}, [ORD])
    return out.drop("_bu")


def _approvals(snapshot: DataFrame, dataset: str, key_src: str, key: str, mapping, text_defaults,
               parent: DataFrame, children: DataFrame) -> DataFrame:
    snap = _clean(snapshot, dataset)
    snap = snap.withColumns({c: text_or_empty(c) for c in text_defaults})     # P5
    rows = _children(snap, key_src, key, mapping)
    return _replace(children, rows, [key], parent=parent)       # K7 + K5, update-only


def load_po_approvals(snapshot: DataFrame, po: DataFrame, po_worklist: DataFrame) -> DataFrame:
    """L4: PO approval steps replace the worklist of existing POs only."""
    return _approvals(snapshot, "po_approval", "PO_No", "PO_No", S.PO_APPROVAL, S.PO_APPROVAL_TEXT_DEFAULTS,
                      po, po_worklist)


def load_req_approvals(snapshot: DataFrame, req: DataFrame, req_worklist: DataFrame) -> DataFrame:
    """REQ approval steps replace the worklist of existing REQs only."""
    return _approvals(snapshot, "req_approval", "Req_ID", "REQ_No", S.REQ_APPROVAL, S.REQ_APPROVAL_TEXT_DEFAULTS,
                      req, req_worklist)


def load_po_approvals_legacy(snapshot: DataFrame, po: DataFrame, po_worklist_legacy: DataFrame
                             ) -> tuple[DataFrame, DataFrame]:
    """Older approval shape; stub POs are created (K1), worklists replaced (K7 + K5).

    Each row keeps its own dates (D4); it is stored apart from the L4 worklist (D15).
    """
    snap = _clean(snapshot, "po_approval_legacy")
    rows = _children(snap.where(F.col("PO_No").isNotNull()), "PO_No", "PO_No", S.PO_APPROVAL_LEGACY)
    return _stub_upsert(po, snap, "PO_No", "PO_No"), _replace(po_worklist_legacy, rows, ["PO_No"])


def load_contracts(snapshot: DataFrame, contract: DataFrame, contract_line: DataFrame
                   ) -> tuple[DataFrame, DataFrame]:
    """Contract headers (K1, first row) and lines (K7 + K6 add-to-set)."""
    snap = _clean(snapshot, "contract")
    new_c = _header_upsert(contract, snap, "Contract", "Contract_ID", S.CONTRACT_HEADER)
    lines = _children(snap.where(F.col("Contract").isNotNull()), "Contract", "Contract_ID", S.CONTRACT_LINE)
    return new_c, _replace(contract_line, lines, ["Contract_ID"],
                                         dedup_fields=S.targets(S.CONTRACT_LINE), order=ORD)


def _items(snapshot: DataFrame, dataset: str) -> DataFrame:
    snap = snapshot.withColumn("Item", strip_ws(F.col("Item").cast("string")))   # S3 + F1
    return _clean(snap, dataset)


def load_item_aliases(snapshot: DataFrame, item: DataFrame, item_subs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Item headers (K1, first row) and substitutes (K7 + K5)."""
    snap = _items(snapshot, "item_alias")
    new_item = _header_upsert(item, snap, "Item", "Item_No", S.ITEM_ALIAS_HEADER)
    subs = _children(snap.where(F.col("Item").isNotNull()), "Item", "Item_No", S.ITEM_SUBS)
    return new_item, _replace(item_subs, subs, ["Item_No"])


def _item_array(snapshot: DataFrame, dataset: str, mapping, item: DataFrame, children: DataFrame
                ) -> tuple[DataFrame, DataFrame]:
    snap = _items(snapshot, dataset)
    rows = _children(snap.where(F.col("Item").isNotNull()), "Item", "Item_No", mapping)
    return _stub_upsert(item, snap, "Item", "Item_No"), _replace(children, rows, ["Item_No"])


def load_item_po_history(snapshot: DataFrame, item: DataFrame, item_prev_po: DataFrame
                         ) -> tuple[DataFrame, DataFrame]:
    """Previous POs per item (stub item K1 + K7 + K5)."""
    return _item_array(snapshot, "item_po", S.ITEM_PREV_PO, item, item_prev_po)


def load_item_locations(snapshot: DataFrame, item: DataFrame, item_locations: DataFrame
                        ) -> tuple[DataFrame, DataFrame]:
    """Stock locations per item (stub item K1 + K7 + K5)."""
    return _item_array(snapshot, "item_location", S.ITEM_LOCATIONS, item, item_locations)


def load_item_warehouse(snapshot: DataFrame, item: DataFrame, item_warehouse: DataFrame) -> DataFrame:
    """Warehouse stats replace those of existing items only (K7 + K5, update-only)."""
    snap = _items(snapshot, "item_warehouse")
    rows = _children(snap, "Item", "Item_No", S.ITEM_WAREHOUSE)
    return _replace(item_warehouse, rows, ["Item_No"], parent=item)


def load_item_backorders(snapshot: DataFrame, item: DataFrame) -> DataFrame:
    """Every item's backorder back to 0 (K8), then the snapshot's last value per item."""
    snap = _items(snapshot, "item_backorder").select(F.col("Item").alias("Item_No"),
                                                     F.col("Qty_Req").alias("Total_Backorder"), ORD)
    if "Total_Backorder" not in item.columns:
        item = item.withColumn("Total_Backorder", F.lit(None).cast(snap.schema["Total_Backorder"].dataType))
    snap = keyed.in_slices(snap, ["Item_No"])
    return merge.reset_and_set(item, snap, ["Item_No"], "Total_Backorder", [ORD], default=0)


def refresh_dashboard(snapshot: DataFrame) -> DataFrame:
    """Replace-all; repeated requisitions keep their last row (K3 + A4); the id twice."""
    snap = _clean(snapshot, "dashboard")
    snap = keyed.in_slices(snap.withColumnRenamed("Requisition_ID", "REQ_No"), ["REQ_No"])
    last = merge.replace_all(snap, keys=["REQ_No"], order=[ORD])
    return S.project(last.withColumn("Requisition_ID", F.col("REQ_No")), S.DASHBOARD, keep=["REQ_No"])


def refresh_early_warnings(snapshot: DataFrame) -> DataFrame:
    """Replace-all, every row inserted (K3 + K4); empty dates stay NULL."""
    return S.project(_clean(snapshot, "early_warning"), S.EARLY_WARNING)


def accumulate_missing_pos(snapshot: DataFrame, missing_po: DataFrame) -> DataFrame:
    """First vendor per PO upserted into a table that is never cleared."""
    snap = _clean(snapshot, "missing_po")
    rows = keyed.in_slices(snap.where(F.col("PO_No").isNotNull()), ["PO_No"])
    first = keyed.first_per_key(rows, ["PO_No"], [ORD], cols=["Vendor"])
    return first if missing_po is None else merge.upsert(missing_po, first, ["PO_No"], ["Vendor"])


def build_timelines(req: DataFrame, req_line: DataFrame, po: DataFrame, po_line: DataFrame,
                    po_worklist: DataFrame, as_of: dt.datetime | Column | None = None, null_req: str = "each",
                    req_worklist: DataFrame | None = None, require_worklist: bool = False,
                    include_req_worklist: bool = False, documents: bool = False
                    ) -> tuple[DataFrame, DataFrame]:
    """(classified requisitions, flat events) from the stored tables (K3: replace-all).

    With ``documents`` the first table holds the nested documents instead: one array of all
    events per requisition, for readers that need that shape.
    """
    po_number = F.col("PO.PO_Number") if "PO" in req_line.columns else F.lit(None).cast("string")
    link_rows = req_line.select("REQ_No", po_number.alias("PO_Number"))
    lines = po_line.select("PO_No", F.col("Requisition_Data.Req_ID").alias("Req_ID"))
    classified, events = timeline.requisition_timeline(
        req, link_rows, po, lines, po_worklist, as_of=as_of, null_req=null_req, worklist_order=ORD,
        req_worklist=req_worklist, require_worklist=require_worklist, include_req_worklist=include_req_worklist)
    return timeline.timeline_documents(classified, events) if documents else classified, events
