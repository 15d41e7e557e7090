"""Per-dataset snapshot specs: header rules, keys and source -> target field maps.

A dotted target ("Ship_To.City") is a field of a nested struct. Maps are ordered
as the documents list their fields.
"""
from __future__ import annotations

from collections import OrderedDict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reqtrail.functions.headers import DASH, DROP_DOT, DROP_QUESTION, SLASH, SPACE

# ------------------------------------------------------------------------------------------------
# Header cleanup rules, business keys, field maps and freshness names of the
# procurement report snapshots. They must equal the source system's names for results to match.
# ------------------------------------------------------------------------------------------------
RULES = {
    "req": [SPACE, SLASH],
    "po": [SPACE, SLASH, DROP_DOT],
    "req_po_xwalk": [SPACE, SLASH, DROP_DOT],
    "po_approval": [SPACE, DROP_DOT],
    "req_approval": [SPACE, DROP_DOT, SLASH],
    "po_approval_legacy": [SPACE, SLASH, DROP_DOT],
    "contract": [SPACE, SLASH, DROP_DOT],
    "item_alias": [SPACE],
    "item_po": [SPACE, DROP_DOT],
    "item_location": [SPACE],
    "item_warehouse": [SPACE],
    "item_backorder": [SPACE],
    "dashboard": [SPACE, DASH, DROP_QUESTION],
    "early_warning": [SPACE, SLASH, DROP_DOT],
    "missing_po": [SPACE, SLASH, DROP_DOT],
}

REQ_HEADER = OrderedDict([
    ("Req_ID", "REQ_No"), ("Account", "Account"), ("Unit", "Business_Unit"), ("Buyer", "Buyer"),
    ("Currency", "Currency"), ("Dept_Loc", "Department.Number"), ("Fund", "Fund"), ("Origin", "Origin"),
    ("Req_Date", "REQ_Date"), ("Requester", "Requester"), ("Descr", "Ship_To.Description"),
    ("Address_1", "Ship_To.Address_1"), ("Address_2", "Ship_To.Address_2"), ("City", "Ship_To.City"),
    ("St", "Ship_To.State"), ("Postal", "Ship_To.Zip_Code"), ("Cntry", "Ship_To.Country"), ("Status", "Status"),
    ("By", "Approved_By"), ("Date", "Approved_On"), ("Vendor", "Vendor.Number"), ("Name", "Vendor.Name")])
REQ_LINE = OrderedDict([
    ("Line", "Line_No"), ("Base_Price", "Unit_Price"), ("Amount", "Line_Total"), ("Sched_Num", "Schedule_No"),
    ("Req_Qty", "Quantity"), ("Due", "Due_Date"), ("More_Info", "More_Info"), ("UOM", "UOM"), ("Item", "Item")])

PO_HEADER = OrderedDict([
    ("PO_No", "PO_No"), ("Business_Unit", "Business_Unit"), ("Buyer", "Buyer"), ("Status", "Status"),
    ("PO_Date", "PO_Date"), ("Origin", "Origin"), ("Approved_By", "Approved_By"), ("Vendor_Name", "Vendor"),
    ("PO_AprvDate", "PO_Approval_Date"), ("Last_Dttm", "Last_Updated"), ("Vendor", "Vendor_ID")])
PO_LINE = OrderedDict([
    ("PO_Line", "Line_No"), ("Mfg_ID", "Mfg_ID"), ("Mfg_Itm_ID", "Mfg_Item_ID"), ("Sum_Amount", "Line_Total"),
    ("Level_1", "Level_1"), ("Level_2", "Level_2"), ("Descr", "Descr"), ("More_Info", "Line_Descr"),
    ("QuoteLink", "FairMarkIt_Link"), ("Req_ID", "Requisition_Data.Req_ID"),
    ("REQ_Line", "Requisition_Data.Req_Line"), ("PO_Qty", "Quantity")])

# The crosswalk report repeats the header "Line": first = REQ line, second = PO line (by position).
XWALK_COLUMNS = ["Req_ID", "Unit", "REQ_Line", "PO_No", "PO_Line"]

PO_APPROVAL = OrderedDict((c, c) for c in [
    "Appr_Inst", "Work_List", "Approval_Number", "Appr_Stat", "Event_Date_Time", "User", "Unit", "PO_HDR_Status",
    "WF_APPR_Status", "Dispatch_DTTM", "Threshold", "Buyer", "PO_Hdr_Created_Date", "SUM_MERCHANDISE_AMT"])
PO_APPROVAL_TEXT_DEFAULTS = ["Work_List", "Approval_Number", "Appr_Stat"]

REQ_APPROVAL = OrderedDict((c, c) for c in [
    "Appr_Inst", "Unit", "Appr_Step", "Appr_Path", "Work_List", "WL_Tran_ID", "Approval_Number", "Appr_Stat",
    "Status", "Date_Time", "User", "Req_Date"])
REQ_APPROVAL_TEXT_DEFAULTS = ["Work_List", "Approval_Number"]

PO_APPROVAL_LEGACY = OrderedDict([
    ("Appr_Inst", "Appr_Inst"), ("Work_List", "Work_List"), ("Approval_Number", "Approval_Number"),
    ("Appr_Stat", "Appr_Stat"), ("Denial_Date_Time", "Denial_Date_Time"), ("User", "Lv_Appr"), ("Unit", "Unit"),
    ("PO_HDR_Status", "PO_HDR_Status"), ("WF_APPR_Status", "WF_APPR_Status"), ("Dispatch_DTTM", "Dispatch_DTTM"),
    ("PO_Hdr_Created_Date", "PO_Hdr_Created_Date"), ("SUM_MERCHANDISE_AMT", "SUM_MERCHANDISE_AMT")])

CONTRACT_HEADER = OrderedDict([("Contract", "Contract_ID"), ("Expire_Dt", "Expire_Date"), ("Vendor", "Vendor_ID"),
                               ("Name", "Vendor_Name")])
CONTRACT_LINE = OrderedDict([("Line", "line"), ("More_Info", "More_Info"), ("Max_Amt", "Max_Amt")])

ITEM_ALIAS_HEADER = OrderedDict([
    ("Descr", "Item_Description"), ("Item_Group", "Item_Group.Group_Number"),
    ("GDescr", "Item_Group.Group_Description"), ("Status_Current", "Status"), ("Std_UOM", "UOM"),
    ("Itm_Status_Dt", "Status_Date")])
ITEM_SUBS = OrderedDict([("Mfg_ID", "Mfg_ID"), ("Mfg_Itm_ID", "Mfg_Item_ID")])
ITEM_PREV_PO = OrderedDict([
    ("PO_No", "PO_No"), ("Name", "Name"), ("PO_Date", "PO_Date"), ("Status", "PO_Status"),
    ("PO_Line_Status", "DistribStatus"), ("Receipt", "ReceiptStatus"), ("PO_Qty", "PO_Qty"),
    ("Received_Qty", "Received_Qty"), ("Amount", "Amount")])
ITEM_LOCATIONS = OrderedDict([
    ("Unit", "Unit"), ("Area", "Area"), ("Lev_1", "Level_1"), ("Lev_2", "Level_2"), ("Lev_3", "Level_3"),
    ("Lev_4", "Level_4"), ("Qty", "Qty")])
ITEM_WAREHOUSE = OrderedDict([
    ("Unit", "Unit"), ("Status_Current", "Status_Current"), ("Util_Type", "Util_Type"),
    ("Qty_On_Hand", "Qty_On_Hand"), ("Qty_Avail", "Qty_Available"), ("Reorder_Pt", "Reorder_Point"),
    ("Max_Qty", "Max_Qty"), ("Last_Mo", "Last_Month_Demand"), ("Last_Qtr", "Last_Quarter_Demand"),
    ("Last_Ann", "Last_Annual_Demand"), ("Ave_Cost", "Avg_Price"), ("Last_Ptwy", "Last_Putaway"),
    ("No_Repl", "No_Replenish"), ("Replen_Cls", "Replenish_Class"), ("Cost_Elmnt", "Cost_Element"),
    ("Repln_Lead", "Replenish_Lead")])

DASHBOARD = OrderedDict([
    ("Requisition_ID", "Req_ID"), ("Business_Unit", "Business_Unit"), ("Buyer", "Buyer"),
    ("Hold_From_Further_Processing", "Hold_From_Further_Processing"), ("Hold_Status", "Hold_Status"),
    ("Sourcing", "Sourcing"), ("Nbr_Lines_Not_Sourced", "Lines_Not_Sourced"), ("Out_To_Bid", "Out_To_Bid"),
    ("Transmitted", "Transmitted"), ("Transmitted_Time", "Transmitted_Time")])

EARLY_WARNING = OrderedDict([
    ("Req_Descr", "Req_Descr"), ("Unit", "Business_Unit"), ("Req_ID", "Req_ID"),
    ("Req_Created_Date", "Req_Created_Date"), ("WO_Num", "WO_Num"), ("PO_No", "PO_No"), ("Buyer", "Buyer"),
    ("HOLD_STATUS", "HOLD_STATUS"), ("Out_to_bid", "Out_to_bid"), ("Req_Status", "Req_Status"),
    ("Req_Approval_Date", "Req_Approval_Date"), ("Req_Total", "Req_Total"),
    ("Req_Dflt_Tble_Buyer", "Req_Dflt_Tble_Buyer"), ("PO_Date", "PO_Date"), ("Date", "Date_Approved")])

FRESHNESS = {
    "req": "REQ_DATA", "po": "PO_DATA", "req_po_xwalk": "PO_DATA_IN_REQ", "po_approval": "PO_DATA_WORKFLOW",
    "req_approval": "REQ_DATA_WORKFLOW", "po_approval_legacy": "PO_DATA", "contract": "CONTRACT_DATA",
    "item_alias": "ITEM_DATA", "item_po": "ITEM_DATA", "item_location": "ITEM_DATA", "item_warehouse": "ITEM_DATA",
    "item_backorder": "ITEM_DATA", "dashboard": "DASHBOARD_DATA", "early_warning": "EARLY_WARNING",
    "missing_po": "PO_DATA",
}
# ------------------------------------------------------------------------------------------------


def project(df: DataFrame, mapping: "OrderedDict[str, str]", keep: list[str] | None = None) -> DataFrame:
    """P3+P4: select and rename source columns; dotted targets become nested structs."""
    out: "OrderedDict[str, Column | OrderedDict]" = OrderedDict()
    for src, dst in mapping.items():
        if "." in dst:
            parent, child = dst.split(".", 1)
            out.setdefault(parent, OrderedDict())[child] = F.col(src)
        else:
            out[dst] = F.col(src)
    cols = [F.col(k) for k in (keep or [])]
    for name, v in out.items():
        cols.append(F.struct(*[c.alias(n) for n, c in v.items()]).alias(name) if isinstance(v, OrderedDict)
                    else v.alias(name))
    return df.select(*cols)


def targets(mapping: "OrderedDict[str, str]") -> list[str]:
    """Top-level target column names of a map (struct parents once)."""
    seen: list[str] = []
    for dst in mapping.values():
        top = dst.split(".", 1)[0]
        if top not in seen:
            seen.append(top)
    return seen
