"""
tables built from library operators, plus an independent DuckDB oracle.

Every query reads whole tables; nothing is sampled, capped or filtered to make the
check cheap. Where a query splits a table into "stored" and "new" snapshots it
does so on a data attribute (order status, return flag), which is how two real
snapshots overlap in keys.
"""
from __future__ import annotations

import datetime as dt
from collections import OrderedDict
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reqtrail import schemas as S
from reqtrail.functions import headers as H
from reqtrail.functions.nulls import DEFAULT_DUE, fill_columns, fill_timestamp, is_missing, text_or_empty
from reqtrail.functions.text import decode, matches_from_start, strip_ws, template
from reqtrail.operators import chunks, keyed, link, merge, nest, timeline
from reqtrail.plans import fixtures as fx
from reqtrail.plans.increments import INCREMENTS
from reqtrail.plans.job_queries import JOBS
from reqtrail.plans.oracle_views import LI_ORDER, with_views
from reqtrail.session import materialize, scratch_table_path
from reqtrail.sources import snapshot

# Fixed value: the "now" of every catalogue query, so results are reproducible.
AS_OF = dt.datetime(2030, 1, 1)
AS_OF_SQL = "TIMESTAMP '2030-01-01 00:00:00'"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_views(sql)
        return fn
    return deco


def _t(spark: SparkSession, sf_dir: str) -> fx.Tables:
    return fx.Tables(spark, sf_dir)


# ---------------------------------------------------------------- cleaning (P*, F*, S3)

# Report headers as a PO report prints them, and the P3 map of the PO loader.
PO_REPORT_HEADERS = ["PO No.", "Vendor", "Vendor Name", "Status", "PO Date", "PO/AprvDate.", "Sum Amount"]
PO_HEADER_MAP = {"PO_No": "PO_No", "Vendor": "Vendor_ID", "Vendor_Name": "Vendor", "Status": "Status",
                 "PO_Date": "PO_Date", "PO_AprvDate": "PO_Approval_Date", "Sum_Amount": "Line_Total"}


@query("header_cleanup_projection", """
select o_orderkey as PO_No, o_custkey as Vendor_ID, concat('Cust', cast(o_custkey as string)) as Vendor,
       o_orderstatus as Status, o_orderdate as PO_Date, o_orderdate + interval '3' day as PO_Approval_Date,
       o_totalprice as Line_Total
from orders""")
def header_cleanup_projection(spark, sf_dir):
    o = _t(spark, sf_dir).orders
    report = o.select(o.o_orderkey, o.o_custkey, F.concat(F.lit("Cust"), o.o_custkey.cast("string")),
                      o.o_orderstatus, o.o_orderdate, o.o_orderdate + F.expr("interval 3 days"),
                      o.o_totalprice).toDF(*PO_REPORT_HEADERS)
    clean = H.clean_headers(report, [H.SPACE, H.SLASH, H.DROP_DOT])
    return clean.select(*[F.col(a).alias(b) for a, b in PO_HEADER_MAP.items()])


@query("trim_pin_ids", """
select regexp_replace(raw, '^\\s+|\\s+$', '', 'g') as Item_No, p_name as Item_Description
from (select concat(case when p_size % 3 = 0 then chr(9) else ' ' end, lpad(cast(p_partkey as string), 8, '0'),
                    case when p_size % 2 = 0 then chr(9) || chr(10) else '  ' end) as raw, p_name from part) t""")
def trim_pin_ids(spark, sf_dir):
    p = _t(spark, sf_dir).part
    raw = F.concat(F.when(p.p_size % 3 == 0, "\t").otherwise(" "), F.lpad(p.p_partkey.cast("string"), 8, "0"),
                   F.when(p.p_size % 2 == 0, "\t\n").otherwise("  "))
    # S3: the id stays text end to end; "00000007" must not become 7.
    return p.select(strip_ws(raw).alias("Item_No"), p.p_name.alias("Item_Description"))


@query("null_defaults", """
select REQ_No, Line_No, Line_Total,
       coalesce(case when Line_No = 1 then null else Due_Date end, TIMESTAMP '2001-01-01 00:00:00') as Due_Date,
       coalesce(case when Line_No = 2 then null else Item end, '') as Item,
       coalesce(case when Line_No = 4 then null else Item end, 'n/a') as Address_2,
       (case when Line_No = 3 then null else Quantity end) is null as qty_missing
from fx_req_line""")
def null_defaults(spark, sf_dir):
    li = fx.fx_req_line(_t(spark, sf_dir))
    holes = li.select("REQ_No", "Line_No", "Line_Total",
                      F.when(F.col("Line_No") != 1, F.col("Due_Date")).alias("Due_Date"),
                      F.when(F.col("Line_No") != 2, F.col("Item")).alias("Item"),
                      F.when(F.col("Line_No") != 4, F.col("Item")).alias("Address_2"),
                      F.when(F.col("Line_No") != 3, F.col("Quantity")).alias("Quantity"))
    filled = fill_columns(holes, {"Address_2": "n/a"})                      # P7
    return filled.select("REQ_No", "Line_No", "Line_Total",
                         fill_timestamp("Due_Date", DEFAULT_DUE),            # P6/F11
                         text_or_empty("Item").alias("Item"),                # P5/F9
                         "Address_2",
                         is_missing("Quantity", numeric=True).alias("qty_missing"))  # F6


NEST_MAP = OrderedDict([("Business_Unit", "Department.Number"), ("Buyer", "Vendor.Number"), ("Approved_By", "Vendor.Name"),
                        ("Site", "Ship_To.Description"), ("Status", "Status")])


@query("nest_struct_roundtrip", """
select REQ_No, Business_Unit as Dept_Number, Buyer as Vendor_Number, Approved_By as Vendor_Name,
       concat('Site ', cast(Business_Unit as string)) as Ship_To_Description, Status
from fx_req""")
def nest_struct_roundtrip(spark, sf_dir):
    r = fx.fx_req(_t(spark, sf_dir))
    r = r.withColumn("Site", F.concat(F.lit("Site "), F.col("Business_Unit").cast("string")))
    # P3 + P4 by the loaders' own projection; the nested documents are written and read back.
    doc = materialize(S.project(r, NEST_MAP, keep=["REQ_No"]), "nested")
    return doc.select("REQ_No", F.col("Department.Number").alias("Dept_Number"),
                      F.col("Vendor.Number").alias("Vendor_Number"), F.col("Vendor.Name").alias("Vendor_Name"),
                      F.col("Ship_To.Description").alias("Ship_To_Description"), "Status")


# ---------------------------------------------------------------- keyed (A3, A4, A5)

LI_FIELDS = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate", "l_returnflag"]


@query("first_row_per_key", f"""
select l_orderkey, l_linenumber, {', '.join(LI_FIELDS)} from (
  select *, row_number() over (partition by l_orderkey, l_linenumber order by {LI_ORDER}) as rn from lineitem) t
where rn = 1""")
def first_row_per_key(spark, sf_dir):
    li = _t(spark, sf_dir).lineitem
    return keyed.first_per_key(li, ["l_orderkey", "l_linenumber"], fx.LINEITEM_ORDER, cols=LI_FIELDS)


@query("last_row_per_key", f"""
select l_orderkey, l_linenumber, {', '.join(LI_FIELDS)} from (
  select *, row_number() over (partition by l_orderkey, l_linenumber
                               order by {', '.join(c + ' desc' for c in LI_ORDER.split(', '))}) as rn
  from lineitem) t
where rn = 1""")
def last_row_per_key(spark, sf_dir):
    li = _t(spark, sf_dir).lineitem
    return keyed.last_per_key(li, ["l_orderkey", "l_linenumber"], fx.LINEITEM_ORDER, cols=LI_FIELDS)


@query("distinct_keys", "select distinct PO_No from fx_po_line")
def distinct_keys(spark, sf_dir):
    return keyed.distinct_keys(fx.fx_po_line(_t(spark, sf_dir)), ["PO_No"])


# ---------------------------------------------------------------- merges (K1-K8)
# Stored headers = orders not yet open ('F', 'P'); new snapshot = orders not final ('O', 'P'),
# with changed values and some NULLs. Keys overlap on 'P'.

SET_COLS = ["Status", "Amount", "Priority", "Clerk"]
OX_TGT = """select o_orderkey as PO_No, cast(o_custkey as string) as Vendor_ID, o_orderstatus as Status, o_orderdate as PO_Date,
       o_totalprice as Amount, o_orderpriority as Priority from orders where o_orderstatus <> 'O'"""
OX_SRC = """select o_orderkey as PO_No, cast(o_custkey + 1 as string) as Vendor_ID, lower(o_orderstatus) as Status,
       case when o_orderpriority = '5-LOW' then null else o_totalprice * 2 end as Amount,
       concat(o_orderpriority, '*') as Priority, concat('C', cast(o_custkey % 10 as string)) as Clerk
from orders where o_orderstatus <> 'F'"""


def _merge_target(t: fx.Tables) -> DataFrame:
    o = t.orders.where(F.col("o_orderstatus") != "O")
    return o.select(o.o_orderkey.alias("PO_No"), o.o_custkey.cast("string").alias("Vendor_ID"),
                    o.o_orderstatus.alias("Status"),
                    o.o_orderdate.alias("PO_Date"), o.o_totalprice.alias("Amount"),
                    o.o_orderpriority.alias("Priority"))


def _merge_source(t: fx.Tables) -> DataFrame:
    o = t.orders.where(F.col("o_orderstatus") != "F")
    return o.select(o.o_orderkey.alias("PO_No"), (o.o_custkey + 1).cast("string").alias("Vendor_ID"),
                    F.lower(o.o_orderstatus).alias("Status"),
                    F.when(o.o_orderpriority != "5-LOW", o.o_totalprice * 2).alias("Amount"),
                    F.concat(o.o_orderpriority, F.lit("*")).alias("Priority"),
                    F.concat(F.lit("C"), (o.o_custkey % 10).cast("string")).alias("Clerk"))


@query("upsert_headers", f"""
with t as ({OX_TGT}), s as ({OX_SRC})
select coalesce(t.PO_No, s.PO_No) as PO_No, t.Vendor_ID,
       case when s.PO_No is not null then s.Status else t.Status end as Status, t.PO_Date,
       case when s.PO_No is not null then s.Amount else t.Amount end as Amount,
       case when s.PO_No is not null then s.Priority else t.Priority end as Priority, s.Clerk
from t full outer join s on t.PO_No = s.PO_No""")
def upsert_headers(spark, sf_dir):
    t = _t(spark, sf_dir)
    return merge.upsert(_merge_target(t), _merge_source(t), ["PO_No"], SET_COLS)


@query("update_only_headers", f"""
with t as ({OX_TGT}), s as ({OX_SRC})
select t.PO_No, t.Vendor_ID,
       case when s.PO_No is not null then s.Status else t.Status end as Status, t.PO_Date,
       case when s.PO_No is not null then s.Amount else t.Amount end as Amount,
       case when s.PO_No is not null then s.Priority else t.Priority end as Priority, s.Clerk
from t left join s on t.PO_No = s.PO_No""")
def update_only_headers(spark, sf_dir):
    t = _t(spark, sf_dir)
    return merge.update_only(_merge_target(t), _merge_source(t), ["PO_No"], SET_COLS)


@query("update_unmatched", f"""
with t as ({OX_TGT}), s as ({OX_SRC})
select * from s where not exists (select 1 from t where t.PO_No = s.PO_No)""")
def update_unmatched(spark, sf_dir):
    t = _t(spark, sf_dir)
    return merge.unmatched(_merge_target(t), _merge_source(t), ["PO_No"])


DASH_SQL = """select user_id as REQ_No, user_id as Req_ID, event_type as Hold_Status, value as Amount,
       case when event_type = 'error' then null else ts end as Transmitted_Time from (
  select *, row_number() over (partition by user_id order by event_id desc) as rn from events) t where rn = 1"""


@query("replace_all_last_wins", DASH_SQL)
def replace_all_last_wins(spark, sf_dir):
    e = _t(spark, sf_dir).events
    snap = e.select(e.user_id.alias("REQ_No"), e.event_id, e.event_type.alias("Hold_Status"),
                    e.value.alias("Amount"), F.when(e.event_type != "error", e.ts).alias("Transmitted_Time"))
    out = merge.replace_all(snap, keys=["REQ_No"], order=["event_id"])
    # The dashboard row carries the id twice.
    return out.select("REQ_No", F.col("REQ_No").alias("Req_ID"), "Hold_Status", "Amount", "Transmitted_Time")


@query("replace_all_append", """
select event_id, user_id as Req_ID, coalesce(case when event_type = 'click' then null else props end, '') as Req_Descr,
       event_type as Req_Status, case when event_type = 'view' then null else ts end as Req_Created_Date,
       value as Req_Total
from events where event_type <> 'purchase'
union all
select event_id, user_id, coalesce(case when event_type = 'click' then null else props end, ''), event_type,
       case when event_type = 'view' then null else ts end, value
from events where event_type <> 'error'""")
def replace_all_append(spark, sf_dir):
    e = _t(spark, sf_dir).events
    snap = e.select("event_id", e.user_id.alias("Req_ID"),
                    text_or_empty(F.when(e.event_type != "click", e.props)).alias("Req_Descr"),
                    e.event_type.alias("Req_Status"),
                    F.when(e.event_type != "view", e.ts).alias("Req_Created_Date"),  # D1: dates stay NULL
                    e.value.alias("Req_Total"))
    # The collection is dropped and one snapshot stored (K3); every row of the next one is inserted,
    # also those that are there already (K4).
    stored = materialize(merge.replace_all(snap.where(F.col("Req_Status") != "purchase")), "early-warnings")
    return merge.append(stored, snap.where(F.col("Req_Status") != "error"))


@query("accumulate_first_vendor", """
with t as (select PO_No, Vendor from (select *, row_number() over (partition by PO_No
           order by PO_Date, REQ_No, Req_Line, Vendor, Line_Total, Quantity) as k from fx_po_line where Status <> 'A') x where k = 1),
     n as (select PO_No, Vendor from (select *, row_number() over (partition by PO_No
           order by PO_Date, REQ_No, Req_Line, Vendor, Line_Total, Quantity) as k from fx_po_line where Status <> 'C') x where k = 1)
select coalesce(t.PO_No, n.PO_No) as PO_No, case when n.PO_No is not null then n.Vendor else t.Vendor end as Vendor
from t full outer join n on t.PO_No = n.PO_No""")
def accumulate_first_vendor(spark, sf_dir):
    pl = fx.fx_po_line(_t(spark, sf_dir))
    stored = keyed.first_per_key(pl.where(F.col("Status") != "A"), ["PO_No"], fx.PO_LINE_ORDER, cols=["Vendor"])
    snap = keyed.first_per_key(pl.where(F.col("Status") != "C"), ["PO_No"], fx.PO_LINE_ORDER, cols=["Vendor"])
    return merge.upsert(stored, snap, ["PO_No"], ["Vendor"])  # D9: never cleared


# Children: stored = lines not returned ('A','N'); new snapshot = lines not accepted ('N','R').
CHILD_FIELDS = ["l_linenumber", "l_partkey", "l_quantity", "l_shipdate"]
OX_OLD_CHILD = "select l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate, 'old' as src from lineitem where l_returnflag <> 'R'"
OX_NEW_CHILD = "select l_orderkey, l_linenumber, l_partkey, l_quantity + 100 as l_quantity, l_shipdate, 'new' as src from lineitem where l_returnflag <> 'A'"


def _old_children(t: fx.Tables) -> DataFrame:
    li = t.lineitem.where(F.col("l_returnflag") != "R")
    return li.select("l_orderkey", *CHILD_FIELDS, F.lit("old").alias("src"))


def _new_children(t: fx.Tables) -> DataFrame:
    li = t.lineitem.where(F.col("l_returnflag") != "A")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", (li.l_quantity + 100).alias("l_quantity"),
                     "l_shipdate", F.lit("new").alias("src"))


@query("replace_children_bag", f"""
with o as ({OX_OLD_CHILD}), n as ({OX_NEW_CHILD})
select * from o where l_orderkey not in (select l_orderkey from n)
union all select * from n""")
def replace_children_bag(spark, sf_dir):
    t = _t(spark, sf_dir)
    return merge.replace_children(_old_children(t), _new_children(t), ["l_orderkey"])


@query("replace_children_set", """
with o as (select l_orderkey, l_returnflag, l_linestatus, 'old' as src from lineitem where l_returnflag <> 'R'),
     n as (select distinct l_orderkey, l_returnflag, l_linestatus, 'new' as src from lineitem where l_returnflag <> 'A')
select * from o where l_orderkey not in (select l_orderkey from n)
union all select * from n""")
def replace_children_set(spark, sf_dir):
    li = _t(spark, sf_dir).lineitem
    fields = ["l_returnflag", "l_linestatus"]
    old = li.where(F.col("l_returnflag") != "R").select("l_orderkey", *fields, F.lit("old").alias("src"))
    new = li.where(F.col("l_returnflag") != "A").select("l_orderkey", *fields, F.lit("new").alias("src"),
                                                         F.col("l_linenumber").alias("_first"))
    out = merge.replace_children(old, new, ["l_orderkey"], dedup_fields=fields + ["src"], order="_first")
    return out.drop("_first")


@query("replace_children_update_only", f"""
with o as ({OX_OLD_CHILD}), n as ({OX_NEW_CHILD}),
     p as (select o_orderkey from orders where o_orderstatus <> 'O'),
     m as (select * from n where l_orderkey in (select o_orderkey from p))
select * from o where l_orderkey not in (select l_orderkey from m)
union all select * from m""")
def replace_children_update_only(spark, sf_dir):
    t = _t(spark, sf_dir)
    parent = t.orders.where(F.col("o_orderstatus") != "O").select(F.col("o_orderkey").alias("l_orderkey"))
    return merge.replace_children(_old_children(t), _new_children(t), ["l_orderkey"], parent=parent)


@query("backorder_reset_set", f"""
with s as (select cast(l_partkey as string) as Item_No, l_quantity as Qty from (
             select *, row_number() over (partition by l_partkey order by {', '.join(c + ' desc' for c in LI_ORDER.split(', '))}) as rn
             from lineitem where l_returnflag = 'R') x where rn = 1)
select cast(p.p_partkey as string) as Item_No, p.p_name as Item_Description,
       case when s.Item_No is not null then s.Qty else 0.0 end as Total_Backorder
from part p left join s on s.Item_No = cast(p.p_partkey as string)""")
def backorder_reset_set(spark, sf_dir):
    t = _t(spark, sf_dir)
    items = t.part.select(F.col("p_partkey").cast("string").alias("Item_No"),
                          F.col("p_name").alias("Item_Description"),
                          F.col("p_size").cast("double").alias("Total_Backorder"))
    snap = (t.lineitem.where(F.col("l_returnflag") == "R")
             .select(strip_ws(F.col("l_partkey").cast("string")).alias("Item_No"),
                     F.col("l_quantity").alias("Total_Backorder"), *fx.LINEITEM_ORDER))
    # K8 (every item back to 0) and K2 (last row per item wins, D10) in one left join.
    return merge.reset_and_set(items, snap, ["Item_No"], "Total_Backorder", fx.LINEITEM_ORDER, default=0.0)


@query("freshness_stamp", f"""
select event_type as dbname,
       case when event_type in ('purchase', 'view', 'NEW_DATASET') then {AS_OF_SQL} else max(ts) end as last_updated_time
from events group by event_type""")
def freshness_stamp(spark, sf_dir):
    e = _t(spark, sf_dir).events
    control = e.groupBy(F.col("event_type").alias("dbname")).agg(F.max("ts").alias("last_updated_time"))
    return merge.stamp(control, ["purchase", "view", "NEW_DATASET"], AS_OF)


# ---------------------------------------------------------------- nesting (A1, A2, K9) and links

@query("nest_lines_positions", f"""
select l.l_orderkey as o_orderkey,
       cast(row_number() over (partition by l.l_orderkey order by {', '.join('l.' + c for c in LI_ORDER.split(', '))}) - 1 as integer) as pos,
       l.l_linenumber, l.l_partkey, l.l_quantity
from lineitem l join orders o on o.o_orderkey = l.l_orderkey""")
def nest_lines_positions(spark, sf_dir):
    """A1 in the flat canonical form: each line's position under its order (the array
    index of the document view), from the skew-safe sequencer, for lines whose order exists."""
    t = _t(spark, sf_dir)
    lines = (t.lineitem.select(*fx.LINEITEM_ORDER)
              .join(t.orders.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi"))
    pos = nest.positions(lines, ["l_orderkey"], fx.LINEITEM_ORDER[1:])
    return pos.select(F.col("l_orderkey").alias("o_orderkey"), "pos", "l_linenumber", "l_partkey", "l_quantity")


@query("add_to_set_positions", f"""
select l_suppkey, cast(row_number() over (partition by l_suppkey order by {LI_ORDER}) - 1 as integer) as pos,
       l_linenumber, l_returnflag, l_linestatus
from (select *, row_number() over (partition by l_suppkey, l_linenumber, l_returnflag, l_linestatus
                                   order by {LI_ORDER}) as k from lineitem) t
where k = 1""")
def add_to_set_positions(spark, sf_dir):
    li = _t(spark, sf_dir).lineitem
    fields = ["l_linenumber", "l_returnflag", "l_linestatus"]
    rows = li.select("l_suppkey", *fields, keyed.order_key(fx.LINEITEM_ORDER).alias("_ord"))
    first = merge.dedup_children(rows, ["l_suppkey"], fields, "_ord")
    return nest.positions(first, ["l_suppkey"], ["_ord"]).select("l_suppkey", "pos", *fields)


ITEM_SQL = f"""
with rows as (select lpad(cast(l.l_partkey as string), 9, ' ') as Item, p.p_name as Descr, p.p_brand as Item_Group,
                     p.p_type as GDescr, l.l_shipdate as Itm_Status_Dt, cast(l.l_suppkey as string) as Mfg_ID,
                     concat(cast(l.l_suppkey as string), '-', cast(l.l_partkey as string)) as Mfg_Itm_ID,
                     {', '.join('l.' + c for c in LI_ORDER.split(', '))}
              from lineitem l join part p on p.p_partkey = l.l_partkey),
     h as (select trim(Item) as Item_No, Descr as Item_Description, Item_Group as Group_Number,
                  GDescr as Group_Description, Itm_Status_Dt as Status_Date from (
             select *, row_number() over (partition by trim(Item) order by {LI_ORDER}) as rn from rows) x where rn = 1)
select h.*, r.Mfg_ID, r.Mfg_Itm_ID as Mfg_Item_ID from h join rows r on trim(r.Item) = h.Item_No"""


@query("item_master_alias", ITEM_SQL)
def item_master_alias(spark, sf_dir):
    t = _t(spark, sf_dir)
    li, p = t.lineitem, t.part
    rows = li.join(p, p.p_partkey == li.l_partkey).select(
        F.lpad(li.l_partkey.cast("string"), 9, " ").alias("Item"), p.p_name.alias("Descr"),
        p.p_brand.alias("Item_Group"), p.p_type.alias("GDescr"), li.l_shipdate.alias("Itm_Status_Dt"),
        li.l_suppkey.cast("string").alias("Mfg_ID"),
        F.concat(li.l_suppkey.cast("string"), F.lit("-"), li.l_partkey.cast("string")).alias("Mfg_Itm_ID"),
        *[li[c] for c in fx.LINEITEM_ORDER])
    rows = rows.withColumn("Item", strip_ws("Item"))                        # F1 on the id
    # A3 and K5 in one pass: the first row's fields next to every substitute of the item. The minimum is
    # taken in the map tasks first; the report is written once, since both sides read it.
    rows = materialize(rows.select("Item", "Mfg_ID", "Mfg_Itm_ID", F.struct(
        *fx.LINEITEM_ORDER, "Descr", "Item_Group", "GDescr", "Itm_Status_Dt").alias("_r")), "item-report")
    header = rows.groupBy("Item").agg(F.min("_r").alias("_h"))
    return rows.join(header, "Item").select(
        F.col("Item").alias("Item_No"), F.col("_h.Descr").alias("Item_Description"), F.col("_h.Item_Group").alias("Group_Number"),
        F.col("_h.GDescr").alias("Group_Description"), F.col("_h.Itm_Status_Dt").alias("Status_Date"),
        "Mfg_ID", F.col("Mfg_Itm_ID").alias("Mfg_Item_ID"))


LINK_SQL = f"""
with x as (select Req_ID, Unit, REQ_Line, PO_No, PO_Line from (
             select *, row_number() over (partition by Req_ID, Unit, REQ_Line
                                          order by {', '.join(c + ' desc' for c in LI_ORDER.split(', '))}) as rn
             from fx_xwalk) t where rn = 1)
select l.REQ_No, l.Business_Unit, l.Line_No, l.Line_Total, l.Quantity, l.Item,
       x.PO_No as PO_Number, x.PO_Line as PO_Line_No
from fx_req_line l left join x on x.Req_ID = l.REQ_No and x.Unit = l.Business_Unit and x.REQ_Line = l.Line_No"""
LINE_COLS = ["REQ_No", "Business_Unit", "Line_No", "Line_Total", "Quantity", "Item"]


@query("attach_po_to_lines", LINK_SQL)
def attach_po_to_lines(spark, sf_dir):
    t = _t(spark, sf_dir)
    lines = fx.fx_req_line(t).select(*LINE_COLS)
    return link.attach_link(lines, fx.fx_xwalk(t), ["REQ_No", "Business_Unit", "Line_No"],
                            ["Req_ID", "Unit", "REQ_Line"], {"PO_No": "PO_Number", "PO_Line": "PO_Line_No"},
                            fx.LINEITEM_ORDER)


@query("attach_po_nested", LINK_SQL)
def attach_po_nested(spark, sf_dir):
    t = _t(spark, sf_dir)
    req = fx.fx_req(t).select("REQ_No", "Business_Unit")
    li = t.lineitem
    lines = li.select(li.l_orderkey.alias("REQ_No"), li.l_linenumber.alias("Line_No"),
                      li.l_extendedprice.alias("Line_Total"), li.l_quantity.alias("Quantity"),
                      li.l_partkey.cast("string").alias("Item"),
                      *[li[c].alias("_o_" + c) for c in fx.LINEITEM_ORDER[1:]])
    docs = nest.nest_lines(req, lines, ["REQ_No"], ["_o_" + c for c in fx.LINEITEM_ORDER[1:]],
                           ["Line_No", "Line_Total", "Quantity", "Item"])
    linked = link.attach_link_nested(docs, fx.fx_xwalk(t), ["REQ_No", "Business_Unit"], ["Req_ID", "Unit"],
                                     "lines", "Line_No", "REQ_Line", "PO",
                                     {"PO_No": "PO_Number", "PO_Line": "Line_No"}, fx.LINEITEM_ORDER,
                                     doc_id=["REQ_No"])
    flat = linked.select("REQ_No", "Business_Unit", F.explode("lines").alias("l"))
    return flat.select("REQ_No", "Business_Unit", "l.Line_No", "l.Line_Total", "l.Quantity", "l.Item",
                       F.col("l.PO.PO_Number").alias("PO_Number"), F.col("l.PO.Line_No").alias("PO_Line_No"))


@query("link_chunked_documents", f"""
with x as (select l_returnflag, l_orderkey, l_suppkey from (
             select *, row_number() over (partition by l_returnflag, l_orderkey
                                          order by {', '.join(c + ' desc' for c in LI_ORDER.split(', '))}) as rn
             from lineitem where l_linestatus = 'F') t where rn = 1)
select l.l_returnflag, cast(floor(l.pos / {chunks.CHUNK_ROWS}) as integer) as chunk, l.pos, l.l_orderkey, l.l_linenumber, l.l_quantity,
       cast(x.l_suppkey as bigint) as supplier
from (select *, cast(row_number() over (partition by l_returnflag order by {LI_ORDER}) - 1 as integer) as pos from lineitem) l
left join x on x.l_returnflag = l.l_returnflag and x.l_orderkey = l.l_orderkey""")
def link_chunked_documents(spark, sf_dir):
    """A1 and K9 on documents larger than a row: one document per return flag, which holds up to half of all lines; each of its
    elements gets the supplier of its order's last finished line there. Chunks are written, linked and taken apart."""
    li = _t(spark, sf_dir).lineitem
    docs = materialize(chunks.chunk_lines(li.select("l_returnflag", *fx.LINEITEM_ORDER), ["l_returnflag"], fx.LINEITEM_ORDER,
                                          ["l_orderkey", "l_linenumber", "l_quantity"]), "line-chunks")
    finished = li.where(li.l_linestatus == "F")
    linked = link.attach_link_nested(docs, finished, ["l_returnflag"], ["l_returnflag"], "lines", "l_orderkey", "l_orderkey", "last",
                                     {"l_suppkey": "supplier"}, fx.LINEITEM_ORDER, chunk="chunk")
    flat = chunks.unchunk_lines(linked, ["l_returnflag", "chunk"], "lines")
    return flat.select("l_returnflag", "chunk", "pos", "l_orderkey", "l_linenumber", "l_quantity",
                       F.col("last.supplier").cast("long").alias("supplier"))


@query("worklist_legacy_shape", """
with n as (select PO_No, Appr_Inst, Work_List, Approval_Number, Appr_Stat,
                  case when Appr_Stat = 'D' then Event_Date_Time end as Denial_Date_Time, "User" as Lv_Appr, 'new' as src
           from fx_po_worklist where Appr_Stat <> 'click'),
     o as (select PO_No, Appr_Inst, Work_List, Approval_Number, Appr_Stat,
                  case when Appr_Stat = 'D' then Event_Date_Time end as Denial_Date_Time, "User" as Lv_Appr, 'old' as src
           from fx_po_worklist where Appr_Stat in ('click', 'signup', 'A'))
select * from o where PO_No not in (select PO_No from n)
union all select * from n""")
def worklist_legacy_shape(spark, sf_dir):
    wl = materialize(fx.fx_po_worklist(_t(spark, sf_dir)), "worklist-report")  # read by both snapshots and for the keys

    def shape(df, src):
        # Each row keeps its own dates; a missing date stays NULL.
        return df.select("PO_No", "Appr_Inst", "Work_List", "Approval_Number", "Appr_Stat",
                         F.when(F.col("Appr_Stat") == "D", F.col("Event_Date_Time")).alias("Denial_Date_Time"),
                         F.col("User").alias("Lv_Appr"), F.lit(src).alias("src"))
    old = shape(wl.where(F.col("Appr_Stat").isin("click", "signup", "A")), "old")
    new = shape(wl.where(F.col("Appr_Stat") != "click"), "new")
    # K1 stub (PO_No only) + K7 reset + K5 push: children of snapshot POs are replaced.
    return merge.replace_children(old, new, ["PO_No"])


# ---------------------------------------------------------------- decode / regex

@query("code_decode", """
select event_id, Appr_Stat,
       case Appr_Stat when 'I' then 'Initiated' when 'A' then 'Approved' when 'D' then 'Denied' else Appr_Stat end as EventType
from (select event_id, case event_type when 'view' then 'I' when 'purchase' then 'A' when 'error' then 'D'
                                      else event_type end as Appr_Stat from events) t""")
def code_decode(spark, sf_dir):
    e = _t(spark, sf_dir).events
    coded = e.select("event_id", fx._worklist_code(e.event_type).alias("Appr_Stat"))
    return coded.select("event_id", "Appr_Stat", decode("Appr_Stat").alias("EventType"))


@query("internal_flag", """
select PO_No, Appr_Inst, wl as Work_List, coalesce(regexp_matches(wl, '(?i)^[^\\n]*procurement'), false) as Internal
from (select PO_No, Appr_Inst,
             case Appr_Inst % 5 when 0 then Work_List when 1 then concat('a', chr(10), Work_List) when 2 then null
                                when 3 then lower(Work_List) else concat(upper(Work_List), ' x') end as wl
      from fx_po_worklist) t""")
def internal_flag(spark, sf_dir):
    wl = fx.fx_po_worklist(_t(spark, sf_dir))
    m = F.col("Appr_Inst") % 5
    variant = (F.when(m == 0, F.col("Work_List")).when(m == 1, F.concat(F.lit("a\n"), F.col("Work_List")))
                .when(m == 2, F.lit(None).cast("string")).when(m == 3, F.lower("Work_List"))
                .otherwise(F.concat(F.upper("Work_List"), F.lit(" x"))))
    v = wl.select("PO_No", "Appr_Inst", variant.alias("Work_List"))
    return v.withColumn("Internal", matches_from_start("Work_List"))


# ---------------------------------------------------------------- classification

def _inputs(spark, sf_dir):
    t = _t(spark, sf_dir)
    return t, fx.fx_req(t), fx.fx_link(t), fx.fx_po(t), fx.fx_po_line(t)


@query("split_requests", """
select q.REQ_No, count(distinct k.PO_Number) as n_po, min(k.PO_Number) as link_po,
       count(distinct k.PO_Number) > 1 as is_split
from fx_req q left join fx_link k on k.REQ_No = q.REQ_No group by q.REQ_No""")
def split_requests(spark, sf_dir):
    _, req, lnk, _, _ = _inputs(spark, sf_dir)
    r = req.select("REQ_No").join(timeline.pos_per_req(lnk), "REQ_No", "left")
    n = F.coalesce(F.col("n_po"), F.lit(0)).cast("bigint")
    return r.select("REQ_No", n.alias("n_po"), "link_po", (n > 1).alias("is_split"))


@query("bundled_pos", """
select PO_No,
       cast(count(distinct Req_ID) + count(*) filter (where Req_ID is null) as bigint) as n_req_each,
       cast(count(distinct Req_ID) + case when count(*) filter (where Req_ID is null) > 0 then 1 else 0 end as bigint) as n_req_one,
       cast(count(distinct Req_ID) as bigint) as n_req_ignore,
       count(distinct Req_ID) + count(*) filter (where Req_ID is null) > 1 as is_bundled,
       concat('[BundledPO] ', cast(count(distinct Req_ID) + count(*) filter (where Req_ID is null) as string),
              ' REQs found with ', PO_No, '.') as message
from fx_po_line group by PO_No""")
def bundled_pos(spark, sf_dir):
    _, _, _, _, pl = _inputs(spark, sf_dir)
    return timeline.req_counts_per_po(pl).select("PO_No", "n_req_each", "n_req_one", "n_req_ignore",
                      (F.col("n_req_each") > 1).alias("is_bundled"),
                      template(timeline.MSG_BUNDLED, "n_req_each", "PO_No").alias("message"))


@query("valid_pos", """
select PO_No, Status, PO_Approval_Date, not (PO_Approval_Date is null and coalesce(Status in ('C', 'D'), false)) as is_valid
from fx_po""")
def valid_pos(spark, sf_dir):
    _, _, _, po, _ = _inputs(spark, sf_dir)
    return po.select("PO_No", "Status", "PO_Approval_Date", timeline.valid_po().alias("is_valid"))


@query("req_po_join", """
with r as (select REQ_No, min(PO_Number) as PO_No from fx_link group by REQ_No having count(distinct PO_Number) = 1)
select r.REQ_No, r.PO_No, p.PO_No is not null as matched, p.PO_Date, p.Status, p.PO_Approval_Date
from r join fx_req q on q.REQ_No = r.REQ_No
left join fx_po p on p.PO_No = r.PO_No and p.Business_Unit = q.Business_Unit""")
def req_po_join(spark, sf_dir):
    _, req, lnk, po, _ = _inputs(spark, sf_dir)
    one = timeline.pos_per_req(lnk).where(F.col("n_po") == 1).select("REQ_No", F.col("link_po").alias("PO_No"))
    r = one.join(req.select("REQ_No", "Business_Unit"), "REQ_No")
    p = po.select(F.col("PO_No").alias("_p"), F.col("Business_Unit").alias("_bu"), "PO_Date", "Status",
                  "PO_Approval_Date")
    j = r.join(p, (r.PO_No == p._p) & (r.Business_Unit == p._bu), "left")   # J1/P9: two keys
    return j.select("REQ_No", "PO_No", F.col("_p").isNotNull().alias("matched"), "PO_Date", "Status",
                    "PO_Approval_Date")


CLASS_SQL = """select REQ_No,
       case when cls = 'complete' then link_po else '' end as PO_No,
       case when cls = 'complete' then cast(Business_Unit as string) else '' end as Business_Unit,
       case cls when 'SPLITREQ' then concat('[SPLITREQ] REQ ', cast(REQ_No as string), ' has ', cast(n_po as string),
                                            ' POs associated with it.')
                when 'BundledPO' then concat('[BundledPO] ', cast(n_req as string), ' REQs found with ', link_po, '.')
                when 'NoValidPO' then concat('No POs associated with REQ ', cast(REQ_No as string),
                                             ' are valid. Did not insert in DB.')
                else '' end as Complicated,
       '' as Footnote, cls,
       case when cls <> 'NoValidPO' then null when n_po = 0 then 'none' when found_po is null then 'mismatch'
            else 'invalid' end as cause,
       n_po
from ox_class"""


@query("classify_requests", CLASS_SQL)
def classify_requests(spark, sf_dir):
    _, req, lnk, po, pl = _inputs(spark, sf_dir)
    return timeline.classify_requests(req, lnk, po, pl)


@query("reqs_without_valid_po", """
select REQ_No, case when n_po = 0 then 'none' when found_po is null then 'mismatch' else 'invalid' end as cause
from ox_class where cls = 'NoValidPO'""")
def reqs_without_valid_po(spark, sf_dir):
    _, req, lnk, po, pl = _inputs(spark, sf_dir)
    c = timeline.classify_requests(req, lnk, po, pl)
    return c.where(F.col("cls") == timeline.NO_VALID).select("REQ_No", "cause")


@query("classify_requests_worklist_rule", f"""
select c.REQ_No, case when w.REQ_No is null then '' else c.PO_No end as PO_No,
       case when w.REQ_No is null then '' else c.Business_Unit end as Business_Unit,
       case when w.REQ_No is null then concat('[NoWorklist] Req ', cast(c.REQ_No as string), ' does not have a worklist.')
            else c.Complicated end as Complicated,
       c.Footnote, case when w.REQ_No is null then 'NoWorklist' else c.cls end as cls,
       case when w.REQ_No is null then null else c.cause end as cause, c.n_po
from ({CLASS_SQL}) c left join (select distinct REQ_No from fx_req_worklist) w on w.REQ_No = c.REQ_No""")
def classify_requests_worklist_rule(spark, sf_dir):
    t, req, lnk, po, pl = _inputs(spark, sf_dir)
    return timeline.classify_requests(req, lnk, po, pl, req_worklist=fx.fx_req_worklist(t), require_worklist=True)


# ---------------------------------------------------------------- events and timeline

EV = "seq, ID, Start_DTTM, EventType, Text, Person, Internal, Neutral, Auto, Lifecycle"


@query("req_events", f"select REQ_No, {EV} from ox_req_events")
def req_events(spark, sf_dir):
    return timeline.req_events(fx.fx_req(_t(spark, sf_dir)))


@query("po_events", f"select PO_No, {EV} from ox_po_events")
def po_events(spark, sf_dir):
    return timeline.po_events(fx.fx_po(_t(spark, sf_dir)))


@query("worklist_events", f"select PO_No, {EV} from ox_wl_events")
def worklist_events(spark, sf_dir):
    return timeline.worklist_events(fx.fx_po_worklist(_t(spark, sf_dir)), "Appr_Inst")  # an event of its own here


@query("req_worklist_events", """
select REQ_No, cast(Appr_Inst as string) as ID, Date_Time as Start_DTTM, '' as EventType, '' as Text, '' as Person,
       false as Internal, false as Neutral, false as Auto, '' as Lifecycle
from fx_req_worklist""")
def req_worklist_events(spark, sf_dir):
    return timeline.req_worklist_events(fx.fx_req_worklist(_t(spark, sf_dir)))


def _timeline(spark, sf_dir, req_steps: bool = False):
    t, req, lnk, po, pl = _inputs(spark, sf_dir)
    return timeline.requisition_timeline(req, lnk, po, pl, fx.fx_po_worklist(t), as_of=AS_OF, worklist_order="Appr_Inst",
                                         req_worklist=fx.fx_req_worklist(t) if req_steps else None, include_req_worklist=req_steps)


EVENT_FIELDS = "REQ_No, PO_No, seq, ID, Start_DTTM, End_DTTM, EventType, Text, Person, Internal, Neutral, Auto, Lifecycle"


@query("timeline_events", f"select {EVENT_FIELDS} from ox_timeline")
def timeline_events(spark, sf_dir):
    return _timeline(spark, sf_dir)[1]


@query("timeline_events_req_steps", f"select {EVENT_FIELDS} from ox_timeline_req_steps")
def timeline_events_req_steps(spark, sf_dir):
    """L16 with the T5 branch: the requisition's own approval steps follow those of its PO."""
    return _timeline(spark, sf_dir, req_steps=True)[1]


@query("timeline_summary", f"""
with c as ({CLASS_SQL}),
     e as (select REQ_No, count(*) as n_events, min(Start_DTTM) as first_start, max(End_DTTM) as last_end,
                  min(case when seq = 0 then EventType end) as first_type,
                  max(seq) as last_seq from ox_timeline group by REQ_No),
     l as (select t.REQ_No, t.Text as last_text from ox_timeline t join e on e.REQ_No = t.REQ_No and t.seq = e.last_seq)
select c.REQ_No, c.PO_No, c.Business_Unit, c.cls, c.Complicated, c.Footnote, coalesce(e.n_events, 0) as n_events,
       e.first_start, e.last_end, e.first_type, l.last_text
from c left join e on e.REQ_No = c.REQ_No left join l on l.REQ_No = c.REQ_No""")
def timeline_summary(spark, sf_dir):
    cls, ev = _timeline(spark, sf_dir)
    return timeline.timeline_summary(cls, ev)


@query("timeline_documents", f"""
select c.REQ_No, c.PO_No, c.Business_Unit, c.Complicated, c.cls,
       cast(row_number() over (partition by c.REQ_No order by e.seq) - 1 as integer) as pos,
       e.ID, e.Start_DTTM, e.End_DTTM, e.EventType, e.Text, e.Person, e.Internal, e.Neutral, e.Auto, e.Lifecycle
from ({CLASS_SQL}) c left join ox_timeline e on e.REQ_No = c.REQ_No""")
def timeline_documents(spark, sf_dir):
    """The nested documents (T6), written, read back and taken apart again; a document without events is one row."""
    cls, ev = _timeline(spark, sf_dir)
    docs = materialize(timeline.timeline_documents(cls, ev), "timeline-documents")
    flat = docs.select("REQ_No", "PO_No", "Business_Unit", "Complicated", "cls", F.posexplode_outer("events").alias("pos", "e"))
    return flat.select("REQ_No", "PO_No", "Business_Unit", "Complicated", "cls",
                       F.coalesce(F.col("pos"), F.lit(0)).cast("int").alias("pos"), "e.*")


@query("timeline_document_chunks", f"""
select c.REQ_No, c.PO_No, c.Business_Unit, c.Complicated, c.cls,
       cast(floor((row_number() over (partition by c.REQ_No order by e.seq) - 1) / 2) as integer) as chunk,
       e.ID, e.Start_DTTM, e.End_DTTM, e.EventType, e.Text, e.Person, e.Internal, e.Neutral, e.Auto, e.Lifecycle
from ({CLASS_SQL}) c left join ox_timeline e on e.REQ_No = c.REQ_No""")
def timeline_document_chunks(spark, sf_dir):
    """The documents in chunks of two events, so that most have several; written, read back and taken apart again."""
    cls, ev = _timeline(spark, sf_dir)
    docs = materialize(timeline.timeline_document_chunks(cls, ev, rows=2), "timeline-chunks")
    return docs.select("REQ_No", "PO_No", "Business_Unit", "Complicated", "cls", "chunk", F.explode_outer("events").alias("e")).select(
        "REQ_No", "PO_No", "Business_Unit", "Complicated", "cls", "chunk", "e.*")


# ---------------------------------------------------------------- sources and sinks (S1-S3, P2, K3, K11), flags

ORDER_SCHEMA = T.StructType([T.StructField("PO No.", T.StringType()), T.StructField("Vendor", T.StringType()), T.StructField("Amount", T.DoubleType()),
                             T.StructField("Note", T.StringType())])


def _order_report(t: fx.Tables) -> DataFrame:
    """Ids with leading zeros, and a note that breaks over two lines where the order has a shipping priority."""
    o = t.orders
    note = F.when(o.o_custkey % 3 != 0, F.concat(o.o_orderpriority, F.when(o.o_custkey % 2 == 0, F.lit('\nsays "yes", so')).otherwise(F.lit(""))))
    return o.select(F.lpad(o.o_orderkey.cast("string"), 12, "0").alias("PO No."), o.o_custkey.cast("string").alias("Vendor"),
                    o.o_totalprice.alias("Amount"), note.alias("Note"), o.o_orderstatus.alias("status"))


ORDER_REPORT_SQL = """select lpad(cast(o_orderkey as string), 12, '0') as "PO No.", cast(o_custkey as string) as Vendor, o_totalprice as Amount,
       case when o_custkey % 3 <> 0 then concat(o_orderpriority, case when o_custkey % 2 = 0 then chr(10) || 'says "yes", so' else '' end) end as Note
from orders"""


@query("snapshot_by_date", f"select * from ({ORDER_REPORT_SQL} where o_orderstatus = 'P') x")
def snapshot_by_date(spark, sf_dir):
    """Dated snapshots are written as folders; one date is read with pinned types, ids as text."""
    base = scratch_table_path(spark, "snapshots")
    report = _order_report(_t(spark, sf_dir))
    for status, date in (("O", "2024-01-01"), ("P", "2024-01-02")):
        report.where(F.col("status") == status).drop("status").write.parquet(snapshot.snapshot_path(base, "po", date))
    return snapshot.read_snapshot(spark, base, "po", "2024-01-02", ORDER_SCHEMA, with_order=False)


@query("snapshot_history", f"""select x.*, '2024-01-01' as snapshot_date from ({ORDER_REPORT_SQL} where o_orderstatus = 'O') x
union all select x.*, '2024-01-02' from ({ORDER_REPORT_SQL} where o_orderstatus = 'P') x""")
def snapshot_history(spark, sf_dir):
    """S2 over several dates, all of them partitions of one dataset."""
    base = scratch_table_path(spark, "snapshots")
    report = _order_report(_t(spark, sf_dir))
    date = F.when(F.col("status") == "O", "2024-01-01").when(F.col("status") == "P", "2024-01-02").otherwise("2023-12-31")
    report.withColumn("snapshot_date", date).drop("status").write.partitionBy("snapshot_date").parquet(snapshot.snapshot_path(base, "po"))
    read = snapshot.read_snapshots(spark, base, "po", ORDER_SCHEMA, dates=["2024-01-01", "2024-01-02"])
    return read.drop(snapshot.ORD)


@query("snapshot_delimited", f"select Vendor, \"PO No.\", Note, Amount from ({ORDER_REPORT_SQL}) x")
def snapshot_delimited(spark, sf_dir):
    """A report as delimited text with quoted line breaks, its columns in another order than the schema's."""
    path = scratch_table_path(spark, "report")
    report = _order_report(_t(spark, sf_dir)).select("Note", "status", "Amount", "`PO No.`", "Vendor")
    report.write.options(header=True, escape='"').csv(path)
    read = snapshot.read_delimited(spark, path, ORDER_SCHEMA, skip_lines=0)
    return read.select("Vendor", F.col("`PO No.`"), "Note", "Amount")


@query("snapshot_banner", f"select Vendor, \"PO No.\", Note, Amount from ({ORDER_REPORT_SQL}) x")
def snapshot_banner(spark, sf_dir):
    """S1 as the reports come: every file has two banner lines, one of them a quoted cell of two, above its header."""
    path = scratch_table_path(spark, "report")
    report = _order_report(_t(spark, sf_dir)).select("Note", "Amount", "`PO No.`", "Vendor")
    line = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in report.columns]), {"escape": '"'})
    first = F.monotonically_increasing_id() % (1 << 33) == 0  # of its partition, so of its file
    above = F.lit('Open orders\n"printed by\nthe report server",page 1\nNote,Amount,PO No.,Vendor')
    report.repartition(4, "`PO No.`").select(F.when(first, F.concat_ws("\n", above, line)).otherwise(line)).write.text(path)
    read = snapshot.read_delimited(spark, path, ORDER_SCHEMA, skip_lines=2)
    return read.select("Vendor", F.col("`PO No.`"), "Note", "Amount")


@query("duplicate_header", """select l_orderkey as Req_ID, l_orderkey % 2 as Unit, l_linenumber as REQ_Line,
       concat('P', cast(l_partkey as string)) as PO_No, l_suppkey % 100 as PO_Line from lineitem""")
def duplicate_header(spark, sf_dir):
    """The crosswalk repeats the header "Line"; the columns are told apart by place."""
    li = _t(spark, sf_dir).lineitem
    report = li.select(li.l_orderkey, li.l_orderkey % 2, li.l_linenumber, F.concat(F.lit("P"), li.l_partkey.cast("string")),
                       li.l_suppkey % 100).toDF("Req ID", "Unit", "Line", "PO No.", "Line")
    named = H.rename_positional(report, {2: "REQ_Line", 4: "PO_Line"})
    return H.clean_headers(named, [H.SPACE, H.SLASH, H.DROP_DOT])


@query("write_version_fan_out", """select 'dev' as target, o_orderkey as PO_No, o_orderstatus as Status from orders
union all select 'prod', o_orderkey, o_orderstatus from orders""")
def write_version_fan_out(spark, sf_dir):
    """K3 storage and K11: one table computed once, written as a new version to two targets and read back."""
    o = _t(spark, sf_dir).orders.select(F.col("o_orderkey").alias("PO_No"), F.col("o_orderstatus").alias("Status"))
    base = scratch_table_path(spark, "targets")
    dev, prod = (spark.read.parquet(p) for p in merge.fan_out(o, [f"{base}/dev", f"{base}/prod"], "PO_DATA"))
    return dev.select(F.lit("dev").alias("target"), "*").unionByName(prod.select(F.lit("prod").alias("target"), "*"))


@query("repeated_flag", """select PO_No, Appr_Inst, Event_Date_Time,
       row_number() over (partition by PO_No, Event_Date_Time order by Approval_Number, Appr_Inst) > 1 as Auto from fx_po_worklist""")
def repeated_flag(spark, sf_dir):
    """W2 without ordering a group: an earlier step of the PO has the same time."""
    wl = fx.fx_po_worklist(_t(spark, sf_dir)).select("PO_No", "Appr_Inst", "Event_Date_Time", "Approval_Number")
    flagged = keyed.repeated_flag(wl, ["PO_No", "Event_Date_Time"], ["Approval_Number", "Appr_Inst"], name="Auto")
    return flagged.select("PO_No", "Appr_Inst", "Event_Date_Time", "Auto")


@query("first_seen_flag", f"""select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
       row_number() over (partition by l_orderkey order by {LI_ORDER}) = 1 as first_seen from lineitem""")
def first_seen_flag(spark, sf_dir):
    """The row that writes the header of its key."""
    li = _t(spark, sf_dir).lineitem.select(*fx.LINEITEM_ORDER)
    return keyed.first_seen_flag(li, ["l_orderkey"], fx.LINEITEM_ORDER).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "first_seen")


@query("end_times", f"""select PO_No, ID, Start_DTTM, seq,
       case when Start_DTTM is not null then coalesce(lead(Start_DTTM) over (partition by PO_No order by Start_DTTM asc nulls last, seq), {AS_OF_SQL}) end as End_DTTM
from (select PO_No, seq, ID, Start_DTTM from ox_po_events union all select PO_No, seq + 2, ID, Start_DTTM from ox_wl_events) e""")
def end_times(spark, sf_dir):
    """W1/O2 in the general form: the events of every PO end where its next one starts."""
    t = _t(spark, sf_dir)
    cols = ["PO_No", "ID", "Start_DTTM", "seq"]
    steps = timeline.worklist_events(fx.fx_po_worklist(t), "Appr_Inst").withColumn("seq", F.col("seq") + 2)
    events = timeline.po_events(fx.fx_po(t)).select(*cols).unionByName(steps.select(*cols))
    return timeline.with_end_times(events, AS_OF, key="PO_No").select(*cols, "End_DTTM")


# ---------------------------------------------------------------- dataset jobs

def _job(run):
    return lambda spark, sf_dir: run(_t(spark, sf_dir))


for _name, (_run, _sql) in [*JOBS.items(), *INCREMENTS.items()]:
    query(_name, _sql)(_job(_run))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
