"""Procurement-shaped views over the driver's TPC-H-like test tables.

The driver gives orders/lineitem/events, not procurement reports. These adapters
map them onto the canonical procurement schemas (FIXTURES.md §3.2) so every
operator runs on whole tables. Each view is lazy; Catalyst prunes what a query
does not use and pushes filters into the Parquet scans.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reqtrail.operators.keyed import first_per_key

LINEITEM_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
                  "l_shipdate"]
PO_LINE_ORDER = ["PO_Date", "REQ_No", "Req_Line", "Vendor", "Line_Total", "Quantity"]


class Tables:
    """Lazy access to the driver tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def fx_req(t: Tables) -> DataFrame:
    o = t.orders
    return o.select(o.o_orderkey.alias("REQ_No"), (o.o_orderkey % 2).alias("Business_Unit"),
                    F.concat(F.lit("Buyer"), _s(o.o_custkey % 50)).alias("Buyer"),
                    o.o_orderdate.alias("REQ_Date"), o.o_orderpriority.alias("Approved_By"),
                    (o.o_orderdate + F.expr("interval 2 days")).alias("Approved_On"),
                    o.o_orderstatus.alias("Status"))


def fx_req_line(t: Tables) -> DataFrame:
    li = t.lineitem
    return li.select(li.l_orderkey.alias("REQ_No"), (li.l_orderkey % 2).alias("Business_Unit"),
                     li.l_linenumber.alias("Line_No"), li.l_extendedprice.alias("Line_Total"),
                     li.l_quantity.alias("Quantity"), li.l_shipdate.alias("Due_Date"),
                     _s(li.l_partkey).alias("Item"), li.l_suppkey.alias("Supp"))


def po_number(partkey: Column, shipdate: Column) -> Column:
    return F.concat(_s(partkey), F.lit("-"), _s(F.year(shipdate) * 100 + F.month(shipdate)))


def is_requested(quantity: Column) -> Column:
    """Small quantities are bought for a requisition; larger ones are stock orders, which name none."""
    return quantity <= 10


def fx_po_line(t: Tables) -> DataFrame:
    """Every line: of a purchase order made for a requisition, or of a stock order with a number of its own kind."""
    li = t.lineitem
    number, own = po_number(li.l_partkey, li.l_shipdate), is_requested(li.l_quantity)
    return li.select(
        F.when(own, number).otherwise(F.concat(F.lit("S"), number)).alias("PO_No"), li.l_orderkey.alias("REQ_No"),
        F.when(own & (li.l_linenumber != 7), li.l_orderkey).alias("Req_ID"), li.l_linenumber.alias("Req_Line"),
        (li.l_suppkey % 2).alias("Business_Unit"), li.l_suppkey.alias("Vendor"), li.l_shipdate.alias("PO_Date"),
        F.when(li.l_returnflag == "A", "A").when(li.l_returnflag == "N", "D").otherwise("C").alias("Status"),
        F.when(li.l_linestatus == "F", li.l_shipdate + F.expr("interval 1 day")).alias("PO_Approval_Date"),
        li.l_extendedprice.alias("Line_Total"), li.l_quantity.alias("Quantity"))


def fx_po(t: Tables) -> DataFrame:
    """PO headers: the first PO line of each PO number (A3)."""
    first = first_per_key(fx_po_line(t), ["PO_No"], PO_LINE_ORDER,
                          cols=["Business_Unit", "Vendor", "PO_Date", "Status", "PO_Approval_Date"])
    return first.select("PO_No", "Business_Unit",
                        F.concat(F.lit("Supp"), _s(F.col("Vendor"))).alias("Buyer"),
                        F.concat(F.lit("Chief"), _s(F.col("Vendor") % 7)).alias("Approved_By"),
                        "PO_Date", "Status", "PO_Approval_Date")


def fx_link(t: Tables) -> DataFrame:
    """REQ -> PO links (distinct), in the flat line-table shape the timeline reads; lines from stock have no link."""
    linked = F.when(is_requested(F.col("Quantity")), F.col("PO_No"))
    return fx_po_line(t).select("REQ_No", linked.alias("PO_Number")).distinct()


def _worklist_name(event_type: Column) -> Column:
    return (F.when(event_type == "purchase", "Central Procurement")
             .when(event_type == "error", "PROCUREMENT audit")
             .otherwise(F.concat(F.lit("Team "), event_type)))


def _worklist_code(event_type: Column) -> Column:
    return (F.when(event_type == "view", "I").when(event_type == "purchase", "A")
             .when(event_type == "error", "D").otherwise(event_type))


def hour_trunc(ts: Column) -> Column:
    """Truncate a zone-less timestamp to the hour, independent of the session zone."""
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.lit(0), F.lit(0))


def fx_po_worklist(t: Tables) -> DataFrame:
    e = t.events
    k = fx_link(t).where(F.col("PO_Number").isNotNull())
    j = e.join(k, k.REQ_No == F.floor(e.event_id / 3).cast("bigint"))
    return j.select(F.col("PO_Number").alias("PO_No"), e.event_id.alias("Appr_Inst"),
                    _worklist_name(e.event_type).alias("Work_List"), _s(e.event_id % 3).alias("Approval_Number"),
                    _worklist_code(e.event_type).alias("Appr_Stat"), hour_trunc(e.ts).alias("Event_Date_Time"),
                    _s(e.user_id).alias("User"))


def fx_req_worklist(t: Tables) -> DataFrame:
    """REQ approval steps: events joined to requisitions the same way."""
    e = t.events
    q = fx_req(t).select("REQ_No", "Business_Unit")
    j = e.join(q, q.REQ_No == F.floor(e.event_id / 3).cast("bigint"))
    return j.select("REQ_No", e.event_id.alias("Appr_Inst"), F.col("Business_Unit").alias("Unit"),
                    _worklist_name(e.event_type).alias("Work_List"), _s(e.event_id % 3).alias("Approval_Number"),
                    _worklist_code(e.event_type).alias("Appr_Stat"), e.ts.alias("Date_Time"),
                    _s(e.user_id).alias("User"))


def fx_xwalk(t: Tables) -> DataFrame:
    """REQ-line -> PO-line crosswalk rows (repeats per key are real: last row wins).

    Rows of stock orders carry a unit that no requisition has, so only the test of all three keys leaves them out.
    """
    li = t.lineitem
    unit = F.when(is_requested(li.l_quantity), li.l_orderkey % 2).otherwise(F.lit(9))
    return li.select(li.l_orderkey.alias("Req_ID"), unit.cast("long").alias("Unit"),
                     li.l_linenumber.alias("REQ_Line"), po_number(li.l_partkey, li.l_shipdate).alias("PO_No"),
                     (li.l_suppkey % 100).cast("string").alias("PO_Line"), *LINEITEM_ORDER)
