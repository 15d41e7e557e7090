"""Queries of several snapshots in a row: change sets, merges of touched files, and results kept up to date.

Like ``catalogue``, every query reads whole driver tables and splits them into stored rows and snapshots by data attributes.
Tables are kept in a ``TableStore`` of the shared folder: one commit for the first version, one for each snapshot.
"""
from __future__ import annotations

import datetime as dt
from collections import OrderedDict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reqtrail.operators import changes, counts, incremental, rewrite, timeline
from reqtrail.plans import fixtures as fx
from reqtrail.plans.oracle_views import LI_ORDER
from reqtrail.session import materialize, scratch_table_path
from reqtrail.sources import snapshot
from reqtrail.streaming.snapshots import TableStore

AS_OF = dt.datetime(2030, 1, 1)


# ---------------------------------------------------------------- S2: the change set of two dated snapshots

LINE_KEY, LINE_ORDER = ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_extendedprice"]
LINE_SCHEMA = T.StructType([T.StructField(n, T.LongType()) for n in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
                           + [T.StructField(n, T.DoubleType()) for n in ("l_extendedprice", "quantity")] + [T.StructField("due", T.TimestampNTZType())])


def snapshot_changes(t: fx.Tables) -> DataFrame:
    """Lines on two days: accepted ones are gone on the second, returned ones new; open ones have another quantity, third lines no date."""
    li, base = t.lineitem, scratch_table_path(t.spark, "line-reports")
    days = {"2024-01-01": (li.l_returnflag != "R", li.l_quantity, li.l_shipdate),
            "2024-01-02": (li.l_returnflag != "A", F.when(li.l_linestatus == "F", li.l_quantity).otherwise(li.l_quantity + 1),
                           F.when(li.l_linenumber != 3, li.l_shipdate))}
    for day, (there, quantity, due) in days.items():
        rows = li.where(there).select(*[F.col(c).cast("long").alias(c) for c in (*LINE_KEY, "l_partkey", "l_suppkey")],
                                      F.col("l_extendedprice").cast("double").alias("l_extendedprice"), quantity.cast("double").alias("quantity"),
                                      due.cast("timestamp_ntz").alias("due"))
        rows.write.parquet(snapshot.snapshot_path(base, "lines", day))
    old, new = (snapshot.read_snapshot(t.spark, base, "lines", day, LINE_SCHEMA, with_order=False) for day in days)
    found = changes.change_set(old, new, LINE_KEY, LINE_ORDER, fields=["quantity", "due"])
    return found.withColumn("changed_fields", F.array_join("changed_fields", ","))


CHANGES_SQL = """
with a as (select * from (select l_orderkey, l_linenumber, cast(l_quantity as double) as quantity, l_shipdate as due,
             row_number() over (partition by l_orderkey, l_linenumber order by l_partkey desc, l_suppkey desc, l_extendedprice desc) as k,
             count(*) over (partition by l_orderkey, l_linenumber) as n from lineitem where l_returnflag <> 'R') x where k = 1),
b as (select * from (select l_orderkey, l_linenumber, cast(case when l_linestatus = 'F' then l_quantity else l_quantity + 1 end as double) as quantity,
             case when l_linenumber <> 3 then l_shipdate end as due,
             row_number() over (partition by l_orderkey, l_linenumber order by l_partkey desc, l_suppkey desc, l_extendedprice desc) as k,
             count(*) over (partition by l_orderkey, l_linenumber) as n from lineitem where l_returnflag <> 'A') x where k = 1)
select cast(coalesce(a.l_orderkey, b.l_orderkey) as bigint) as l_orderkey, cast(coalesce(a.l_linenumber, b.l_linenumber) as bigint) as l_linenumber,
       case when a.k is null then 'inserted' when b.k is null then 'removed'
            when a.quantity is not distinct from b.quantity and a.due is not distinct from b.due then 'unchanged' else 'updated' end as change,
       case when a.k is null or b.k is null then '' else concat_ws(',', case when a.quantity is distinct from b.quantity then 'quantity' end,
                                                                    case when a.due is distinct from b.due then 'due' end) end as changed_fields,
       coalesce(a.n, 0) as n_old, coalesce(b.n, 0) as n_new
from a full outer join b on a.l_orderkey = b.l_orderkey and a.l_linenumber = b.l_linenumber"""


# ---------------------------------------------------------------- K1, K2, K7, K8 by touched files

def _kept_in_files(t: fx.Tables, first: DataFrame, keys: list[str], *steps) -> DataFrame:
    """A table after its first version and one commit for each step ``(files) -> Rewrite``."""
    store = TableStore(t.spark, scratch_table_path(t.spark, "store"))
    store.commit({"t": rewrite.Rewrite((), (), first, first.schema, tuple(keys))}, "first", 0)
    for n, step in enumerate(steps, 1):
        store.commit({"t": step(store.files("t"))}, f"step {n}", n)
    return store.current("t")


HEADER_SET = ["Status", "Amount", "Clerk"]
HEADERS_SQL = """
with t as (select o_orderkey as PO_No, o_orderstatus as Status, o_orderdate as PO_Date, o_totalprice as Amount from orders where o_orderstatus <> 'O'),
one as (select o_orderkey as PO_No, lower(o_orderstatus) as Status, o_totalprice * 2 as Amount, 'first' as Clerk from orders where o_orderstatus = 'O'),
two as (select o_orderkey as PO_No, concat(o_orderstatus, '2') as Status, case when o_orderpriority = '5-LOW' then null else o_totalprice * 3 end as Amount,
               'second' as Clerk from orders where o_orderpriority <> '1-URGENT' and o_orderstatus <> 'F'),
s as (select * from two union all select * from one where PO_No not in (select PO_No from two))
select coalesce(t.PO_No, s.PO_No) as PO_No, case when s.PO_No is not null then s.Status else t.Status end as Status, t.PO_Date,
       case when s.PO_No is not null then s.Amount else t.Amount end as Amount, s.Clerk
from t {join} join s on t.PO_No = s.PO_No"""


def _headers(t: fx.Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored headers and two snapshots of them with new amounts, the second one partly of the same orders."""
    o = t.orders
    row = lambda there, status, amount, clerk: o.where(there).select(
        o.o_orderkey.alias("PO_No"), status.alias("Status"), amount.alias("Amount"), F.lit(clerk).alias("Clerk"))
    stored = o.where(o.o_orderstatus != "O").select(o.o_orderkey.alias("PO_No"), o.o_orderstatus.alias("Status"), o.o_orderdate.alias("PO_Date"), o.o_totalprice.alias("Amount"))
    one = row(o.o_orderstatus == "O", F.lower("o_orderstatus"), o.o_totalprice * 2, "first")
    two = row((o.o_orderpriority != "1-URGENT") & (o.o_orderstatus != "F"), F.concat("o_orderstatus", F.lit("2")),
              F.when(o.o_orderpriority != "5-LOW", o.o_totalprice * 3), "second")
    return stored, one, two


def upsert_touched_files(t: fx.Tables) -> DataFrame:
    stored, one, two = _headers(t)
    return _kept_in_files(t, stored, ["PO_No"], lambda f: rewrite.upsert(t.spark, f, one, ["PO_No"], HEADER_SET),
                          lambda f: rewrite.upsert(t.spark, f, two, ["PO_No"], HEADER_SET))


def update_only_touched_files(t: fx.Tables) -> DataFrame:
    stored, one, two = _headers(t)
    return _kept_in_files(t, stored, ["PO_No"], lambda f: rewrite.update_only(t.spark, f, one, ["PO_No"], HEADER_SET),
                          lambda f: rewrite.update_only(t.spark, f, two, ["PO_No"], HEADER_SET))


CHILD_COLS = ["l_linenumber", "l_partkey", "l_quantity", "l_shipdate"]


def replace_children_touched_files(t: fx.Tables) -> DataFrame:
    """Lines of orders replaced twice: by the open ones with other quantities, then by the large ones."""
    li = t.lineitem
    rows = lambda there, add, src: li.where(there).select(
        "l_orderkey", "l_linenumber", "l_partkey", (li.l_quantity + add).alias("l_quantity"), "l_shipdate", F.lit(src).alias("src"))
    old, one, two = rows(li.l_returnflag != "R", 0, "old"), rows(li.l_linestatus == "O", 100, "one"), rows(li.l_quantity > 45, 200, "two")
    step = lambda new: lambda f: rewrite.replace_children(t.spark, f, new, ["l_orderkey"])
    return _kept_in_files(t, old, ["l_orderkey"], step(one), step(two))


REPLACED_SQL = """
with o as (select l_orderkey, l_linenumber, l_partkey, l_quantity + 0 as l_quantity, l_shipdate, 'old' as src from lineitem where l_returnflag <> 'R'),
one as (select l_orderkey, l_linenumber, l_partkey, l_quantity + 100 as l_quantity, l_shipdate, 'one' as src from lineitem where l_linestatus = 'O'),
two as (select l_orderkey, l_linenumber, l_partkey, l_quantity + 200 as l_quantity, l_shipdate, 'two' as src from lineitem where l_quantity > 45),
m as (select * from o where l_orderkey not in (select l_orderkey from one) union all select * from one)
select * from m where l_orderkey not in (select l_orderkey from two) union all select * from two"""


def reset_touched_files(t: fx.Tables) -> DataFrame:
    """Backorders set by the returned lines, then reset and set by large accepted ones."""
    items = t.part.select(F.col("p_partkey").cast("string").alias("Item_No"), F.col("p_name").alias("Item_Description"),
                          F.lit(0.0).alias("Total_Backorder"))
    li = t.lineitem
    report = lambda there: li.where(there).select(F.col("l_partkey").cast("string").alias("Item_No"), F.col("l_quantity").alias("Total_Backorder"), *fx.LINEITEM_ORDER)
    step = lambda new: lambda f: rewrite.reset_and_set(t.spark, f, new, ["Item_No"], "Total_Backorder", fx.LINEITEM_ORDER, default=0.0)
    return _kept_in_files(t, items, ["Item_No"], step(report(li.l_returnflag == "R")), step(report((li.l_returnflag == "A") & (li.l_quantity > 40))))


RESET_SQL = f"""
with s as (select cast(l_partkey as string) as Item_No, l_quantity as Qty from (
             select *, row_number() over (partition by l_partkey order by {', '.join(c + ' desc' for c in LI_ORDER.split(', '))}) as rn
             from lineitem where l_returnflag = 'A' and l_quantity > 40) x where rn = 1)
select cast(p.p_partkey as string) as Item_No, p.p_name as Item_Description, case when s.Item_No is not null then s.Qty else 0.0 end as Total_Backorder
from part p left join s on s.Item_No = cast(p.p_partkey as string)"""


# ---------------------------------------------------------------- A6, A7 under replacement

def po_req_counts_incremental(t: fx.Tables) -> DataFrame:
    """Requisitions per PO, kept up to date from a counted multiset while lines are replaced and removed."""
    keys, member = ["PO_No"], "Req_ID"
    lines = materialize(fx.fx_po_line(t).select("PO_No", "Req_ID", "Status", "Quantity", "Req_Line"), "po-lines")  # read by six reports
    state = materialize(counts.pair_counts(lines.where(F.col("Status") != "C"), keys, member), "pair-counts")
    result = materialize(counts.distinct_counts(state, keys, member), "distinct-counts")
    replaced = lines.where(F.col("Status") != "A")
    renamed = lines.where(F.col("Quantity") > 25).withColumn("Req_ID", F.when(F.col("Req_Line") < 4, F.col("Req_ID")))
    removed = lines.where(F.col("Quantity") == 50).select("PO_No")
    for deltas_of in (lambda s: counts.replacement_deltas(s, replaced, keys, member, many=True), lambda s: counts.replacement_deltas(s, renamed, keys, member, many=True),
                      lambda s: counts.removal_deltas(s, removed, keys, member, many=True)):
        deltas = materialize(deltas_of(state), "pair-deltas")
        state = materialize(counts.apply_deltas(state, deltas, keys, member), "pair-counts")
        result = materialize(counts.updated_counts(result, state, deltas, keys, member, many=True), "distinct-counts")
    return result


COUNTS_SQL = """
with l as (select PO_No, Req_ID, Status, Quantity, Req_Line from fx_po_line),
a as (select PO_No, Req_ID from l where Status <> 'C'), s1 as (select PO_No, Req_ID from l where Status <> 'A'),
s2 as (select PO_No, case when Req_Line < 4 then Req_ID end as Req_ID from l where Quantity > 25),
b as (select * from a where PO_No not in (select PO_No from s1) union all select * from s1),
c as (select * from b where PO_No not in (select PO_No from s2) union all select * from s2),
d as (select * from c where PO_No not in (select PO_No from l where Quantity = 50))
select PO_No, cast(count(distinct Req_ID) + count(*) filter (where Req_ID is null) as bigint) as n_req_each,
       cast(count(distinct Req_ID) + max(case when Req_ID is null then 1 else 0 end) as bigint) as n_req_one,
       cast(count(distinct Req_ID) as bigint) as n_req_ignore
from d group by PO_No"""


# ---------------------------------------------------------------- L16 after loads

def timeline_loads(t: fx.Tables) -> list[dict[str, DataFrame]]:
    """The timeline's tables before and after three loads (REQ report, PO report, approvals), which end at the fixture tables.

    Before them, pending requisitions are unknown and urgent ones signed by another, links of small lines are missing, stock
    orders have another status, large lines have not come, and denials are not in the worklist.
    """
    req, po_line = fx.fx_req(t), fx.fx_po_line(t)
    # Every load reads these as its old and its new tables, to compare and to build from: they are made once.
    link, po, steps = (materialize(df, name) for df, name in ((fx.fx_link(t), "req-lines"), (fx.fx_po(t), "po"), (fx.fx_po_worklist(t), "po-worklist")))
    small = materialize(fx.fx_po_line(t).where("Quantity > 5").select("REQ_No", F.when(fx.is_requested(F.col("Quantity")), F.col("PO_No")).alias("PO_Number")).distinct(), "small-req-lines")
    signed = F.when(F.col("Approved_By") == "1-URGENT", F.lit("Deputy")).otherwise(F.col("Approved_By"))
    first = {"req": req.where("Status <> 'P'").withColumn("Approved_By", signed), "req_line": small,
             "po": po.withColumn("Status", F.when(F.col("PO_No").startswith("S"), F.lit("X")).otherwise(F.col("Status"))),
             "po_line": po_line.where("Quantity <= 45"), "po_worklist": steps.where("Appr_Stat <> 'D'")}
    one = first | {"req": req, "req_line": link}
    two = one | {"po": po, "po_line": po_line}
    return [first, one, two, two | {"po_worklist": steps}]


def build(tables: dict[str, DataFrame], as_of: dt.datetime | Column = AS_OF) -> incremental.Timelines:
    made = timeline.requisition_timeline(tables["req"], tables["req_line"], tables["po"], tables["po_line"], tables["po_worklist"],
                                         as_of=as_of, worklist_order="Appr_Inst")
    return incremental.Timelines(*(materialize(df, "timelines") for df in made))


def _after_loads(t: fx.Tables) -> incremental.Timelines:
    loads = timeline_loads(t)
    now = build(loads[0])
    for old, new in zip(loads, loads[1:]):
        now, _ = incremental.update_timeline(now, old, new, as_of=AS_OF, worklist_order="Appr_Inst", many=True)
    return now


def timeline_incremental(t: fx.Tables) -> DataFrame:
    return _after_loads(t).events


def classes_incremental(t: fx.Tables) -> DataFrame:
    return _after_loads(t).classified


EVENTS_SQL = "select REQ_No, PO_No, seq, ID, Start_DTTM, End_DTTM, EventType, Text, Person, Internal, Neutral, Auto, Lifecycle from ox_timeline"

INCREMENTS = OrderedDict([
    ("snapshot_changes", (snapshot_changes, CHANGES_SQL)),
    ("upsert_touched_files", (upsert_touched_files, HEADERS_SQL.format(join="full outer"))),
    ("update_only_touched_files", (update_only_touched_files, HEADERS_SQL.format(join="left"))),
    ("replace_children_touched_files", (replace_children_touched_files, REPLACED_SQL)),
    ("reset_touched_files", (reset_touched_files, RESET_SQL)),
    ("po_req_counts_incremental", (po_req_counts_incremental, COUNTS_SQL)),
    ("timeline_incremental", (timeline_incremental, EVENTS_SQL)),
])
