"""L1-L15 as queries: every dataset job of ``jobs.py`` over whole driver tables.

Each job gets a report as printed (headers with blanks, slashes and dots, ids with blanks around
them, empty cells, NULL keys). The stored tables are what the same job made of an earlier report;
the result is what it makes of the next one, whose keys overlap. Reports are two
snapshots split by a data attribute; no row of the tables is left out of both. The oracle
says the same in plain SQL: first or last row per key, outer joins, anti joins.
"""
from __future__ import annotations

from collections import OrderedDict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reqtrail import schemas as S
from reqtrail.functions.headers import DASH, DROP_DOT, DROP_QUESTION, SLASH
from reqtrail.operators.keyed import order_key
from reqtrail.plans import fixtures as fx
from reqtrail.plans import jobs
from reqtrail.plans.oracle_views import LI_ORDER
from reqtrail.sources.snapshot import ORD

LINES = "lineitem"
EVENTS = "events"
ORDER = {LINES: LI_ORDER, EVENTS: "event_id"}
#: The earlier and the next report of each table; lines N and events of other types are in both.
HALVES = {LINES: ("l_returnflag <> 'R'", "l_returnflag <> 'A'"), EVENTS: ("event_type <> 'purchase'", "event_type <> 'click'")}

# Typed cells; every other cell is text made of its column's place and the row.
NUMBERS = {"Line", "PO_Line", "Sched_Num", "Appr_Inst", "REQ_Line"}
AMOUNTS = {"Base_Price", "Amount", "Req_Qty", "PO_Qty", "Sum_Amount", "Max_Amt", "Qty", "Received_Qty", "Req_Total", "SUM_MERCHANDISE_AMT",
           "Qty_On_Hand", "Qty_Avail", "Reorder_Pt", "Max_Qty", "Ave_Cost"}
DATES = {"Req_Date", "Date", "Due", "PO_Date", "PO_AprvDate", "Last_Dttm", "Event_Date_Time", "Dispatch_DTTM", "Date_Time", "Denial_Date_Time",
         "PO_Hdr_Created_Date", "Expire_Dt", "Itm_Status_Dt", "Transmitted_Time", "Req_Created_Date", "Req_Approval_Date"}


def cell(column: str, place: int, table: str, tag: str) -> str:
    """SQL of one report cell, the same in both engines; some cells are empty."""
    key, other, amount, day = {LINES: ("l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"), EVENTS: ("event_id", "user_id", "value", "ts")}[table]
    if column in NUMBERS:
        return f"({key} + {place}) % 9"
    value = amount if column in AMOUNTS else day if column in DATES else \
        f"concat('{column[:3]}', cast(({key} + {place}) % {place + 3} as string), '{tag}', cast({other} % 4 as string))"
    return f"case when ({key} + {place}) % {place + 5} = 0 then null else {value} end"


def printed(column: str, place: int, dataset: str) -> str:
    """A header as the report prints it: what the dataset's cleanup rules turn into ``column``."""
    rules, out = S.RULES[dataset], column.replace("_", " ")
    if SLASH in rules and place % 3 == 1:
        out = column.replace("_", "/")
    if DASH in rules and place % 3 == 1:
        out = column.replace("_", "-")
    return out + ("." if DROP_DOT in rules and place % 2 else "") + ("?" if DROP_QUESTION in rules and place % 2 else "")


class Job:
    """One dataset's report: its columns, its key cell as printed, and the key's value."""

    def __init__(self, dataset: str, table: str, key: str, key_cell: str, key_value: str, *mappings, fixed: dict[str, str] | None = None):
        self.dataset, self.table, self.key, self.key_cell, self.key_value = dataset, table, key, key_cell, key_value
        columns = list(dict.fromkeys(c for m in mappings for c in m if c != key))
        self.cells = lambda tag: {c: (fixed or {}).get(c) or cell(c, i, table, tag) for i, c in enumerate(columns)}

    def report(self, t: fx.Tables, new: bool) -> DataFrame:
        cells = {self.key: self.key_cell} | self.cells("n" if new else "o")
        rows = getattr(t, self.table).where(HALVES[self.table][new])
        return rows.select(*[F.expr(sql).alias(printed(c, i, self.dataset)) for i, (c, sql) in enumerate(cells.items())],
                           order_key([c.strip() for c in ORDER[self.table].split(",")]).alias(ORD))

    def rows(self, new: bool, key: str, mapping: dict[str, str], defaults: dict[str, str] | None = None) -> str:
        """SQL of the report's rows under their target names, with their place per key from the front and the back."""
        cells = self.cells("n" if new else "o")
        named = ", ".join(f"{'coalesce(' + cells[c] + ', ' + (defaults or {})[c] + ')' if c in (defaults or {}) else cells[c]} as {flat(d)}"
                          for c, d in mapping.items() if c != self.key)
        order = ORDER[self.table]
        back = ", ".join(c.strip() + " desc" for c in order.split(","))
        return (f"select {self.key_value} as {key}{', ' + named if named else ''}, "
                f"row_number() over (partition by {self.key_value} order by {order}) as _f, "
                f"row_number() over (partition by {self.key_value} order by {back}) as _l from {self.table} where {HALVES[self.table][new]}")


def flat(target: str) -> str:
    name = target.replace(".", "_")
    return f'"{name}"' if name.lower() in ("user", "date", "line") else name


def flattened(df: DataFrame, key: str, mapping: dict[str, str]) -> DataFrame:
    return df.select(key, *[F.col(d).alias(d.replace(".", "_")) for d in dict.fromkeys(mapping.values()) if d != key])


def header_sql(job: Job, key: str, mapping: dict[str, str], defaults=None) -> str:
    """First row per key of each report; the next one's fields win."""
    names = [flat(d) for c, d in mapping.items() if c != job.key]
    values = "".join(f", case when n.{key} is not null then n.{x} else o.{x} end as {x}" for x in names)
    return (f"with o as (select * from ({job.rows(False, key, mapping, defaults)}) x where _f = 1 and {key} is not null),\n"
            f"n as (select * from ({job.rows(True, key, mapping, defaults)}) x where _f = 1 and {key} is not null)\n"
            f"select coalesce(n.{key}, o.{key}) as {key}{values} from o full outer join n on n.{key} = o.{key}")


def children_sql(job: Job, key: str, mapping: dict[str, str], distinct: bool = False, parent: str | None = None, defaults=None) -> str:
    """Rows of keys in the next report replace the stored ones; ``parent``: SQL of the keys that may have rows."""
    names = ", ".join([key, *[flat(d) for c, d in mapping.items() if c != job.key]])
    known = f" and {key} in ({parent})" if parent else ""
    d = "distinct " if distinct else ""
    return (f"with o as (select {d}{names} from ({job.rows(False, key, mapping, defaults)}) x where {key} is not null{known}),\n"
            f"n as (select {d}{names} from ({job.rows(True, key, mapping, defaults)}) x where {key} is not null{known})\n"
            f"select * from o where {key} not in (select {key} from n) union all select * from n")


ORDER_KEY = "case when l_partkey % 13 = 0 then null else l_orderkey end"
PO_KEY = "case when l_partkey % 13 = 0 then null else concat('P', cast(l_suppkey as string), '-', cast(l_orderkey % 40 as string)) end"
ITEM_VALUE = "cast(l_partkey as string)"
ITEM_CELL = "concat('  ', cast(l_partkey as string), ' ')"
EVENT_KEY = "case when event_id % 17 = 0 then null else user_id end"
DUE = {"Due": "TIMESTAMP '2001-01-01 00:00:00'", "Address_2": "''"}

REQ = Job("req", LINES, "Req_ID", ORDER_KEY, ORDER_KEY, S.REQ_HEADER, S.REQ_LINE)
PO = Job("po", LINES, "PO_No", PO_KEY, PO_KEY, S.PO_HEADER, S.PO_LINE)
PO_APPROVAL = Job("po_approval", LINES, "PO_No", PO_KEY, PO_KEY, S.PO_APPROVAL)
REQ_APPROVAL = Job("req_approval", LINES, "Req_ID", ORDER_KEY, ORDER_KEY, S.REQ_APPROVAL)
LEGACY = Job("po_approval_legacy", LINES, "PO_No", PO_KEY, PO_KEY, S.PO_APPROVAL_LEGACY)
CONTRACT = Job("contract", LINES, "Contract", "concat('C', cast(l_suppkey as string))", "concat('C', cast(l_suppkey as string))", S.CONTRACT_HEADER, S.CONTRACT_LINE)
ALIAS = Job("item_alias", LINES, "Item", ITEM_CELL, ITEM_VALUE, S.ITEM_ALIAS_HEADER, S.ITEM_SUBS)
ITEM_PO = Job("item_po", LINES, "Item", ITEM_CELL, ITEM_VALUE, S.ITEM_PREV_PO)
LOCATION = Job("item_location", LINES, "Item", ITEM_CELL, ITEM_VALUE, S.ITEM_LOCATIONS)
WAREHOUSE = Job("item_warehouse", LINES, "Item", ITEM_CELL, ITEM_VALUE, S.ITEM_WAREHOUSE)
BACKORDER = Job("item_backorder", LINES, "Item", ITEM_CELL, ITEM_VALUE, {"Qty_Req": "Total_Backorder"}, fixed={"Qty_Req": "l_quantity"})
DASHBOARD = Job("dashboard", EVENTS, "Requisition_ID", EVENT_KEY, EVENT_KEY, S.DASHBOARD)
EARLY = Job("early_warning", EVENTS, "Req_ID", EVENT_KEY, EVENT_KEY, S.EARLY_WARNING)
MISSING = Job("missing_po", LINES, "PO_No", PO_KEY, PO_KEY, {"Vendor": "Vendor"})

#: Parents of the update-only jobs: the requisitions, POs and items that exist.
PO_PARENT = "select PO_No from (select concat('P', cast(s_suppkey as string), '-', cast(n as string)) as PO_No from supplier, (select distinct l_orderkey % 40 as n from lineitem where l_orderkey % 40 < 30) k) p"
REQ_PARENT = "select o_orderkey from orders where o_orderstatus <> 'P'"
ITEM_PARENT = "select cast(p_partkey as string) from part where p_size <= 40"


def _items(t: fx.Tables) -> DataFrame:
    return t.part.where("p_size <= 40").select(F.col("p_partkey").cast("string").alias("Item_No"), F.col("p_name").alias("Item_Description"))


def _twice(job: Job, t: fx.Tables, load, n: int, *first):
    """Apply a loader to the earlier report and then to the next one."""
    stored = load(job.report(t, False), *(first or [None] * n))
    return load(job.report(t, True), *(stored if isinstance(stored, tuple) else (stored,)))


def _approvals(job: Job, t: fx.Tables, load, parent: DataFrame) -> DataFrame:
    return load(job.report(t, True), parent, load(job.report(t, False), parent, None))


def _po_parent(t: fx.Tables) -> DataFrame:
    # the PO header table that the PO job made of both reports; numbers with an ending below 30 exist
    lines = t.lineitem.select(F.concat(F.lit("P"), F.col("l_suppkey").cast("string"), F.lit("-"), (F.col("l_orderkey") % 40).cast("string")).alias("PO_No"),
                              (F.col("l_orderkey") % 40).alias("n"))
    return lines.where("n < 30").select("PO_No").distinct()


def _link_po(t: fx.Tables) -> DataFrame:
    report = fx.fx_xwalk(t)
    report = report.select(F.col("Req_ID"), F.col("Unit"), F.col("REQ_Line").alias("Line"), "PO_No", F.col("PO_Line").alias("Line2"), order_key(fx.LINEITEM_ORDER).alias(ORD))
    req = fx.fx_req(t).select("REQ_No", "Business_Unit")
    lines = fx.fx_req_line(t).select("REQ_No", "Line_No", "Item", "Quantity")
    return jobs.link_po_into_req_lines(report, req, lines).select("REQ_No", "Line_No", "Item", "Quantity", F.col("PO.PO_Number").alias("PO_Number"), F.col("PO.Line_No").alias("PO_Line_No"))


LINK_SQL = f"""
with x as (select Req_ID, Unit, REQ_Line, PO_No, PO_Line from (
             select *, row_number() over (partition by Req_ID, Unit, REQ_Line order by {', '.join(c.strip() + ' desc' for c in LI_ORDER.split(','))}) as rn
             from fx_xwalk) t where rn = 1)
select l.REQ_No, l.Line_No, l.Item, l.Quantity, x.PO_No as PO_Number, x.PO_Line as PO_Line_No
from fx_req_line l left join fx_req q on q.REQ_No = l.REQ_No
left join x on x.Req_ID = l.REQ_No and x.Unit = q.Business_Unit and x.REQ_Line = l.Line_No"""


def _stub_sql(job: Job, key: str, stored: str | None = None) -> str:
    keys = " union ".join(f"select {job.key_value} as {key} from {job.table} where {half}" for half in HALVES[job.table])
    return f"select {key} from ({keys}{' union ' + stored if stored else ''}) k where {key} is not null"


def _dashboard_sql() -> str:
    names = ", ".join(flat(d) for c, d in S.DASHBOARD.items() if c != "Requisition_ID")
    return f"select REQ_No, REQ_No as Req_ID, {names} from ({DASHBOARD.rows(True, 'REQ_No', S.DASHBOARD)}) x where _l = 1 and REQ_No is not null"


def _early_sql() -> str:
    names = ", ".join(flat(d) for d in S.EARLY_WARNING.values())
    return f"select {names} from ({EARLY.rows(True, 'Req_ID', S.EARLY_WARNING)}) x"


def _backorder_sql() -> str:
    return f"""select cast(p_partkey as string) as Item_No, p_name as Item_Description, coalesce(s.Total_Backorder, case when s.Item_No is null then 0.0 end) as Total_Backorder
from part left join (select * from ({BACKORDER.rows(True, 'Item_No', {'Qty_Req': 'Total_Backorder'})}) x where _l = 1) s on s.Item_No = cast(p_partkey as string)
where p_size <= 40"""


#: name -> (Spark query over the tables, oracle SQL)
JOBS = OrderedDict([
    ("job_req", (lambda t: flattened(_twice(REQ, t, jobs.load_req, 2)[0], "REQ_No", S.REQ_HEADER), header_sql(REQ, "REQ_No", S.REQ_HEADER, DUE))),
    ("job_req_lines", (lambda t: flattened(_twice(REQ, t, jobs.load_req, 2)[1], "REQ_No", S.REQ_LINE), children_sql(REQ, "REQ_No", S.REQ_LINE, distinct=True, defaults=DUE))),
    ("job_po", (lambda t: flattened(_twice(PO, t, jobs.load_po, 2)[0], "PO_No", S.PO_HEADER), header_sql(PO, "PO_No", S.PO_HEADER))),
    ("job_po_lines", (lambda t: flattened(_twice(PO, t, jobs.load_po, 2)[1], "PO_No", S.PO_LINE), children_sql(PO, "PO_No", S.PO_LINE))),
    ("job_req_po_link", (_link_po, LINK_SQL)),
    ("job_po_approvals", (lambda t: flattened(_approvals(PO_APPROVAL, t, jobs.load_po_approvals, _po_parent(t)), "PO_No", S.PO_APPROVAL),
                          children_sql(PO_APPROVAL, "PO_No", S.PO_APPROVAL, parent=PO_PARENT, defaults=dict.fromkeys(S.PO_APPROVAL_TEXT_DEFAULTS, "''")))),
    ("job_req_approvals", (lambda t: flattened(_approvals(REQ_APPROVAL, t, jobs.load_req_approvals, t.orders.where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("REQ_No"))),
                                               "REQ_No", S.REQ_APPROVAL),
                           children_sql(REQ_APPROVAL, "REQ_No", S.REQ_APPROVAL, parent=REQ_PARENT, defaults=dict.fromkeys(S.REQ_APPROVAL_TEXT_DEFAULTS, "''")))),
    ("job_po_approvals_legacy", (lambda t: flattened(_twice(LEGACY, t, jobs.load_po_approvals_legacy, 2)[1], "PO_No", S.PO_APPROVAL_LEGACY),
                                 children_sql(LEGACY, "PO_No", S.PO_APPROVAL_LEGACY))),
    ("job_po_stubs", (lambda t: _twice(LEGACY, t, jobs.load_po_approvals_legacy, 2)[0].select("PO_No"), _stub_sql(LEGACY, "PO_No"))),
    ("job_contracts", (lambda t: flattened(_twice(CONTRACT, t, jobs.load_contracts, 2)[0], "Contract_ID", S.CONTRACT_HEADER), header_sql(CONTRACT, "Contract_ID", S.CONTRACT_HEADER))),
    ("job_contract_lines", (lambda t: flattened(_twice(CONTRACT, t, jobs.load_contracts, 2)[1], "Contract_ID", S.CONTRACT_LINE),
                            children_sql(CONTRACT, "Contract_ID", S.CONTRACT_LINE, distinct=True))),
    ("job_items", (lambda t: flattened(_twice(ALIAS, t, jobs.load_item_aliases, 2)[0], "Item_No", S.ITEM_ALIAS_HEADER), header_sql(ALIAS, "Item_No", S.ITEM_ALIAS_HEADER))),
    ("job_item_subs", (lambda t: flattened(_twice(ALIAS, t, jobs.load_item_aliases, 2)[1], "Item_No", S.ITEM_SUBS), children_sql(ALIAS, "Item_No", S.ITEM_SUBS))),
    ("job_item_prev_po", (lambda t: flattened(_twice(ITEM_PO, t, jobs.load_item_po_history, 2)[1], "Item_No", S.ITEM_PREV_PO), children_sql(ITEM_PO, "Item_No", S.ITEM_PREV_PO))),
    ("job_item_stubs", (lambda t: jobs.load_item_po_history(ITEM_PO.report(t, True), jobs.load_item_po_history(ITEM_PO.report(t, False), _items(t).select("Item_No"), None)[0], None)[0],
                        _stub_sql(ITEM_PO, "Item_No", "select cast(p_partkey as string) as Item_No from part where p_size <= 40"))),
    ("job_item_locations", (lambda t: flattened(_twice(LOCATION, t, jobs.load_item_locations, 2)[1], "Item_No", S.ITEM_LOCATIONS), children_sql(LOCATION, "Item_No", S.ITEM_LOCATIONS))),
    ("job_item_warehouse", (lambda t: flattened(_approvals(WAREHOUSE, t, jobs.load_item_warehouse, _items(t)), "Item_No", S.ITEM_WAREHOUSE),
                            children_sql(WAREHOUSE, "Item_No", S.ITEM_WAREHOUSE, parent=ITEM_PARENT))),
    ("job_item_backorders", (lambda t: jobs.load_item_backorders(BACKORDER.report(t, True), _items(t).withColumn("Total_Backorder", F.lit(7.0))), _backorder_sql())),
    ("job_dashboard", (lambda t: flattened(jobs.refresh_dashboard(DASHBOARD.report(t, True)), "REQ_No", S.DASHBOARD), _dashboard_sql())),
    ("job_early_warnings", (lambda t: jobs.refresh_early_warnings(EARLY.report(t, True)), _early_sql())),
    ("job_missing_pos", (lambda t: _twice(MISSING, t, jobs.accumulate_missing_pos, 1), header_sql(MISSING, "PO_No", {"Vendor": "Vendor"}))),
])

