"""DuckDB SQL for the fixture views (FIXTURES.md §3.2), used only by the oracle side.

The Spark side builds the same views with the DataFrame API in ``fixtures.py``.
``with_views(body)`` prepends the CTEs a query body references.
"""
from __future__ import annotations

import re

LI_ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate"

VIEWS: dict[str, str] = {
    "fx_req": """select o_orderkey as REQ_No, o_orderkey % 2 as Business_Unit,
       concat('Buyer', cast(o_custkey % 50 as string)) as Buyer, o_orderdate as REQ_Date,
       o_orderpriority as Approved_By, o_orderdate + interval '2' day as Approved_On, o_orderstatus as Status
from orders""",
    "fx_req_line": """select l_orderkey as REQ_No, l_orderkey % 2 as Business_Unit, l_linenumber as Line_No,
       l_extendedprice as Line_Total, l_quantity as Quantity, l_shipdate as Due_Date,
       cast(l_partkey as string) as Item, l_suppkey as Supp
from lineitem""",
    "fx_po_line": """select concat(case when l_quantity <= 10 then '' else 'S' end, cast(l_partkey as string), '-', cast(year(l_shipdate) * 100 + month(l_shipdate) as string)) as PO_No,
       l_orderkey as REQ_No, case when l_quantity <= 10 and l_linenumber <> 7 then l_orderkey end as Req_ID,
       l_linenumber as Req_Line, l_suppkey % 2 as Business_Unit, l_suppkey as Vendor, l_shipdate as PO_Date,
       case l_returnflag when 'A' then 'A' when 'N' then 'D' else 'C' end as Status,
       case when l_linestatus = 'F' then l_shipdate + interval '1' day end as PO_Approval_Date,
       l_extendedprice as Line_Total, l_quantity as Quantity
from lineitem""",
    "fx_po": """select PO_No, Business_Unit, concat('Supp', cast(Vendor as string)) as Buyer,
       concat('Chief', cast(Vendor % 7 as string)) as Approved_By, PO_Date, Status, PO_Approval_Date
from (select *, row_number() over (partition by PO_No
                                   order by PO_Date, REQ_No, Req_Line, Vendor, Line_Total, Quantity) as rn
      from fx_po_line) t
where rn = 1""",
    "fx_link": "select distinct REQ_No, case when Quantity <= 10 then PO_No end as PO_Number from fx_po_line",
    "fx_po_worklist": """select k.PO_Number as PO_No, e.event_id as Appr_Inst,
       case e.event_type when 'purchase' then 'Central Procurement' when 'error' then 'PROCUREMENT audit'
            else concat('Team ', e.event_type) end as Work_List,
       cast(e.event_id % 3 as string) as Approval_Number,
       case e.event_type when 'view' then 'I' when 'purchase' then 'A' when 'error' then 'D' else e.event_type end as Appr_Stat,
       date_trunc('hour', e.ts) as Event_Date_Time, cast(e.user_id as string) as "User"
from events e join fx_link k on k.REQ_No = cast(floor(e.event_id / 3) as bigint) where k.PO_Number is not null""",
    "fx_req_worklist": """select q.REQ_No, e.event_id as Appr_Inst, q.Business_Unit as Unit,
       case e.event_type when 'purchase' then 'Central Procurement' when 'error' then 'PROCUREMENT audit'
            else concat('Team ', e.event_type) end as Work_List,
       cast(e.event_id % 3 as string) as Approval_Number,
       case e.event_type when 'view' then 'I' when 'purchase' then 'A' when 'error' then 'D' else e.event_type end as Appr_Stat,
       e.ts as Date_Time, cast(e.user_id as string) as "User"
from events e join fx_req q on q.REQ_No = cast(floor(e.event_id / 3) as bigint)""",
    "fx_xwalk": f"""select l_orderkey as Req_ID, case when l_quantity <= 10 then l_orderkey % 2 else 9 end as Unit, l_linenumber as REQ_Line,
       concat(cast(l_partkey as string), '-', cast(year(l_shipdate) * 100 + month(l_shipdate) as string)) as PO_No,
       cast(l_suppkey % 100 as string) as PO_Line, {LI_ORDER}
from lineitem""",
}

# Derived views shared by several oracle queries.
VIEWS["ox_class"] = """select r.REQ_No, r.Business_Unit, r.n_po, r.link_po, p.PO_No as found_po, p.Status,
       p.PO_Approval_Date, b.n_req,
       case when r.n_po > 1 then 'SPLITREQ'
            when p.PO_No is not null and coalesce(b.n_req, 0) > 1 then 'BundledPO'
            when p.PO_No is null then 'NoValidPO'
            when p.PO_Approval_Date is null and p.Status in ('C', 'D') then 'NoValidPO'
            else 'complete' end as cls
from (select q.REQ_No, q.Business_Unit, count(distinct k.PO_Number) as n_po, min(k.PO_Number) as link_po
      from fx_req q left join fx_link k on k.REQ_No = q.REQ_No group by q.REQ_No, q.Business_Unit) r
left join fx_po p on p.PO_No = r.link_po and p.Business_Unit = r.Business_Unit
left join (select PO_No, cast(count(distinct Req_ID) + count(*) filter (where Req_ID is null) as bigint) as n_req
           from fx_po_line group by PO_No) b on b.PO_No = r.link_po"""
VIEWS["ox_wl_events"] = """select w.PO_No,
       cast(row_number() over (partition by w.PO_No order by w.Event_Date_Time, w.Approval_Number, w.Appr_Inst) - 1 as integer) as seq,
       cast(w.Appr_Inst as string) as ID, w.Event_Date_Time as Start_DTTM,
       case w.Appr_Stat when 'I' then 'Initiated' when 'A' then 'Approved' when 'D' then 'Denied' else w.Appr_Stat end as EventType,
       case when w.Appr_Stat = 'I' then 'PO Initiated.'
            else concat(coalesce(w.Work_List, ''), ', ', coalesce(w.Approval_Number, ''), '.') end as Text,
       w."User" as Person,
       coalesce(regexp_matches(w.Work_List, '(?i)^[^\\n]*procurement'), false) as Internal,
       false as Neutral,
       row_number() over (partition by w.PO_No, w.Event_Date_Time order by w.Approval_Number, w.Appr_Inst) > 1 as Auto,
       'PO' as Lifecycle
from fx_po_worklist w"""
VIEWS["ox_req_events"] = """select REQ_No, 0 as seq, cast(REQ_No as string) as ID, REQ_Date as Start_DTTM, 'Creation' as EventType,
       concat('REQ Creation by ', coalesce(Buyer, '')) as Text, Buyer as Person, false as Internal, false as Neutral,
       false as Auto, 'REQ' as Lifecycle from fx_req
union all
select REQ_No, 1, cast(REQ_No as string), Approved_On, 'Approval', concat('REQ Approved by ', coalesce(Approved_By, '')),
       Approved_By, true, false, false, 'REQ' from fx_req"""
VIEWS["ox_po_events"] = """select PO_No, 0 as seq, PO_No as ID, PO_Date as Start_DTTM, 'Creation' as EventType, 'PO Creation' as Text,
       Buyer as Person, true as Internal, false as Neutral, false as Auto, 'PO' as Lifecycle from fx_po
union all
select PO_No, 1, PO_No, PO_Approval_Date, 'Approval', concat('PO Approved by ', coalesce(Approved_By, '')), Approved_By,
       true, false, false, 'PO' from fx_po where PO_Approval_Date is not null"""
VIEWS["ox_timeline"] = """select e.*, case when e.Start_DTTM is not null then coalesce(lead(e.Start_DTTM) over (
           partition by e.REQ_No order by e.Start_DTTM asc nulls last, e.seq), TIMESTAMP '2030-01-01 00:00:00') end as End_DTTM
from (
  select c.REQ_No, c.link_po as PO_No, r.seq, r.ID, r.Start_DTTM, r.EventType, r.Text, r.Person, r.Internal, r.Neutral,
         r.Auto, r.Lifecycle
  from ox_class c join ox_req_events r on r.REQ_No = c.REQ_No where c.cls = 'complete'
  union all
  select c.REQ_No, c.link_po, p.seq + 2, p.ID, p.Start_DTTM, p.EventType, p.Text, p.Person, p.Internal, p.Neutral,
         p.Auto, p.Lifecycle
  from ox_class c join ox_po_events p on p.PO_No = c.link_po where c.cls = 'complete'
  union all
  select c.REQ_No, c.link_po, cast(w.seq + 3 + case when c.PO_Approval_Date is not null then 1 else 0 end as integer),
         w.ID, w.Start_DTTM, w.EventType, w.Text, w.Person, w.Internal, w.Neutral, w.Auto, w.Lifecycle
  from ox_class c join ox_wl_events w on w.PO_No = c.link_po where c.cls = 'complete'
) e"""

VIEWS["ox_timeline_req_steps"] = """select e.REQ_No, e.PO_No, e.seq, e.ID, e.Start_DTTM, e.EventType, e.Text, e.Person, e.Internal, e.Neutral, e.Auto, e.Lifecycle,
       case when e.Start_DTTM is not null then coalesce(lead(e.Start_DTTM) over (
           partition by e.REQ_No order by e.Start_DTTM asc nulls last, e.seq), TIMESTAMP '2030-01-01 00:00:00') end as End_DTTM
from (
  select REQ_No, PO_No, seq, ID, Start_DTTM, EventType, Text, Person, Internal, Neutral, Auto, Lifecycle from ox_timeline
  union all
  select w.REQ_No, c.link_po,
         cast(n.n + row_number() over (partition by w.REQ_No order by w.Date_Time asc nulls last, cast(w.Appr_Inst as string)) - 1 as integer),
         cast(w.Appr_Inst as string), w.Date_Time, '', '', '', false, false, false, ''
  from fx_req_worklist w join ox_class c on c.REQ_No = w.REQ_No and c.cls = 'complete'
  join (select REQ_No, count(*) as n from ox_timeline group by REQ_No) n on n.REQ_No = w.REQ_No
) e"""

_ORDER = list(VIEWS)


def with_views(body: str) -> str:
    """Prepend the CTEs (and their dependencies) that ``body`` references."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in _ORDER:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(VIEWS[name])

    visit(body)
    if not needed:
        return body
    ctes = ",\n".join(f"{n} as (\n{VIEWS[n]}\n)" for n in _ORDER if n in needed)
    head = body.lstrip()
    if head[:5].lower() == "with ":
        return f"with {ctes},\n{head[5:]}"
    return f"with {ctes}\n{body}"
