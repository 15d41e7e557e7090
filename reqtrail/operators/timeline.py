"""Requisition classification and the ordered event timeline.

Inputs are flat canonical tables (names as in ``reqtrail.schemas``):

* ``req``          REQ_No, Business_Unit, Buyer, REQ_Date, Approved_By, Approved_On
* ``req_line``     REQ_No, PO_Number (the PO link of each requisition line, NULL if none)
* ``po``           PO_No, Business_Unit, Buyer, Approved_By, PO_Date, Status, PO_Approval_Date
* ``po_line``      PO_No, Req_ID (NULL when the PO line names no requisition)
* ``po_worklist``  PO_No, Appr_Inst, Work_List, Approval_Number, Appr_Stat, Event_Date_Time, User, <order>
* ``req_worklist`` REQ_No, Appr_Inst, Date_Time (optional branch T5 / rule T8)

The per-requisition loop of a document store becomes: two aggregations (distinct
POs per REQ, distinct REQs per PO), one join on the PO number, and a CASE chain.
Only "complete" requisitions reach the event builders (early exit = filter).
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reqtrail.functions.nulls import ts_literal
from reqtrail.functions.text import decode, matches_from_start, template
from reqtrail.operators.chunks import CHUNK_ROWS, chunk_lines, with_header
from reqtrail.operators.sequence import sequence_groups
from reqtrail.session import materialize as materialize_table

# Class labels, message templates and event texts of the timeline job
# ("{}" marks where a value is filled in).
SPLIT, BUNDLED, NO_VALID, COMPLETE, NO_WORKLIST = "SPLITREQ", "BundledPO", "NoValidPO", "complete", "NoWorklist"
MSG_SPLIT = "[SPLITREQ] REQ {} has {} POs associated with it."
MSG_BUNDLED = "[BundledPO] {} REQs found with {}."
MSG_NO_VALID = "No POs associated with REQ {} are valid. Did not insert in DB."
MSG_NO_WORKLIST = "[NoWorklist] Req {} does not have a worklist."
TXT_REQ_CREATION = "REQ Creation by {}"
TXT_REQ_APPROVAL = "REQ Approved by {}"
TXT_PO_CREATION = "PO Creation"
TXT_PO_APPROVAL = "PO Approved by {}"
TXT_PO_INITIATED = "PO Initiated."
TXT_WORKLIST_STEP = "{}, {}."
INVALID_STATUSES = ("C", "D")

EVENT_COLS = ["seq", "ID", "Start_DTTM", "EventType", "Text", "Person", "Internal", "Neutral", "Auto", "Lifecycle"]
WORKLIST_COLS = ["PO_No", "Appr_Inst", "Work_List", "Approval_Number", "Appr_Stat", "Event_Date_Time", "User"]


def _worklist(po_worklist: DataFrame, order: str) -> DataFrame:
    """Only the worklist fields the events use (the sequencer cannot prune columns itself)."""
    return po_worklist.select(*dict.fromkeys(WORKLIST_COLS + [order]))


def valid_po(status: str | Column = "Status", approval: str | Column = "PO_Approval_Date") -> Column:
    """invalid = no approval date and status C or D; anything else (also X) is valid."""
    s = F.col(status) if isinstance(status, str) else status
    a = F.col(approval) if isinstance(approval, str) else approval
    return ~(a.isNull() & F.coalesce(s.isin(*INVALID_STATUSES), F.lit(False)))


def pos_per_req(req_line: DataFrame, req_key: str = "REQ_No", po_key: str = "PO_Number") -> DataFrame:
    """Distinct linked POs per requisition, and the smallest one (the only one when not split)."""
    return (req_line.where(F.col(po_key).isNotNull())
                    .groupBy(req_key)
                    .agg(F.count_distinct(po_key).alias("n_po"), F.min(po_key).alias("link_po")))


NULL_REQ_MODES = ("each", "one", "ignore")


def _n_req(null_req: str) -> Column:
    """D3: "each" = every line without a requisition counts as its own value (what the
    stored data does), "one" = all of them count once, "ignore"."""
    distinct, nulls = F.col("n_distinct"), F.col("n_null")
    n = {"each": distinct + nulls,
         "one": distinct + F.when(nulls > 0, 1).otherwise(0),
         "ignore": distinct}[null_req]
    return n.cast("bigint")


def req_counts_per_po(po_line: DataFrame, po_key: str = "PO_No", req_key: str = "Req_ID") -> DataFrame:
    """A7 in every mode of ``null_req`` from one aggregation: n_req_each, n_req_one, n_req_ignore."""
    counts = po_line.groupBy(po_key).agg(F.count_distinct(req_key).alias("n_distinct"),
                                         F.count_if(F.col(req_key).isNull()).alias("n_null"))
    return counts.select(po_key, *[_n_req(m).alias(f"n_req_{m}") for m in NULL_REQ_MODES])


def reqs_per_po(po_line: DataFrame, null_req: str = "each", po_key: str = "PO_No",
                req_key: str = "Req_ID") -> DataFrame:
    """Distinct requisitions named by a PO's lines, in one mode of ``null_req`` (D3)."""
    return req_counts_per_po(po_line, po_key, req_key).select(po_key, F.col(f"n_req_{null_req}").alias("n_req"))


REQ_FIELDS = ["Buyer", "REQ_Date", "Approved_By", "Approved_On"]
PO_FIELDS = {"Business_Unit": "_po_bu", "Status": "Status", "PO_Approval_Date": "PO_Approval_Date",
             "Buyer": "_po_buyer", "Approved_By": "_po_approved_by", "PO_Date": "PO_Date"}


def _classified_wide(req: DataFrame, req_line: DataFrame, po: DataFrame, po_line: DataFrame, null_req: str,
                     req_worklist: DataFrame | None, require_worklist: bool,
                     carry: bool) -> DataFrame:
    """One row per requisition with its class; with ``carry`` also the REQ and PO fields the
    events need, so the timeline never joins the requisition or PO tables a second time."""
    req_cols = ["REQ_No", "Business_Unit"] + (REQ_FIELDS if carry else [])
    po_cols = {k: v for k, v in PO_FIELDS.items() if carry or v in ("_po_bu", "Status", "PO_Approval_Date")}
    p = (po.select("PO_No", *[F.col(k).alias(v) for k, v in po_cols.items()])
           .join(reqs_per_po(po_line, null_req), "PO_No", "left"))
    # Only requisitions with exactly one PO look it up: split ones and those without a link leave early.
    # PO_DATA is keyed by PO number alone (D18): join on it, then test the unit.
    linked = pos_per_req(req_line)
    one = linked.where(F.col("n_po") == 1).join(p, F.col("link_po") == F.col("PO_No"), "left")
    found_pos = one.unionByName(linked.where(F.col("n_po") > 1), allowMissingColumns=True)
    j = req.select(*req_cols).join(found_pos, "REQ_No", "left")
    if require_worklist:
        has = req_worklist.select("REQ_No").distinct().withColumn("_has_wl", F.lit(True))
        j = j.join(has, "REQ_No", "left")
    n_po = F.coalesce(F.col("n_po"), F.lit(0)).cast("bigint")
    found = F.col("PO_No").isNotNull() & F.col("_po_bu").eqNullSafe(F.col("Business_Unit"))
    n_req = F.coalesce(F.col("n_req"), F.lit(0))
    cls = F.when(n_po > 1, SPLIT).when(found & (n_req > 1), BUNDLED).when(~found | ~valid_po(), NO_VALID) \
           .otherwise(COMPLETE)
    if require_worklist:
        cls = F.when(~F.coalesce(F.col("_has_wl"), F.lit(False)), NO_WORKLIST).otherwise(cls)
    return (j.withColumn("cls", cls).withColumn("_found", found)
             .withColumn("n_po", n_po).withColumn("n_req", F.when(found, n_req)))


def _classified_view(j: DataFrame) -> DataFrame:
    msg = (F.when(F.col("cls") == SPLIT, template(MSG_SPLIT, "REQ_No", "n_po"))
            .when(F.col("cls") == BUNDLED, template(MSG_BUNDLED, "n_req", "link_po"))
            .when(F.col("cls") == NO_VALID, template(MSG_NO_VALID, "REQ_No"))
            .when(F.col("cls") == NO_WORKLIST, template(MSG_NO_WORKLIST, "REQ_No"))
            .otherwise(F.lit("")))
    cause = (F.when(F.col("cls") != NO_VALID, F.lit(None).cast("string"))
              .when(F.col("n_po") == 0, "none").when(~F.col("_found"), "mismatch").otherwise("invalid"))
    complete = F.col("cls") == COMPLETE
    return j.select(
        "REQ_No",
        F.when(complete, F.col("link_po")).otherwise(F.lit("")).alias("PO_No"),
        F.when(complete, F.col("Business_Unit").cast("string")).otherwise(F.lit("")).alias("Business_Unit"),
        msg.alias("Complicated"),
        F.lit("").alias("Footnote"),
        "cls", cause.alias("cause"), "n_po")


def classify_requests(req: DataFrame, req_line: DataFrame, po: DataFrame, po_line: DataFrame,
                      null_req: str = "each", req_worklist: DataFrame | None = None,
                      require_worklist: bool = False) -> DataFrame:
    """One row per requisition with its class and message.

    Output: REQ_No, PO_No and Business_Unit (text; "" unless complete, as the
    source writes them), Complicated (message, "" when complete), Footnote, cls,
    cause (none / mismatch / invalid for NoValidPO, else NULL), n_po.
    """
    return _classified_view(_classified_wide(req, req_line, po, po_line, null_req, req_worklist,
                                             require_worklist, carry=False))


def _event(id_: Column, start: Column, etype: str | Column, text: Column, person: Column, internal: bool | Column,
           auto: bool | Column, lifecycle: str) -> Column:
    lit = lambda v: F.lit(v) if not isinstance(v, Column) else v
    return F.struct(id_.cast("string").alias("ID"), start.alias("Start_DTTM"), lit(etype).alias("EventType"),
                    text.alias("Text"), person.cast("string").alias("Person"), lit(internal).alias("Internal"),
                    F.lit(False).alias("Neutral"), lit(auto).alias("Auto"), F.lit(lifecycle).alias("Lifecycle"))


def req_events(req: DataFrame) -> DataFrame:
    """Creation and approval event of each requisition (narrow, no shuffle)."""
    creation = _event(F.col("REQ_No"), F.col("REQ_Date"), "Creation", template(TXT_REQ_CREATION, "Buyer"),
                      F.col("Buyer"), False, False, "REQ")
    approval = _event(F.col("REQ_No"), F.col("Approved_On"), "Approval",
                      template(TXT_REQ_APPROVAL, "Approved_By"), F.col("Approved_By"), True, False, "REQ")
    return (req.select("REQ_No", F.inline(F.array(
                F.struct(F.lit(0).alias("seq"), creation.alias("e")),
                F.struct(F.lit(1).alias("seq"), approval.alias("e")))))
               .select("REQ_No", "seq", "e.*"))


def po_events(po: DataFrame) -> DataFrame:
    """PO creation, and PO approval only when it is dated."""
    creation = _event(F.col("PO_No"), F.col("PO_Date"), "Creation", F.lit(TXT_PO_CREATION), F.col("Buyer"),
                      True, False, "PO")
    approval = _event(F.col("PO_No"), F.col("PO_Approval_Date"), "Approval",
                      template(TXT_PO_APPROVAL, "Approved_By"), F.col("Approved_By"), True, False, "PO")
    arr = F.array(F.struct(F.lit(0).alias("seq"), creation.alias("e")),
                  F.when(F.col("PO_Approval_Date").isNotNull(), F.struct(F.lit(1).alias("seq"), approval.alias("e"))))
    return (po.select("PO_No", F.inline(F.filter(arr, lambda x: x.isNotNull())))
              .select("PO_No", "seq", "e.*"))


def worklist_events(po_worklist: DataFrame, order: str) -> DataFrame:
    """T4: one event per PO approval step.

    Steps are ordered by (Event_Date_Time, Approval_Number), ties in the stored
    ``order``, a column that is unique within a PO (an approval instance alone is not); ``seq`` is the 0-based position in that order. Auto = the previous
    step of the same PO has the same timestamp (W2). Ordering uses the skew-safe
    sequencer, so one PO holding most steps is spread over many tasks.
    """
    ranked = sequence_groups(_worklist(po_worklist, order), ["PO_No"],
                             ["Event_Date_Time", "Approval_Number", order],
                             lag_cols=["Event_Date_Time"])
    auto = (F.col("_rank") > 1) & F.col("_lag_Event_Date_Time").eqNullSafe(F.col("Event_Date_Time"))
    stat = F.col("Appr_Stat")
    text = F.when(stat == "I", F.lit(TXT_PO_INITIATED)).otherwise(
        template(TXT_WORKLIST_STEP, "Work_List", "Approval_Number"))
    ev = _event(F.col("Appr_Inst"), F.col("Event_Date_Time"), decode(stat), text, F.col("User"),
                matches_from_start(F.col("Work_List")), auto, "PO")
    return (ranked.select("PO_No", (F.col("_rank") - 1).cast("int").alias("seq"), ev.alias("e"))
                  .select("PO_No", "seq", "e.*"))


def req_worklist_events(req_worklist: DataFrame, time_col: str = "Date_Time") -> DataFrame:
    """T5 (off by default): REQ approval steps as blank events starting at their time.

    The source writes "" into the flag fields; as booleans they are False.
    """
    return req_worklist.select(
        "REQ_No", F.col("Appr_Inst").cast("string").alias("ID"), F.col(time_col).alias("Start_DTTM"),
        F.lit("").alias("EventType"), F.lit("").alias("Text"), F.lit("").alias("Person"),
        F.lit(False).alias("Internal"), F.lit(False).alias("Neutral"),
        F.lit(False).alias("Auto"), F.lit("").alias("Lifecycle"))


def _as_of(as_of: dt.datetime | Column | None) -> Column:
    if as_of is None:
        return F.localtimestamp()
    return as_of.cast("timestamp_ntz") if isinstance(as_of, Column) else ts_literal(as_of)


def with_end_times(events: DataFrame, as_of: dt.datetime | Column | None, key: str = "REQ_No") -> DataFrame:
    """End = the next Start in time order (ties by ``seq``); the last dated event ends at ``as_of``.

    Events without a Start sort last and get no End (D12). The stored order of the
    events stays the construction order ``seq`` (D5).
    """
    nxt = sequence_groups(events, [key], ["Start_DTTM", "seq"], lead_cols=["Start_DTTM"])
    end = F.when(F.col("Start_DTTM").isNotNull(), F.coalesce(F.col("_lead_Start_DTTM"), _as_of(as_of)))
    return nxt.withColumn("End_DTTM", end).drop("_rank", "_lead_Start_DTTM")


def _events_from_done(done: DataFrame, po_worklist: DataFrame, as_of: dt.datetime | Column | None,
                      worklist_order: str, req_worklist: DataFrame | None) -> DataFrame:
    """Events of complete requisitions from a (materialised) frame carrying REQ and PO fields.

    * worklist steps: INNER join on the PO number (AQE may split a hot PO on either
      side), then one skew-safe sequencer pass gives each step its position, the
      previous step's time (``Auto``) and the next step's time.
    * End = the smallest Start ordered after the event (time, then ``seq``). For a
      step that is the next step's time or the first later fixed start (the row
      carries the four fixed starts). For a REQ/PO event it is a later fixed start
      or the first step at or after it, a per-requisition partial aggregation.
      So no second shuffle over all events is needed.
    * REQ and PO events: row-local ``inline`` of up to four structs.
    """
    as_of_c = _as_of(as_of)
    starts = ["REQ_Date", "Approved_On", "PO_Date", "PO_Approval_Date"]
    base = (F.col("PO_Approval_Date").isNotNull().cast("int") + 3).alias("_base")
    owners = done.select(F.col("link_po").alias("PO_No"), "REQ_No", base,
                         *[F.col(c).alias(f"_s{k}") for k, c in enumerate(starts)])
    steps = _worklist(po_worklist, worklist_order).join(owners, "PO_No").withColumn("_po_step", F.lit(True))
    order = ["Event_Date_Time", "Approval_Number", worklist_order]
    if req_worklist is not None:
        # T5: the requisition's own steps are merged into the stream: after PO steps of the same time, by their id. Positions among
        # the steps of either kind are running counts, so one sequencing serves both orders.
        own = req_worklist.select("REQ_No", F.col("Appr_Inst").cast("string").alias("_req_step"), F.col("Date_Time").alias("Event_Date_Time"))
        own = own.join(owners, "REQ_No").withColumn("_po_step", F.lit(False))
        steps = steps.withColumn("_req_step", F.lit(None).cast("string")).unionByName(own, allowMissingColumns=True)
        order = ["Event_Date_Time", F.col("_po_step").cast("int") * -1, "Approval_Number", worklist_order, "_req_step"]
    steps = sequence_groups(steps, ["REQ_No"], order, lag_cols=["Event_Date_Time", "_po_step"], lead_cols=["Event_Date_Time"],
                            count_cols=["_po_step"])
    steps = materialize_table(steps, "sequenced-steps")  # read as events and for the first step after each fixed event
    t = F.col("Event_Date_Time")

    def ev(seq, id_, start, etype, text, person, internal, auto, life, end):
        lit = lambda v: F.lit(v) if not isinstance(v, Column) else v
        return F.struct(lit(seq).cast("int").alias("seq"), id_.cast("string").alias("ID"),
                        start.alias("Start_DTTM"), end.alias("End_DTTM"), lit(etype).alias("EventType"),
                        text.alias("Text"), person.cast("string").alias("Person"),
                        lit(internal).cast("boolean").alias("Internal"), F.lit(False).alias("Neutral"),
                        lit(auto).cast("boolean").alias("Auto"), F.lit(life).alias("Lifecycle"))

    # Steps. A later fixed event has a strictly later start (its seq is smaller).
    later_fixed = F.least(*[F.when(F.col(f"_s{k}") > t, F.col(f"_s{k}")) for k in range(4)])
    step_end = F.when(t.isNotNull(), F.coalesce(F.least(F.col("_lead_Event_Date_Time"), later_fixed), as_of_c))
    # PO steps of one time stand together, so the PO step before this one is the row before it if their times are equal.
    auto = F.coalesce(F.col("_lag__po_step"), F.lit(False)) & F.col("_lag_Event_Date_Time").eqNullSafe(t)
    stat = F.col("Appr_Stat")
    text = F.when(stat == "I", F.lit(TXT_PO_INITIATED)).otherwise(
        template(TXT_WORKLIST_STEP, "Work_List", "Approval_Number"))
    step_ev = (steps.where("_po_step").select("REQ_No", "PO_No", ev(F.col("_base") + F.col("_count__po_step") - 1, F.col("Appr_Inst"), t,
                                                  decode(stat), text, F.col("User"),
                                                  matches_from_start(F.col("Work_List")), auto, "PO",
                                                  step_end).alias("e"))
                    .select("REQ_No", "PO_No", "e.*"))

    # REQ/PO events. First step at or after each fixed start: one partial aggregation.
    first_after = steps.groupBy("REQ_No").agg(
        F.count_if("_po_step").alias("_nwl"), *[F.min(F.when(t >= F.col(f"_s{k}"), t)).alias(f"_m{k}") for k in range(4)])
    fx = done.join(first_after, "REQ_No", "left")
    s_ = [F.col(c) for c in starts]
    s_[3] = F.when(F.col("PO_Approval_Date").isNotNull(), F.col("PO_Approval_Date"))

    def fixed_end(k: int) -> Column:
        later = [F.when((s_[g] > s_[k]) | ((s_[g] == s_[k]) & F.lit(g > k)), s_[g]) for g in range(4) if g != k]
        return F.when(s_[k].isNotNull(), F.coalesce(F.least(F.col(f"_m{k}"), *later), as_of_c))

    fixed = F.array(
        ev(0, F.col("REQ_No"), s_[0], "Creation", template(TXT_REQ_CREATION, "Buyer"), F.col("Buyer"),
           False, False, "REQ", fixed_end(0)),
        ev(1, F.col("REQ_No"), s_[1], "Approval", template(TXT_REQ_APPROVAL, "Approved_By"),
           F.col("Approved_By"), True, False, "REQ", fixed_end(1)),
        ev(2, F.col("link_po"), s_[2], "Creation", F.lit(TXT_PO_CREATION), F.col("_po_buyer"), True, False, "PO",
           fixed_end(2)),
        F.when(F.col("PO_Approval_Date").isNotNull(),
               ev(3, F.col("link_po"), s_[3], "Approval", template(TXT_PO_APPROVAL, "_po_approved_by"),
                  F.col("_po_approved_by"), True, False, "PO", fixed_end(3))))
    fixed_ev = (fx.select("REQ_No", F.col("link_po").alias("PO_No"),
                          F.inline(F.filter(fixed, lambda x: x.isNotNull())))
                  .select("REQ_No", "PO_No", "seq", "ID", "Start_DTTM", "End_DTTM", *EVENT_COLS[3:]))
    events = fixed_ev.unionByName(step_ev)
    if req_worklist is not None:
        # T5: in construction order the requisition's steps follow those of the PO.
        own = steps.where(~F.col("_po_step")).join(first_after.select("REQ_No", "_nwl"), "REQ_No")
        blank = F.lit("")
        own = own.select("REQ_No", "PO_No", ev(F.col("_base") + F.col("_nwl") + F.col("_rank") - F.col("_count__po_step") - 1, F.col("_req_step"), t,
                                               "", blank, blank, False, False, "", step_end).alias("e"))
        events = events.unionByName(own.select("REQ_No", "PO_No", "e.*"))
    return events.select("REQ_No", "PO_No", "seq", "ID", "Start_DTTM", "End_DTTM", *EVENT_COLS[3:])


def requisition_timeline(req: DataFrame, req_line: DataFrame, po: DataFrame, po_line: DataFrame,
                         po_worklist: DataFrame, as_of: dt.datetime | Column | None = None,
                         null_req: str = "each", worklist_order: str | None = None,
                         req_worklist: DataFrame | None = None, require_worklist: bool = False,
                         include_req_worklist: bool = False, materialize: bool = True) -> tuple[DataFrame, DataFrame]:
    """(classified requisitions, flat timeline events) from the source tables.

    With ``materialize`` the classification (one row per requisition) is written
    once as a table in ``spark.checkpoint.dir``: both outputs and every event
    branch read it instead of re-running the classification shuffles, and a lost
    executor does not send the job back to the source scans.
    """
    wide = _classified_wide(req, req_line, po, po_line, null_req, req_worklist, require_worklist, carry=True)
    if materialize:
        wide = materialize_table(wide, "classified")
    done = wide.where(F.col("cls") == COMPLETE)
    events = _events_from_done(done, po_worklist, as_of, worklist_order,
                               req_worklist if include_req_worklist else None)
    return _classified_view(wide), events


#: Fields of one event of a document.
EVENT_FIELDS = ["ID", "Start_DTTM", "End_DTTM", "EventType", "Text", "Person", "Internal", "Neutral", "Auto", "Lifecycle"]


def timeline_documents(classified: DataFrame, events: DataFrame) -> DataFrame:
    """One document per requisition; complete ones carry ``events`` in ``seq`` order.

    Complicated rows carry their message and an empty ``events`` array.
    """
    arr = (events.groupBy("REQ_No")
                 .agg(F.sort_array(F.collect_list(F.struct("seq", *EVENT_FIELDS))).alias("_a"))
                 .select("REQ_No", F.transform("_a", lambda e: e.dropFields("seq")).alias("events")))
    arr_type = arr.schema["events"].dataType
    docs = classified.join(arr, "REQ_No", "left")
    return docs.select("REQ_No", "PO_No", "Business_Unit", "Complicated", "Footnote", "cls",
                       F.coalesce(F.col("events"), F.array().cast(arr_type)).alias("events"))


def timeline_document_chunks(classified: DataFrame, events: DataFrame, rows: int = CHUNK_ROWS) -> DataFrame:
    """``timeline_documents`` in chunks of at most ``rows`` events: one row per requisition and ``chunk``."""
    parts = chunk_lines(events, ["REQ_No"], ["seq"], EVENT_FIELDS, "events", rows=rows)
    header = classified.select("REQ_No", "PO_No", "Business_Unit", "Complicated", "Footnote", "cls")
    return with_header(header, parts, ["REQ_No"], "events")


def timeline_summary(classified: DataFrame, events: DataFrame) -> DataFrame:
    """T6/T7/U2 as one flat row per requisition: class, message, number of events, first
    Start, last End, first event type and last event text (in ``seq`` order).

    Built with partial aggregation over the flat events, so no requisition's events
    are gathered into one array or one task.
    """
    agg = events.groupBy("REQ_No").agg(
        F.count(F.lit(1)).alias("n_events"), F.min("Start_DTTM").alias("first_start"),
        F.max("End_DTTM").alias("last_end"), F.min_by("EventType", "seq").alias("first_type"),
        F.max_by("Text", "seq").alias("last_text"))
    return (classified.join(agg, "REQ_No", "left")
                      .select("REQ_No", "PO_No", "Business_Unit", "cls", "Complicated", "Footnote",
                              F.coalesce(F.col("n_events"), F.lit(0)).cast("bigint").alias("n_events"),
                              "first_start", "last_end", "first_type", "last_text"))
