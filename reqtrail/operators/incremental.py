"""L16 after a load: recompute the timelines of the requisitions that the load can have changed, and no others.

A requisition's class and events depend on its header, its lines (which link POs), its approval steps, and of every PO it
links on the header, the lines (who else is named) and the approval steps. So a change of

* a header, a line or a step of requisition R affects R;
* a header, a line or a step of PO P affects all requisitions linked to P, **before or after** the load.

``affected_requests`` carries changed keys through these joins; ``update_timeline`` runs the ordinary builder on the rows
of the affected requisitions and their POs, and puts its results in the place of theirs.
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reqtrail.operators import changes, timeline
from reqtrail.operators.keyed import hashed
from reqtrail.session import materialize

#: The tables of the timeline and the key that a load changes them by.
KEYS = {"req": "REQ_No", "req_line": "REQ_No", "req_worklist": "REQ_No", "po": "PO_No", "po_line": "PO_No", "po_worklist": "PO_No"}


class Timelines(NamedTuple):
    """Results by requisition: ``timeline.requisition_timeline``'s two tables."""

    classified: DataFrame
    events: DataFrame


def changed_by_table(old: Mapping[str, DataFrame], new: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The changed keys of every table that a load replaced; a table that is the same object in both has none."""
    return {name: changes.changed_keys(old[name], new[name], [KEYS[name]]) for name in new if new[name] is not old[name]}


def affected_requests(changed: Mapping[str, DataFrame], links_before: DataFrame, links_after: DataFrame) -> DataFrame:
    """(REQ_No): the requisitions whose timeline can differ. ``links_*``: the (REQ_No, PO_Number) rows of the lines."""
    spark = links_after.sparkSession
    found = spark.createDataFrame([], links_after.select("REQ_No").schema)
    for name in ("req", "req_line", "req_worklist"):
        if name in changed:
            found = found.union(changed[name].select("REQ_No"))
    pos = None
    for name in ("po", "po_line", "po_worklist"):
        if name in changed:
            keys = changed[name].select(F.col("PO_No").alias("PO_Number"))
            pos = keys if pos is None else pos.union(keys)
    if pos is not None:
        links = links_before.select("REQ_No", "PO_Number").union(links_after.select("REQ_No", "PO_Number"))
        found = found.union(links.join(pos, "PO_Number", "left_semi").select("REQ_No"))
    return found.where("REQ_No is not null").distinct()


def _of_requests(tables: Mapping[str, DataFrame], affected: DataFrame, many: bool = False) -> dict[str, DataFrame]:
    """The rows that the timelines of ``affected`` read: their own, and those of the POs that they link."""
    out = {n: tables[n].join(hashed(affected, many), "REQ_No", "left_semi") for n in ("req", "req_line", "req_worklist") if tables.get(n) is not None}
    linked = out["req_line"].where("PO_Number is not null").select(F.col("PO_Number").alias("PO_No")).distinct()
    return out | {n: tables[n].join(hashed(linked, many), "PO_No", "left_semi") for n in ("po", "po_line", "po_worklist")}


def update_timeline(before: Timelines, old: Mapping[str, DataFrame], new: Mapping[str, DataFrame],
                    as_of: dt.datetime | Column | None = None, worklist_order: str | None = None,
                    changed: Mapping[str, DataFrame] | None = None, many: bool = False, **options) -> tuple[Timelines, DataFrame]:
    """The timelines after a load, and the requisitions that were recomputed.

    ``old`` and ``new`` hold the tables by their names in ``KEYS`` (``req_worklist`` if used). ``changed`` gives their changed keys
    where a merge knows them; else they are found by row hashes. ``many``: a load that affects many requisitions (see ``keyed.hashed``). ``options`` and ``as_of`` go to ``timeline.requisition_timeline``;
    with another ``as_of`` than before the End of last events differs, so pass the same one or build from scratch.
    """
    changed = changed_by_table(old, new) if changed is None else changed
    affected = materialize(affected_requests(changed, old["req_line"], new["req_line"]), "affected-requests")
    t = _of_requests(new, affected, many)
    classified, events = timeline.requisition_timeline(t["req"], t["req_line"], t["po"], t["po_line"], t["po_worklist"], as_of=as_of,
                                                       worklist_order=worklist_order, req_worklist=t.get("req_worklist"), **options)
    stay = lambda df: df.join(hashed(affected, many), "REQ_No", "left_anti")
    after = Timelines(materialize(stay(before.classified).unionByName(classified), "classified-after"),
                      materialize(stay(before.events).unionByName(events), "events-after"))
    return after, affected


__all__ = ["Timelines", "KEYS", "changed_by_table", "affected_requests", "update_timeline"]
