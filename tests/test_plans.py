"""Plans that must stay as they are: scans, shuffles and joins of the one-pass rewrites."""
from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

from reqtrail import session
from reqtrail.operators import merge
from reqtrail.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture
def legs(spark):
    """The plans of a query's intermediate tables and of its result, before they run."""
    if not os.path.isdir(SF):
        pytest.skip("driver test tables not present")

    def of(name: str) -> list[str]:
        out = []
        session.watchers.append(lambda _, df: out.append(df._jdf.queryExecution().executedPlan().toString()))
        try:
            df = catalogue.QUERIES[name](spark, SF)
        finally:
            session.watchers.pop()
        return [*out, df._jdf.queryExecution().executedPlan().toString()]

    return of


def scans(legs: list[str], table: str) -> int:
    return sum(len(re.findall(rf"FileScan parquet [^\n]*/{table}\.parquet", leg)) for leg in legs)


def test_bundled_pos_is_one_aggregation(legs):
    plan = legs("bundled_pos")
    assert scans(plan, "lineitem") == 1 and "Join" not in plan[0] and plan[0].count("Exchange hashpartitioning") == 2


def test_item_master_reads_each_table_once(legs):
    plan = legs("item_master_alias")
    assert scans(plan, "lineitem") == scans(plan, "part") == 1


def test_worklist_report_is_computed_once(legs):
    plan = legs("worklist_legacy_shape")
    assert scans(plan, "lineitem") == scans(plan, "events") == 1


def test_only_single_po_requisitions_look_up_their_po(legs):
    plan = legs("classify_requests")[-1]
    assert re.search(r"n_po#\d+L = 1\)", plan) and re.search(r"n_po#\d+L > 1\)", plan)
    for join in re.findall(r"(?:SortMergeJoin|BroadcastHashJoin) \[([^\]]*)\], \[([^\]]*)\], (\w+)", plan):
        if "link_po" in join[0]:
            break
    else:
        raise AssertionError("no join on the single linked PO")


def test_sequencer_queries_run_no_python(legs):
    for name in ("worklist_events", "nest_lines_positions", "add_to_set_positions", "timeline_events"):
        for leg in legs(name):
            assert "Python" not in leg and "MapInPandas" not in leg and "MapInArrow" not in leg


def test_replace_children_needs_no_distinct_keys(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    new = spark.createDataFrame([(2, "c"), (2, "d"), (None, "e")], "k long, v string")
    out = merge.replace_children(old, new, ["k"], once=True)
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a"), (2, "c"), (2, "d")]
    assert "Aggregate" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.where(F.col("k").isNull()).count() == 0
