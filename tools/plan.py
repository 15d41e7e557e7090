"""Print the physical plan of catalogue queries and count exchanges / Python nodes.

Queries that write intermediate tables run in legs: the plan of each is counted and shown.

usage: python tools/plan.py [sf_dir] name [name ...] [--full]
"""
from __future__ import annotations

import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reqtrail import session  # noqa: E402
from reqtrail.plans import catalogue  # noqa: E402
from reqtrail.session import local_session  # noqa: E402


def main():
    args = [a for a in sys.argv[1:] if a != "--full"]
    full = "--full" in sys.argv
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    spark = local_session(8, shuffle_partitions=16, checkpoint_dir=tempfile.mkdtemp(prefix="checkpoint-"))
    kinds = ["Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition",
             "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "BroadcastNestedLoopJoin",
             "ShuffledHashJoin", "Window", "SortAggregate", "HashAggregate", "ObjectHashAggregate",
             "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroupsInPandas"]

    def show(leg: str, df) -> None:
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"   {leg}: {({k: n for k in kinds if (n := len(re.findall(k, plan)))})}")
        if full:
            print(plan)

    session.watchers.append(show)
    for name in args or list(catalogue.QUERIES):
        print(f"== {name}")
        t0 = time.perf_counter()
        with session.scratch_scope(spark):
            df = catalogue.QUERIES[name](spark, sf_dir)
            show("result", df)
            df.write.format("noop").mode("overwrite").save()
        print(f"   {time.perf_counter() - t0:.2f}s")
    spark.stop()


if __name__ == "__main__":
    main()
