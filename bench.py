"""Benchmark: the catalogue's queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is written to the ``noop`` sink (full execution, no output I/O): one warm-up run, then the
median of $BENCH_RUNS runs (of one run where the warm-up took over LONG seconds). Shuffled bytes come from Spark's event log. ``yardstick_sec``
is a plain scan and sum of lineitem, the same in every round, to tell the machine's speed from the library's.
Prints ONE JSON line.
"""
from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from reqtrail.plans import catalogue  # noqa: E402
from reqtrail.session import local_session, scratch_scope  # noqa: E402

HEADLINE = ["classify_requests", "timeline_events", "upsert_headers", "replace_children_set", "attach_po_to_lines"]


LONG = 15


def yardstick(spark, sf_dir: str) -> float:
    t0 = time.perf_counter()
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").sum("l_quantity", "l_extendedprice").collect()
    return time.perf_counter() - t0


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    with scratch_scope(spark):
        spark.sparkContext.setJobGroup(name, name)
        catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took = time.perf_counter() - t0
    return took


def shuffled_mb(folder: str, runs: dict[str, int]) -> dict[str, float]:
    """MB written to shuffles by query and run: stages belong to the job group that first submitted them."""
    group, total = {}, {}
    for path in glob.glob(f"{folder}/*"):
        with open(path, encoding="utf-8") as log:
            for line in log:
                if '"SparkListenerJobStart"' in line:
                    event = json.loads(line)
                    name = event.get("Properties", {}).get("spark.jobGroup.id")
                    group.update({stage: name for stage in event["Stage IDs"] if stage not in group})
                elif '"SparkListenerTaskEnd"' in line:
                    event = json.loads(line)
                    name = group.get(event["Stage ID"])
                    write = (event.get("Task Metrics") or {}).get("Shuffle Write Metrics", {})
                    total[name] = total.get(name, 0) + write.get("Shuffle Bytes Written", 0)
    return {name: round(n / runs[name] / 1e6, 2) for name, n in total.items() if name in runs}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", "all")
    names = list(catalogue.QUERIES) if names == "all" else names.split(",")
    work = tempfile.mkdtemp(prefix="bench-")
    os.mkdir(f"{work}/events")
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")),
                          driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"), checkpoint_dir=f"{work}/checkpoint",
                          conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{work}/events",
                                "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false"})
    out, ran = {}, {}
    yardstick(spark, sf_dir)
    scan = statistics.median(yardstick(spark, sf_dir) for _ in range(5))
    for name in names:
        warm = run(spark, name, sf_dir)  # JIT, file listing, footers
        ran[name] = 1 + (runs if warm <= LONG else 1)
        out[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(ran[name] - 1)), 3)
    headline = [out[n] for n in HEADLINE if n in out]
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    spark.stop()  # closes the event log
    print(json.dumps({"metric": "headline_total_median_sec", "value": round(sum(headline), 3), "unit": "sec",
                      "queries": out, "total_all_sec": round(sum(out.values()), 3), "sf": sf,
                      "cpus": cpus, "runs": runs, "yardstick_sec": round(scan, 3), "shuffle_mb": shuffled_mb(f"{work}/events", ran)}))


if __name__ == "__main__":
    main()
