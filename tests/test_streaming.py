from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reqtrail.plans import jobs
from reqtrail.streaming import TableStore, apply_snapshots

SCHEMA = T.StructType([T.StructField("PO No.", T.StringType()), T.StructField("Vendor", T.StringType())])


class Stage:
    """A landing folder, a table store and streams over them."""

    def __init__(self, spark, root):
        self.spark, self.root, self.store = spark, str(root), TableStore(spark, f"{root}/tables")

    def land(self, rows, name, source="in"):
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{self.root}/{source}/{name}")

    def run(self, loader=jobs.accumulate_missing_pos, tables=("missing_po",), source="in", checkpoint="ckpt"):
        q = apply_snapshots(self.spark, f"{self.root}/{source}/*", SCHEMA, self.store, loader, list(tables), f"{self.root}/{checkpoint}")
        q.awaitTermination()

    def vendors(self, table="missing_po"):
        return {r["PO_No"]: r["Vendor"] for r in self.store.current(table).collect()}


@pytest.fixture
def stage(spark, tmp_path):
    return Stage(spark, tmp_path)


def test_missing_po_snapshots_applied_as_they_arrive(stage):
    stage.land([("P1", "v1"), ("P1", "v2")], "d1")
    stage.run()
    assert stage.vendors() == {"P1": "v1"}
    stage.land([("P2", "v3"), ("P1", "v9")], "d2")
    stage.run()
    stage.run()  # nothing new
    assert stage.vendors() == {"P1": "v9", "P2": "v3"}


def test_two_streams_into_one_table(stage):
    """Both streams start at batch 0; neither is taken for the other."""
    stage.land([("P1", "a")], "d1", "first")
    stage.land([("P2", "b")], "d1", "second")
    stage.run(source="first", checkpoint="c1")
    stage.run(source="second", checkpoint="c2")
    assert stage.vendors() == {"P1": "a", "P2": "b"}


def test_pending_days_are_applied_one_by_one(stage):
    """Children of the last day replace those of the day before, as daily runs would."""
    from reqtrail.operators import merge

    def replace(snapshot, lines):
        rows = snapshot.select(F.col("`PO No.`").alias("PO_No"), "Vendor")
        return rows if lines is None else merge.replace_children(lines, rows, ["PO_No"])

    stage.land([("P1", "old"), ("P2", "kept")], "snapshot_date=2024-01-01")
    stage.land([("P1", "new1"), ("P1", "new2")], "snapshot_date=2024-01-02")
    stage.run(replace, ["lines"])
    got = sorted((r["PO_No"], r["Vendor"]) for r in stage.store.current("lines").collect())
    assert got == [("P1", "new1"), ("P1", "new2"), ("P2", "kept")]


def test_failure_between_two_tables_changes_neither(stage, monkeypatch):
    """The run is repeated on the tables it first saw, so nothing is applied twice."""
    from reqtrail.streaming import snapshots

    def count(snapshot, a, b):
        n = snapshot.agg(F.count("*").alias("n"))
        add = lambda t: n if t is None else t.crossJoin(n.withColumnRenamed("n", "m")).select((F.col("n") + F.col("m")).alias("n"))
        return add(a), add(b)

    stage.land([("P1", "x"), ("P2", "y")], "d1")
    write, calls = snapshots.write_version, []

    def failing(df, base, table):
        calls.append(table)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return write(df, base, table)

    monkeypatch.setattr(snapshots, "write_version", failing)
    with pytest.raises(Exception):
        stage.run(count, ["a", "b"])
    assert stage.store.current("a") is None and stage.store.current("b") is None
    stage.run(count, ["a", "b"])
    assert stage.store.current("a").first().n == stage.store.current("b").first().n == 2


def test_a_commit_of_another_run_is_not_overwritten(stage):
    df = stage.spark.createDataFrame([(1,)], "n long")
    assert stage.store.commit({"t": df}, "one", 0)
    assert not stage.store.commit({"t": df}, "two", 0) and stage.store.commit({"t": df}, "two", 1)
    assert stage.store.committed("one") and stage.store.committed("two") and stage.store.last() == 2


def _two_writers(spark, root, at):
    """Commit "a" of one store while another one commits "b" in full just before its step number ``at``."""
    from reqtrail.streaming import snapshots

    a, b = TableStore(spark, str(root)), TableStore(spark, str(root))
    df = lambda n: spark.createDataFrame([(n,)], "n long")
    steps, won = [], {}

    def rival(f):
        def call(*args, **kwargs):
            steps.append(f.__name__)
            if len(steps) == at:
                won["b"] = b.commit({"t": df(2), "u": df(2)}, "b", 0)
            return f(*args, **kwargs)
        return call

    for part in ("last", "_write"):
        setattr(a, part, rival(getattr(a, part)))
    a.log.publish = rival(a.log.publish)
    won["a"] = a.commit({"t": df(1), "u": df(1)}, "a", 0)
    return a, b, won, steps


@pytest.mark.parametrize("at", [1, 2, 3, 4])
def test_one_of_two_commits_gets_the_number(spark, tmp_path, at):
    """Whatever step the other commit comes at, one wins whole, the other one is told and commits after it."""
    a, b, won, steps = _two_writers(spark, tmp_path / "store", at)
    assert sorted(won.values()) == [False, True] and won["b"]
    store = TableStore(spark, str(tmp_path / "store"))
    assert store.committed("b") and not store.committed("a") and store.last() == 1
    assert store.current("t").first().n == store.current("u").first().n == 2
    assert TableStore(spark, str(tmp_path / "store")).commit({"t": spark.createDataFrame([(1,)], "n long")}, "a", store.last())
    assert store.committed("a") and store.last() == 2 and store.current("t").first().n == 1 and store.current("u").first().n == 2


def test_many_writers_of_one_number(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from reqtrail.sources.commits import CommitLog

    for number in range(1, 21):
        with ThreadPoolExecutor(8) as pool:
            won = list(pool.map(lambda i: CommitLog(spark, str(tmp_path / "log")).publish(number, f"writer {i}"), range(8)))
        assert won.count(True) == 1
        assert CommitLog(spark, str(tmp_path / "log")).entries()[-1] == (number, f"writer {won.index(True)}")
    assert sorted(p.name for p in (tmp_path / "log").iterdir()) == [f"{n:012d}" for n in range(1, 21)]
