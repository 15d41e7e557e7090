"""Apply report snapshots as they land, with the same batch loaders.

The source system loads one full dated snapshot per run. This module only changes *when* a loader
runs: a file-stream source watches the snapshot folder, and every micro-batch (the files that
arrived) goes through a loader from ``reqtrail.plans.jobs`` inside ``foreachBatch``: once for each
snapshot in it, in order of their dates, as separate runs would have done. All tables of one run
become current together, by one commit marker, so a run that fails anywhere leaves every table as it
was. A marker names the dataset, the stream and its batch: a replayed run is skipped, and runs of other
streams into the same tables are not mistaken for it.
"""
from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reqtrail.operators.merge import write_version
from reqtrail.operators.rewrite import FileSet, Rewrite, files_under, write_files
from reqtrail.sources.commits import CommitLog
from reqtrail.sources.snapshot import ORD


class TableStore:
    """Versioned Parquet tables under ``base``: ``{base}/{table}/v=.../`` plus one commit log.

    A commit is one log entry: the tag of its run and, for each table it makes current, the version and whether that is a list
    of files (a ``Rewrite``: files kept from earlier versions and new ones) or all of its folder. All tables of a commit become
    current together when the entry appears; of two commits that want one number, one gets it and the other one nothing
    (``sources.commits``).
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self.log = CommitLog(spark, f"{self.base}/_commits")

    def _commits(self) -> list[tuple[int, dict]]:
        return [(number, json.loads(text)) for number, text in self.log.entries()]

    def files(self, table: str) -> FileSet | None:
        """The current version of a table as a list of files, for the merges of ``operators.rewrite``."""
        for _, commit in reversed(self._commits()):
            if table in commit["tables"]:
                version = commit["tables"][table]
                if not version["listed"]:
                    return files_under(self.spark, f"{self.base}/{table}/v={version['id']}")
                listed = self.spark.read.parquet(f"{self.base}/{table}/_files/v={version['id']}")
                names = tuple(sorted(r.path for r in listed.select("path").toLocalIterator()))
                return FileSet(names, T.StructType.fromJson(version["schema"]))
        return None

    def current(self, table: str) -> DataFrame | None:
        found = self.files(table)
        return None if found is None else found.read(self.spark)

    def committed(self, tag: str) -> bool:
        return any(commit["tag"] == tag for _, commit in self._commits())

    def _write(self, table: str, new: DataFrame | Rewrite) -> dict:
        if isinstance(new, DataFrame):
            return {"id": write_version(new, self.base, table).rsplit("/v=", 1)[1], "listed": False}
        version = uuid.uuid4().hex
        made = write_files(new, f"{self.base}/{table}/v={version}")
        kept = set(new.kept)
        names = self.spark.createDataFrame([(f, f in kept) for f in made.files], "path string, kept boolean")
        names.coalesce(1).write.parquet(f"{self.base}/{table}/_files/v={version}")
        return {"id": version, "listed": True, "schema": made.schema.jsonValue()}

    def commit(self, tables: Mapping[str, DataFrame | Rewrite], tag: str, after: int) -> bool:
        """Write the tables and make them current together; False if another run committed since number ``after``."""
        if self.last() != after:
            return False  # before anything is written; the log decides for those that go on
        versions = {name: self._write(name, new) for name, new in tables.items()}
        return self.log.publish(after + 1, json.dumps({"tag": tag, "tables": versions}))

    def last(self) -> int:
        return max((n for n, _ in self._commits()), default=0)


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream when its checkpoint was made."""
    return spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]


def apply_snapshots(spark: SparkSession, source_dir: str, schema: T.StructType, store: TableStore,
                    loader: Callable[..., DataFrame | tuple[DataFrame, ...]], tables: Sequence[str],
                    checkpoint: str, fmt: str = "parquet", dataset: str | None = None):
    """Run ``loader(snapshot, *current_tables) -> new tables`` for every snapshot in every batch of new files.

    ``tables`` names the loader's table arguments and results, in order. A snapshot is the files of one
    ``snapshot_date=`` folder, or of one folder where there is none; its name orders it. Returns the
    started query (``trigger(availableNow=True)``: processes what is there, then stops).
    """
    path = F.col("_metadata.file_path")
    dated = F.regexp_extract(path, "snapshot_date=([^/]+)", 1)
    stream = (spark.readStream.schema(schema).format(fmt).load(source_dir)
                   .withColumn(ORD, F.struct(path.alias("f"), F.col("_metadata.row_index").alias("r")))
                   .withColumn("_snapshot", F.when(dated != "", dated).otherwise(F.regexp_extract(path, "([^/]+)/[^/]+$", 1))))

    def run(batch: DataFrame, batch_id: int) -> None:
        name = f"{dataset or loader.__name__}:{_stream_id(spark, checkpoint)}"
        for (snapshot,) in sorted(batch.select("_snapshot").distinct().collect()):  # the days that wait
            tag = hashlib.sha1(f"{name}:{batch_id}:{snapshot}".encode()).hexdigest()[:20]
            done = store.committed(tag)  # a replay of a committed run
            while not done:
                after = store.last()
                out = loader(batch.where(F.col("_snapshot") == snapshot).drop("_snapshot"), *[store.current(t) for t in tables])
                done = store.commit(dict(zip(tables, out if isinstance(out, tuple) else (out,))), tag, after)

    return (stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
                  .trigger(availableNow=True).start())
