"""Session helpers: one place for the configuration every job and test shares."""
from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "reqtrail",
                  driver_memory: str = "8g", checkpoint_dir: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """A local session for tests and benchmarks, with the folder for its intermediate tables.

    On a cluster the session comes from the launcher; the library never builds one.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in (({"spark.checkpoint.dir": checkpoint_dir} if checkpoint_dir else {}) | (conf or {})).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Whoever makes the session names it: a shared file system path on a cluster, any folder for
    tests. Unset is an error; the library never picks a machine-local folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not current:
        raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder (HDFS/S3/NFS) "
                           "visible to every executor")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


#: Tables written inside the open scopes, innermost last.
_scopes: list[list[str]] = []
#: Called with the name and the DataFrame of every intermediate table before it is written (to show its plan).
watchers: list[Callable[[str, DataFrame], None]] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """A job's scope: the intermediate tables written inside are removed when it ends, also on failure.

    Results must be written (or collected) inside, since they read those tables.
    """
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield
    finally:
        _scopes.remove(paths)
        for path in paths:
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def scratch_table_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared checkpoint folder for an intermediate table of the open scope."""
    path = os.path.join(ensure_checkpoint_dir(spark), "tables", f"{name}-{uuid.uuid4().hex}")
    if _scopes:
        _scopes[-1].append(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()`` (a lost executor re-reads the table, not
    the sources), but computes the plan once; ``checkpoint(eager=True)`` runs it a
    second time to write. The folder name is unique, so retries never collide. Inside a
    ``scratch_scope`` the table goes with it; else its owner is whoever cleans the folder.
    """
    path = scratch_table_path(df.sparkSession, name)
    for watch in watchers:
        watch(name, df)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)
