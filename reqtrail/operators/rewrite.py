"""K1, K2, K7, K8 on large tables: merge a snapshot by rewriting only the files it touches.

``operators.merge`` says what a merge yields; a table of many files need not be read and written whole to yield it. Each
function here finds the files that hold a row the snapshot changes, applies the merge of
``operators.merge`` to the rows of those files alone, and returns a ``Rewrite``: the files that stay as
they are, and the rows that replace the others. ``write_files`` (or a commit of ``streaming.TableStore``) makes it a version: a
list of kept and new files.

The search reads only the key columns (and the tested column), and only between the snapshot's smallest and
greatest first key, which Parquet skips to by its row-group statistics. New files are ranges of the keys, so a later
snapshot of near keys touches few of them. File names reach the driver, as they do in any scan.
"""
from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import NamedTuple
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reqtrail.operators import merge
from reqtrail.operators.keyed import ColLike, hashed, last_per_key

FILE = "_file_path"
#: Snapshots of more rows are not broadcast to find the files they touch.
MANY = 1_000_000


class FileSet(NamedTuple):
    """One version of a table: its data files and its columns (a file may lack later ones: NULL)."""

    files: tuple[str, ...]
    schema: T.StructType

    def read(self, spark: SparkSession, files: Sequence[str] | None = None) -> DataFrame:
        files = self.files if files is None else files
        return spark.read.schema(self.schema).parquet(*files) if files else spark.createDataFrame([], self.schema)


class Rewrite(NamedTuple):
    """A merge to be written: files that stay, files that go, and the rows that take their place."""

    kept: tuple[str, ...]
    touched: tuple[str, ...]
    rows: DataFrame
    schema: T.StructType
    keys: tuple[str, ...]


def _uri(path: str) -> str:
    """One way to write a file's name: scans and listings write local ones as file:/ or file:///."""
    parts = urlparse(path)
    return f"file://{parts.path}" if parts.scheme in ("", "file") else path


def _listed(spark: SparkSession, path: str) -> list[str]:
    return [_uri(f) for f in spark.read.parquet(path).inputFiles()]


def files_under(spark: SparkSession, path: str) -> FileSet:
    """The version that consists of all files of a Parquet folder."""
    return FileSet(tuple(sorted(_listed(spark, path))), spark.read.parquet(path).schema)


def write_files(rewrite: Rewrite, path: str) -> FileSet:
    """Write the new rows as files of ``path``, ranges of the keys; the version is the kept files and these."""
    spark = rewrite.rows.sparkSession
    ranged = rewrite.rows.repartitionByRange(*rewrite.keys).sortWithinPartitions(*rewrite.keys)
    ranged.write.mode("errorifexists").parquet(path)
    return FileSet(tuple(sorted([*rewrite.kept, *_listed(spark, path)])), rewrite.schema)


def create(df: DataFrame, keys: Sequence[str], base: str, table: str) -> FileSet:
    """The first version of a table."""
    return write_files(Rewrite((), (), df, df.schema, tuple(keys)), f"{base.rstrip('/')}/{table}/v={uuid.uuid4().hex}")


def _extent(source: DataFrame, key: str) -> tuple:
    """The source's least and greatest key, and its number of rows."""
    return tuple(source.agg(F.min(key), F.max(key), F.count(F.lit(1))).first())


def _between(scan: DataFrame, key: str, low: object, high: object) -> DataFrame:
    if low is None:
        return scan.where(F.lit(False))
    return scan.where((F.col(key) >= F.lit(low)) & (F.col(key) <= F.lit(high)))


def _near(scan: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Only rows between the source's least and greatest key: a filter that Parquet statistics can answer."""
    return _between(scan, key, *_extent(source, key)[:2])


def _names(rows: DataFrame) -> set[str]:
    return {_uri(r[0]) for r in rows.select(FILE).distinct().toLocalIterator()}


def touched_by_keys(spark: SparkSession, table: FileSet, source: DataFrame, keys: Sequence[str]) -> set[str]:
    """Files with a row whose key the source has. The table's rows, each with its file's name, are not sorted to meet many keys."""
    if not table.files:
        return set()
    scan = table.read(spark).select(*keys, F.col("_metadata.file_path").alias(FILE))
    low, high, n = _extent(source, keys[0])
    return _names(_between(scan, keys[0], low, high).join(hashed(source.select(*keys), n > MANY), list(keys), "left_semi"))


def _rewrite(spark: SparkSession, table: FileSet, touched: set[str], rows: DataFrame, keys: Sequence[str]) -> Rewrite:
    if not touched <= set(table.files):
        raise RuntimeError(f"files that are not of this version: {sorted(touched - set(table.files))[:3]}")
    known = set(table.schema.fieldNames())
    schema = T.StructType([*table.schema.fields, *(f for f in rows.schema.fields if f.name not in known)])
    kept = tuple(f for f in table.files if f not in touched)
    return Rewrite(kept, tuple(f for f in table.files if f in touched), rows, schema, tuple(keys))


def _part(spark: SparkSession, table: FileSet, touched: set[str]) -> DataFrame:
    return table.read(spark, [f for f in table.files if f in touched])


def upsert(spark: SparkSession, table: FileSet, source: DataFrame, keys: Sequence[str], set_cols: Sequence[str]) -> Rewrite:
    """K1: as ``merge.upsert``. A key that no touched file holds is in no file, so it is inserted."""
    source = source.where(merge._not_null(keys))
    touched = touched_by_keys(spark, table, source, keys)
    return _rewrite(spark, table, touched, merge.upsert(_part(spark, table, touched), source, keys, set_cols), keys)


def update_only(spark: SparkSession, table: FileSet, source: DataFrame, keys: Sequence[str], set_cols: Sequence[str],
                order: Sequence[ColLike] | None = None) -> Rewrite:
    """K2: as ``merge.update_only``."""
    source = source.where(merge._not_null(keys))
    touched = touched_by_keys(spark, table, source, keys)
    return _rewrite(spark, table, touched, merge.update_only(_part(spark, table, touched), source, keys, set_cols, order), keys)


def replace_children(spark: SparkSession, table: FileSet, new_rows: DataFrame, keys: Sequence[str], parent: DataFrame | None = None,
                     dedup_fields: Sequence[str] | None = None, order: str | None = None) -> Rewrite:
    """K7 + K5/K6: as ``merge.replace_children``. Children of one key may lie in several files."""
    rows = new_rows.where(merge._not_null(keys))
    if parent is not None:
        rows = rows.join(parent.select(*keys), list(keys), "left_semi")
    touched = touched_by_keys(spark, table, rows, keys)
    merged = merge.replace_children(_part(spark, table, touched), rows, keys, dedup_fields=dedup_fields, order=order)
    return _rewrite(spark, table, touched, merged, keys)


def reset_and_set(spark: SparkSession, table: FileSet, source: DataFrame, keys: Sequence[str], col: str, order: Sequence[ColLike],
                  default: object = 0) -> Rewrite:
    """K8 + K2: as ``merge.reset_and_set``. Touched are files with a row whose value differs from its new one, so
    rows that hold the default already (P10) cost nothing, nor do those that the snapshot sets to what they are."""
    if col not in table.schema.fieldNames():
        touched = set(table.files)
    else:
        last = last_per_key(source.where(merge._not_null(keys)), keys, order, cols=[col])
        new = merge._prefixed(last, keys, [col], "_s_")
        scan = table.read(spark).select(*keys, col, F.col("_metadata.file_path").alias(FILE)) if table.files else None
        value = F.when(F.col(merge.SRC), F.col("_s_" + col)).otherwise(F.lit(default)).cast(table.schema[col].dataType)
        touched = _names(scan.join(new, list(keys), "left").where(~F.col(col).eqNullSafe(value))) if table.files else set()
    merged = merge.reset_and_set(_part(spark, table, touched), source, keys, col, order, default)
    return _rewrite(spark, table, touched, merged, keys)


__all__ = ["FileSet", "Rewrite", "files_under", "write_files", "create", "touched_by_keys", "upsert", "update_only",
           "replace_children", "reset_and_set"]
