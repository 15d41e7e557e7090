"""Helpers that several operators of this subpackage share."""
from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reqtrail.session import materialize, scratch_table_path  # noqa: F401  (re-exported)

#: A word, as every contract of this subpackage defines it: Java regular expression.
WORD = r"[^\x20\x09-\x0D]+"
#: The same as a DataFrame expression needs it for splitting.
BLANKS = r"[\x20\x09-\x0D]+"

#: Rows that a Python worker turns into objects at once; texts of any length stay whole.
SLICE_ROWS = 512
SLICE_BYTES = 3_000_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def words(text: Column) -> Column:
    """The words of a text in order; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, as a URI; nothing is written yet. It goes with the job's scope."""
    return scratch_table_path(spark, name)


def mounted_path(uri: str) -> str:
    """The path of a ``file:`` URI (or plain path) of a shared file system that every worker mounts.

    Files that workers memory-map need such a mount; any other scheme is an error.
    """
    parts = urlparse(uri)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"{uri}: this operator memory-maps its files, so spark.checkpoint.dir must be a mounted "
                         "file system that driver and executors share")
    return unquote(parts.path)


def write_once(path: str, write: Callable) -> None:
    """Write a file under a private name and rename it: a repeated task replaces it by the same bytes."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with open(part, "wb") as out:
        write(out)
    os.replace(part, path)


def slices(batches: Iterator[pa.RecordBatch], text: int | None = None, rows: int = SLICE_ROWS, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches in pieces of at most so many rows and, by the sizes of column ``text``, so many bytes, or one row."""
    for batch in batches:
        if text is None:
            ends = np.arange(1, batch.num_rows + 1) * 0
        else:
            ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = min(start + rows, max(start + 1, int(np.searchsorted(ends, before + size, "right"))))
            yield batch.slice(start, stop - start)
            start = stop


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def offsets_of(lengths) -> np.ndarray:
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def whole_row(docs: DataFrame) -> Column:
    """All columns of a table as one, so that none of their names can clash."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns))


def numbered(docs: DataFrame) -> DataFrame:
    """(_row, _carried): every row with an identity that stays the same however often the table is read.

    For a table read from files that is its place in them; any other is written to the shared folder first.
    """
    place = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    try:
        return docs.select(place.alias("_row"), whole_row(docs).alias("_carried"))
    except AnalysisException:  # not a file source, or not one that numbers its rows
        rows = docs.select(F.struct(F.lit(0).cast("long").alias("file"), F.monotonically_increasing_id().alias("row")).alias("_row"),
                           whole_row(docs).alias("_carried"))
        return materialize(rows, "numbered-rows")


def schema(fields: str, carried: T.DataType | None = None) -> T.StructType:
    """A schema from its text, and a column ``_carried`` of the given type."""
    out = T.StructType([T.StructField(name, T._parse_datatype_string(kind)) for name, kind in (f.split(" ", 1) for f in fields.split(", "))])
    return out.add("_carried", carried) if carried is not None else out


def running_total(df: DataFrame, order: str, value: str, out: str, block: int = 4096) -> DataFrame:
    """Add the sum of ``value`` over all rows with a smaller ``order``, numbered 0, 1, 2, ...

    Two levels: sums inside blocks of consecutive numbers, then over block totals, so that no task
    gets more than ``block`` rows of the first level; the second has a row per block.
    """
    from pyspark.sql import Window as W

    df = df.withColumn("_block", F.floor(F.col(order) / block))
    before = W.partitionBy("_block").orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    top = W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    totals = df.groupBy("_block").agg(F.sum(value).alias("_total")).select(
        "_block", F.coalesce(F.sum("_total").over(top), F.lit(0)).alias("_base"))
    return (df.withColumn("_inside", F.coalesce(F.sum(value).over(before), F.lit(0)))
            .join(totals, "_block").withColumn(out, F.col("_base") + F.col("_inside"))
            .drop("_block", "_base", "_inside"))
