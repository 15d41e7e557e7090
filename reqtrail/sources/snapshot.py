"""Dated report snapshots as DataFrames.

Layout: ``{base}/{dataset}/snapshot_date={date}/...`` so a date is a partition
folder and selecting one prunes every other date without listing its files.
"""
from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reqtrail.session import materialize

ORD = "_ord"


def snapshot_path(base: str, dataset: str, date: str | None = None) -> str:
    """The folder of one dataset, or of one dated snapshot of it."""
    root = f"{base.rstrip('/')}/{dataset}"
    return root if date is None else f"{root}/snapshot_date={date}"


def read_snapshot(spark: SparkSession, base: str, dataset: str, date: str, schema: T.StructType,
                  fmt: str = "parquet", skip_lines: int = 1, with_order: bool = True) -> DataFrame:
    """S1+S3: read one dated snapshot with a pinned schema (ids stay text, never inferred).

    Parquet/JSON carry their own order through ``_metadata``; ``_ord`` is then the
    (file, row) position. Delimited text may start with banner lines above the
    header; those are dropped and columns bound by name (see ``read_delimited``).
    """
    path = snapshot_path(base, dataset, date)
    if fmt == "csv":
        return read_delimited(spark, path, schema, skip_lines=skip_lines)
    df = spark.read.schema(schema).format(fmt).load(path)
    if with_order and fmt == "parquet":
        df = df.withColumn(ORD, F.struct(F.col("_metadata.file_path").alias("f"),
                                         F.col("_metadata.row_index").alias("r")))
    return df


def read_snapshots(spark: SparkSession, base: str, dataset: str, schema: T.StructType,
                   dates: list[str] | None = None) -> DataFrame:
    """S2 over the whole history: every ``snapshot_date=`` folder of a Parquet dataset.

    ``snapshot_date`` is a partition column, so ``dates`` (or any later filter on it)
    prunes the other folders at planning time (``PartitionFilters`` in the plan).
    """
    with_date = T.StructType(list(schema.fields) + [T.StructField("snapshot_date", T.StringType())])
    df = (spark.read.schema(with_date)
               .option("basePath", snapshot_path(base, dataset)).parquet(snapshot_path(base, dataset)))
    if dates is not None:
        df = df.where(F.col("snapshot_date").isin(list(dates)))
    return df.withColumn(ORD, F.struct(F.col("_metadata.file_path").alias("f"),
                                       F.col("_metadata.row_index").alias("r")))


MALFORMED = "_malformed"
LINE = ["_file", "_block"]


def _patterns(sep: str) -> dict[str, str]:
    """What a line or a row looks like, for one separator; quotes inside a quoted cell are doubled."""
    sep_, other = re.escape(sep), f"[^{re.escape(sep)}]*+"
    inside = '[^"]*+(?:""[^"]*+)*+'
    cell = f'(?:"{inside}"{other}|(?!"){other})'
    return {"opens": f'\\A(?:{cell}{sep_})*+"{inside}\\z',  # a line that begins a row and ends inside a quoted cell
            "stays": f'\\A{inside}(?:\\z|"{other}(?:{sep_}{cell})*+{sep_}"{inside}\\z)',  # one that begins and ends inside quoted cells
            "cells": f'{sep_}("{inside}"{other}|{other})', "quoted": f'(?s)\\A"({inside})"(.*)\\z'}


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(_file, _block, _line, _text): lines with their split and an id that rises inside it; a large file is read in many splits."""
    raw = spark.read.option("lineSep", "\n").text(path)
    return raw.select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                      F.monotonically_increasing_id().alias("_line"), F.col("value").alias("_text"))


def _composed(df: DataFrame, window, opens: str, stays: str, prefix: str) -> DataFrame:
    """Compose the rows before each one: ``{prefix}set`` is the state they leave whatever came first (NULL if they do not), and
    ``{prefix}flips`` whether else they turn it.

    A row maps (outside, inside a quoted cell) to (``opens``, ``stays``). Where both are equal it sets the state; else it turns it
    (opens) or leaves it (stays). So the state is the one set last, turned as often as rows since then turn it.
    """
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    turned = F.coalesce(F.sum((F.col(opens) & ~F.col(stays)).cast("long")).over(before), F.lit(0))
    df = df.withColumn("_turned", turned)
    last = F.last(F.when(F.col(opens) == F.col(stays), F.struct(F.col(opens).alias("state"), F.col("_turned").alias("at"))), ignorenulls=True).over(before)
    return df.withColumn("_last", last).withColumns({
        prefix + "set": F.col("_last.state") != ((F.col("_turned") - F.col("_last.at")) % 2 == 1), prefix + "flips": F.col("_turned") % 2 == 1,
    }).drop("_turned", "_last")


def _rows(lines: DataFrame, sep: str) -> DataFrame:
    """(_file, _block, _line, _text): rows from lines, where a quoted cell may hold line breaks.

    Whether a line begins a row depends on all lines of its file before it. Every split is scanned for both
    possible states at its start: each line is a map of two states, and composing the lines of a split gives the split's map.
    Composing these, one row for each split of a file, tells the state at each split's start, and so of each of its lines. Lines at the
    head of a split that go on with a row are joined to it; the row stays in the split where it begins.
    """
    p = _patterns(sep)
    in_split = Window.partitionBy(*LINE).orderBy("_line")
    scanned = lines.withColumns({"_opens": F.col("_text").rlike(p["opens"]), "_stays": F.col("_text").rlike(p["stays"])})
    scanned = _composed(scanned, in_split, "_opens", "_stays", "_")

    def after(start: bool):  # the state after a line of a split that begins in this state
        state = F.coalesce(F.col("_set"), F.col("_flips") != F.lit(start))
        return F.when(state, F.col("_stays")).otherwise(F.col("_opens"))

    in_file = Window.partitionBy("_file").orderBy("_block")
    splits = scanned.groupBy(*LINE).agg(F.max_by(F.struct(after(False).alias("opens"), after(True).alias("stays")), "_line").alias("m"))
    splits = _composed(splits.select(*LINE, F.col("m.opens").alias("_opens"), F.col("m.stays").alias("_stays")), in_file, "_opens", "_stays", "_")
    splits = splits.select(*LINE, F.coalesce(F.col("_set"), F.col("_flips")).alias("_inside"))  # a file begins outside

    known = scanned.join(splits, LINE).withColumn("_begins", ~F.coalesce(F.col("_set"), F.col("_flips") != F.col("_inside")))
    known = known.withColumn("_row", F.count_if("_begins").over(in_split.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    together = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_line", "_text"))), lambda x: x["_text"]), "\n")
    rows = known.groupBy(*LINE, "_row").agg(F.min("_line").alias("_line"), together.alias("_text"))

    # heads (row 0) belong to the last row of the nearest split before that has one
    ends = rows.groupBy(*LINE).agg(F.max("_row").alias("_rows"))
    owner = F.last(F.when(F.col("_rows") > 0, F.struct("_block", "_rows")), ignorenulls=True).over(in_file.rowsBetween(Window.unboundedPreceding, -1))
    heads = rows.where("_row = 0").join(ends.withColumn("_owner", owner).select(*LINE, "_owner"), LINE)
    heads = heads.groupBy("_file", F.col("_owner._block").alias("_block"), F.col("_owner._rows").alias("_row")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_line", "_text"))), lambda x: x["_text"]), "\n").alias("_rest"))
    whole = rows.where("_row > 0").join(heads, [*LINE, "_row"], "left")
    return whole.select(*LINE, "_line", F.concat_ws("\n", "_text", "_rest").alias("_text"))


def _cells(rows: DataFrame, sep: str) -> DataFrame:
    """(_file, _block, _line, _cells): as many cells as a row has; an empty cell is NULL, quoted or not."""
    p = _patterns(sep)

    def value(cell: Column) -> Column:
        quoted = F.concat(F.replace(F.regexp_extract(cell, p["quoted"], 1), F.lit('""'), F.lit('"')), F.regexp_extract(cell, p["quoted"], 2))
        return F.nullif(F.when(cell.rlike(p["quoted"]), quoted).otherwise(cell), F.lit(""))

    text = F.regexp_replace("_text", "\r\\z", "")
    rows = rows.withColumn("_text", text).where("_text <> ''")
    cells = F.regexp_extract_all(F.concat(F.lit(sep), F.col("_text")), F.lit(p["cells"]), F.lit(1))
    return rows.select(*LINE, "_line", F.transform(cells, value).alias("_cells"))


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, skip_lines: int = 1, sep: str = ",",
                   multi_line: bool = True, bind: str = "name") -> DataFrame:
    """S1 for delimited text: drop ``skip_lines`` banner rows, bind columns to the header row below.

    Every file has its own header, of any number of columns: ``bind="name"`` takes each field of ``schema`` from the column of
    that name, wherever it stands, and fails if a file has none; ``bind="position"`` takes them in order, for reports that repeat a column
    name. Cells are read as text and cast, so ids keep their zeros. Empty rows do not count.

    Large files are read in splits, by many tasks. With ``multi_line`` quoted cells may hold line breaks, also at the borders of splits
    (one shuffle of the lines by split); without, each line is a row. Splits have one small row each in the tables that are
    joined to place banner and header, by whatever plan Spark chooses for their size.

    ``_ord`` is the row order of the file. ``_malformed`` names the fields whose cell does not fit their type (their
    value is NULL), and "extra cells" for a row that is longer than its header; it is empty for good rows.
    """
    lines = _lines(spark, path)
    # rows of lines are written once: three steps read them, two of these by few columns
    rows = materialize(_cells(_rows(lines, sep), sep), "delimited-rows") if multi_line else _cells(lines, sep)
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = rows.groupBy(*LINE).agg(F.count(F.lit(1)).alias("_n"))
    splits = splits.select(*LINE, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    # only the first rows of a file need their number; tables of a few rows a file are written, so that Spark knows their size
    near = rows.join(materialize(splits.where(F.col("_base") <= skip_lines), "delimited-starts"), LINE)
    number = F.col("_base") + F.row_number().over(Window.partitionBy(*LINE).orderBy("_line")) - 1
    numbered = near.withColumn("_number", number).where(F.col("_number") <= skip_lines)
    headers = numbered.where(F.col("_number") == skip_lines).select(
        "_file", F.col("_block").alias("_header_block"), F.col("_line").alias("_header_line"), F.transform("_cells", lambda x: F.trim(x)).alias("_names"))
    headers = materialize(headers, "delimited-headers")
    after = (F.col("_block") > F.col("_header_block")) | ((F.col("_block") == F.col("_header_block")) & (F.col("_line") > F.col("_header_line")))
    body = rows.join(headers, "_file").where(after)

    columns = F.size(F.filter("_names", lambda x: x.isNotNull()))
    longer = F.slice("_cells", columns + 1, F.greatest(F.size("_cells"), F.lit(1)))
    values, misfits = [], [F.when(F.exists(longer, lambda x: x.isNotNull()), F.lit("extra cells"))]
    for i, field in enumerate(schema.fields):
        if bind == "name":
            at = F.array_position("_names", field.name)
            missing = F.raise_error(F.concat(F.lit(f"no column {field.name!r} in "), F.col("_file"))).cast("string")
            cell = F.when(at > 0, F.get("_cells", (at - 1).cast("int"))).otherwise(missing)
        else:
            cell = F.get("_cells", F.lit(i))
        value = cell.try_cast(field.dataType)
        values.append(value.alias(field.name))
        misfits.append(F.when(value.isNull() & (F.trim(cell) != ""), F.lit(field.name)))
    order = F.struct(F.col("_file").alias("f"), F.col("_block").alias("b"), F.col("_line").alias("r")).alias(ORD)
    return body.select(*values, order, F.filter(F.array(*misfits), lambda x: x.isNotNull()).alias(MALFORMED))


__all__ = ["snapshot_path", "read_snapshot", "read_snapshots", "read_delimited", "ORD", "MALFORMED"]
