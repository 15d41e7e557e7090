"""Missing-value handling."""
from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: a missing due date becomes this timestamp.
DEFAULT_DUE = dt.datetime(2001, 1, 1, 0, 0, 0)


def is_missing(c: str | Column, numeric: bool = False) -> Column:
    """NULL, and for floating columns also NaN."""
    col = F.col(c) if isinstance(c, str) else c
    return (col.isNull() | F.isnan(col)) if numeric else col.isNull()


def text_or_empty(c: str | Column) -> Column:
    """P5/F9 for text: a missing value becomes ``""``. Dates stay NULL (decision D1)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col.cast("string"), F.lit(""))


def ts_literal(value: dt.datetime) -> Column:
    """a timestamp literal without zone.

    Built from text, so neither the Python process zone nor the session zone moves it.
    """
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def fill_timestamp(c: str, value: dt.datetime = DEFAULT_DUE) -> Column:
    """A missing timestamp becomes ``value``."""
    return F.coalesce(F.col(c), ts_literal(value)).alias(c)


def fill_columns(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Fill several columns at once; timestamps go through a typed literal."""
    cols = {}
    for name, value in values.items():
        if isinstance(value, dt.datetime):
            cols[name] = F.coalesce(F.col(name), ts_literal(value))
        else:
            cols[name] = F.coalesce(F.col(name), F.lit(value).cast(df.schema[name].dataType))
    return df.withColumns(cols)
