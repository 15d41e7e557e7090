"""Column-name cleanup. Works on schema metadata only (driver side, no data)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

# The header rules of the report snapshots, as (character, replacement),
# applied in this order. Each dataset uses a subset (see reqtrail.schemas).
SPACE = (" ", "_")
SLASH = ("/", "_")
DASH = ("-", "_")
DROP_DOT = (".", "")
DROP_QUESTION = ("?", "")


def clean_name(name: str, rules: Sequence[tuple[str, str]]) -> str:
    for old, new in rules:
        name = name.replace(old, new)
    return name


def clean_headers(df: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Rename every column by applying ``rules`` in order."""
    return df.toDF(*[clean_name(c, rules) for c in df.columns])


def rename_positional(df: DataFrame, names: dict[int, str]) -> DataFrame:
    """Rename columns by position.

    Report headers can repeat (two ``Line`` columns). Spark and pandas number the
    duplicates differently, so a rename by name is a trap; by position it is exact.
    """
    cols = list(df.columns)
    for pos, new in names.items():
        cols[pos] = new
    return df.toDF(*cols)
