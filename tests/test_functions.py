from __future__ import annotations

from conftest import ts
from pyspark.sql import functions as F

from reqtrail.functions import headers as H
from reqtrail.functions.nulls import fill_columns, fill_timestamp, is_missing, text_or_empty
from reqtrail.functions.text import decode, fmt, matches_from_start, strip_ws


def test_clean_headers(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["PO No.", "Dept/Loc", "Nbr-Lines", "Hold?"])
    assert H.clean_headers(df, [H.SPACE, H.SLASH, H.DROP_DOT]).columns == ["PO_No", "Dept_Loc", "Nbr-Lines", "Hold?"]
    assert H.clean_headers(df, [H.SPACE, H.DASH, H.DROP_QUESTION]).columns == ["PO_No.", "Dept/Loc", "Nbr_Lines",
                                                                               "Hold"]


def test_rename_positional_duplicate_header(spark):
    df = spark.createDataFrame([("r", "u", 3, "p", 5)], ["Req ID", "Unit", "Line", "PO No.", "Line"])
    out = H.rename_positional(df, {2: "REQ_Line", 4: "PO_Line"})
    r = out.first()
    assert (r["REQ_Line"], r["PO_Line"]) == (3, 5)


def test_strip_keeps_text_ids(spark):
    df = spark.createDataFrame([(" 0007\t",), ("\n12 \r",), (None,)], "v string")
    assert [r[0] for r in df.select(strip_ws("v")).collect()] == ["0007", "12", None]


def test_internal_regex(spark):
    vals = ["procurement x", "Central PROCUREMENT", "Budget", "a\nProcurement", None]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    assert [r[0] for r in df.select(matches_from_start("v")).collect()] == [True, True, False, False, False]


def test_decode_passthrough(spark):
    df = spark.createDataFrame([(c,) for c in ["I", "A", "D", "Z", None]], "c string")
    assert [r[0] for r in df.select(decode("c")).collect()] == ["Initiated", "Approved", "Denied", "Z", None]


def test_fmt_null_is_empty(spark):
    df = spark.createDataFrame([("x", 1), (None, 2)], "a string, b long")
    assert [r[0] for r in df.select(fmt("by ", F.col("a"), " #", F.col("b"))).collect()] == ["by x #1", "by  #2"]


def test_null_defaults(spark):
    df = spark.createDataFrame([(None, None, None, float("nan")), (ts(2020, 1, 1), "x", "y", 1.0)],
                               "d timestamp_ntz, t string, a string, q double")
    out = fill_columns(df, {"a": "n/a"}).select(fill_timestamp("d"), text_or_empty("t").alias("t"), "a",
                                                  is_missing("q", numeric=True).alias("m")).collect()
    assert out[0]["d"] == ts(2001, 1, 1) and out[0]["t"] == "" and out[0]["a"] == "n/a" and out[0]["m"] is True
    assert out[1]["d"] == ts(2020, 1, 1) and out[1]["t"] == "x" and out[1]["a"] == "y" and out[1]["m"] is False
