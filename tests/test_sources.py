from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.sql import types as T

from reqtrail.sources.snapshot import ORD, read_delimited, read_snapshot, snapshot_path


def test_snapshot_path():
    assert snapshot_path("/base/", "po-6", "01012020-000000") == "/base/po-6/snapshot_date=01012020-000000"
    assert snapshot_path("/base", "po-6") == "/base/po-6"


def test_delimited_banner_and_header_are_dropped(spark):
    d = tempfile.mkdtemp(prefix="reqtrail-src-")
    path = os.path.join(d, "report.csv")
    with open(path, "w") as f:
        f.write("Report banner, printed 2020-01-01\n")
        f.write("Req ID,Unit,Line,PO No.,Line\n")
        for i in range(500):
            f.write(f"000{i},A,{i % 7},P{i},{i % 3}\n")
    schema = T.StructType([T.StructField(n, T.StringType() if n in ("Req_ID", "Unit", "PO_No") else T.IntegerType())
                           for n in ["Req_ID", "Unit", "REQ_Line", "PO_No", "PO_Line"]])
    df = read_delimited(spark, path, schema, bind="position")   # the report repeats "Line"
    got = df.orderBy(ORD).collect()
    assert len(got) == 500
    assert got[0]["Req_ID"] == "0000" and got[-1]["Req_ID"] == "000499"   # text ids keep their zeros
    assert (got[3]["REQ_Line"], got[3]["PO_Line"]) == (3, 0)             # duplicate header by position


def test_parquet_snapshot_has_row_order(spark):
    base = tempfile.mkdtemp(prefix="reqtrail-pq-")
    path = snapshot_path(base, "po-6", "d1")
    spark.createDataFrame([(f"P{i}", i) for i in range(50)], "PO_No string, n int").coalesce(1) \
         .write.parquet(path)
    schema = T.StructType([T.StructField("PO_No", T.StringType()), T.StructField("n", T.IntegerType())])
    df = read_snapshot(spark, base, "po-6", "d1", schema)
    got = [r["n"] for r in df.orderBy(ORD).collect()]
    assert got == list(range(50))


def test_snapshot_history_prunes_dates(spark):
    from reqtrail.sources.snapshot import read_snapshots
    base = tempfile.mkdtemp(prefix="reqtrail-hist-")
    for d in ("2020-01-01", "2020-01-02", "2020-01-03"):
        spark.createDataFrame([(f"P-{d}", 1)], "PO_No string, n int").write.parquet(snapshot_path(base, "po", d))
    schema = T.StructType([T.StructField("PO_No", T.StringType()), T.StructField("n", T.IntegerType())])
    df = read_snapshots(spark, base, "po", schema, dates=["2020-01-02"])
    assert [r["PO_No"] for r in df.collect()] == ["P-2020-01-02"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan and "2020-01-02" in plan


def test_delimited_many_splits_and_files(spark):
    d = tempfile.mkdtemp(prefix="reqtrail-split-")
    expected = []
    for f in range(3):
        with open(os.path.join(d, f"part{f}.csv"), "w") as fh:
            fh.write("Banner line that must go\n")
            fh.write("Item,Qty\n")
            for i in range(400):
                item = f"{f:02d}{i:05d}"
                fh.write(f"{item},{i}\n")
                expected.append(item)
    schema = T.StructType([T.StructField("Item", T.StringType()), T.StructField("Qty", T.IntegerType())])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        df = read_delimited(spark, d, schema, multi_line=False)
        got = [r["Item"] for r in df.orderBy(ORD).collect()]
        n_parts = df.rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert n_parts > 3                        # every file really is split
    assert sorted(got) == sorted(expected)    # banner and header dropped, nothing else
    by_file = {}
    for item in got:
        by_file.setdefault(item[:2], []).append(item)
    assert all(v == sorted(v) for v in by_file.values())   # _ord keeps each file's line order


def text(tmp_path, name, *lines):
    (tmp_path / name).write_text("\n".join(lines) + "\n")


ITEM = T.StructType([T.StructField("Item", T.StringType()), T.StructField("Qty", T.IntegerType()), T.StructField("More Info", T.StringType())])


def test_cells_with_line_breaks_and_moved_columns(spark, tmp_path):
    """Each file binds by its own header; a quoted cell keeps its line breaks, quotes and separators."""
    text(tmp_path, "a.csv", "Banner", "Item,Qty,More Info", '0001,5,"first', 'second, ""third"""', "0002,6,plain")
    text(tmp_path, "b.csv", "Banner", "Other,More Info ,Item,Qty", "x,moved,0003,7")
    got = read_delimited(spark, str(tmp_path), ITEM).orderBy(ORD).collect()
    assert [(r["Item"], r["Qty"], r["More Info"]) for r in got] == [
        ("0001", 5, 'first\nsecond, "third"'), ("0002", 6, "plain"), ("0003", 7, "moved")]
    assert all(r["_malformed"] == [] for r in got)


def test_malformed_rows_are_reported(spark, tmp_path):
    text(tmp_path, "a.csv", "Banner", "Item,Qty,More Info", "0001,five,x", "0002,6,x,y,z", "0003", "0004, ,x")
    for multi_line in (True, False):
        got = {r["Item"]: (r["Qty"], r["_malformed"]) for r in read_delimited(spark, str(tmp_path), ITEM, multi_line=multi_line).collect()}
        assert got == {"0001": (None, ["Qty"]), "0002": (6, ["extra cells"]), "0003": (None, []), "0004": (None, [])}


def test_missing_column_is_an_error(spark, tmp_path):
    text(tmp_path, "a.csv", "Banner", "Item,Quantity,More Info", "0001,5,x")
    with pytest.raises(Exception, match="no column 'Qty'"):
        read_delimited(spark, str(tmp_path), ITEM).collect()


def test_many_files_without_a_forced_broadcast(spark, tmp_path, capsys):
    for i in range(40):
        text(tmp_path, f"{i:02d}.csv", "Banner", "Qty,Item,More Info" if i % 2 else "Item,Qty,More Info", f"{i},{i},x")
    df = read_delimited(spark, str(tmp_path), ITEM)
    assert sorted((int(r["Item"]), r["Qty"]) for r in df.collect()) == [(i, i) for i in range(40)]
    df.explain("extended")
    assert "ResolvedHint" not in capsys.readouterr().out


def test_delimited_snapshot_by_date(spark, tmp_path):
    folder = tmp_path / "po" / "snapshot_date=2020-01-01"
    folder.mkdir(parents=True)
    text(folder, "r.csv", "Banner", "Item,Qty,More Info", "0007,1,x")
    got = read_snapshot(spark, str(tmp_path), "po", "2020-01-01", ITEM, fmt="csv").first()
    assert (got["Item"], got["Qty"]) == ("0007", 1)


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def quoted(cell, always):
    if cell is None:
        return ""
    hard = always or cell == "" or cell[0] == '"' or any(x in cell for x in ",\n\r")
    return '"' + cell.replace('"', '""') + '"' if hard else cell


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_one_file_in_many_splits_equals_the_whole_file_reader(spark, tmp_path, small_splits, end):
    """Cells with breaks, quotes and separators fall on borders of splits; some are longer than several splits."""
    import random

    rnd = random.Random(7)
    parts = ["a", "bc", "\n", ",", '"', "x y", "\n\n", '",', ',"', "5\" pipe", "-" * 40]
    rows = []
    for i in range(250):
        cells = [None if rnd.random() < 0.1 else "".join(rnd.choice(parts) for _ in range(rnd.choice([0, 1, 3, 9]))) for _ in range(2)]
        cells.append("long\n" * 300 if i in (60, 61, 200) else "z")
        rows.append([f"{i:04d}", *cells])
    body = end.join(",".join(quoted(c, rnd.random() < 0.2) for c in r) for r in rows)
    (tmp_path / "r.csv").write_bytes(f"Printed by,server{end}Id,A,B,C{end}{body}{end}".encode())
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("Id", "A", "B", "C")])
    df = read_delimited(spark, str(tmp_path / "r.csv"), schema)
    got = [(r["Id"], r["A"], r["B"], r["C"]) for r in df.orderBy(ORD).collect()]
    assert got == [tuple(c or None for c in r) for r in rows] and all(r["_malformed"] == [] for r in df.collect())
    splits = df.select(f"{ORD}.b").distinct().count()
    assert splits > 20
    whole = spark.read.schema("Id string, A string, B string, C string").options(multiLine=True, quote='"', escape='"').csv(str(tmp_path / "r.csv"))
    assert [tuple(r) for r in whole.collect()][2:] == got


def test_any_number_of_columns(spark, tmp_path, small_splits):
    """The second file is wider than the first by more than any spare, whichever is read first."""
    text(tmp_path, "a.csv", "Banner", "Item,Qty,More Info", "0001,1,x")
    text(tmp_path, "b.csv", "Banner", ",".join([f"c{i}" for i in range(40)] + ["Qty", "More Info", "Item"]), ",".join([""] * 40 + ["2", '"a,b"', "0002"]),
         ",".join([""] * 40 + ["3", "y", "0003", "", "extra"]))
    got = {r["Item"]: (r["Qty"], r["More Info"], r["_malformed"]) for r in read_delimited(spark, str(tmp_path), ITEM).collect()}
    assert got == {"0001": (1, "x", []), "0002": (2, "a,b", []), "0003": (3, "y", ["extra cells"])}


def test_separators_in_quoted_headers_and_banners(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"Banner, of\ntwo lines"\n\n"Qty";"More, Info";Item\n1;"p;q";007\n'.replace('"More, Info"', '"More Info"'))
    got = read_delimited(spark, str(tmp_path), ITEM, sep=";").first()
    assert (got["Item"], got["Qty"], got["More Info"]) == ("007", 1, "p;q")
