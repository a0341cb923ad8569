"""Which lines each profile keeps, and how it names basket and item."""

import pytest
from pyspark.sql import functions as F

from basketry.operators.clean import clean_lines, kept_lines
from basketry.sources.files import read_lines

# InvoiceNo, StockCode, Quantity, Description -> kept by A, B, C as (basket, item)
CASES = [
    ("1,X,6,d", ("1", "X"), ("1", "X"), ("1", "d")),
    ("C2,X,-1,d", None, None, None),
    ("C2,X,1,d", None, None, ("C2", "d")),
    ("c3,X,1,d", ("c3", "X"), ("c3", "X"), ("c3", "d")),
    ('" C4",X,1,d', (" C4", "X"), None, (" C4", "d")),
    ('5," X ",1,d', ("5", " X "), ("5", "X"), ("5", "d")),
    ('5,"\u00a0X\u2003",1,d', ("5", "\u00a0X\u2003"), ("5", "X"), ("5", "d")),
    ('5,"   ",1,d', ("5", "   "), None, ("5", "d")),
    ("6,,1,d", None, None, ("6", "d")),
    ("7,X,,d", ("7", "X"), None, None),
    ("8,X,0,d", None, None, None),
    ("9,X,abc,d", None, None, None),
    ("9,X,NaN,d", None, None, None),
    ("9,X,3d,d", None, None, None),
    ("10,X,0.5,d", ("10", "X"), ("10", "X"), ("10", "d")),
    (",X,1,d", None, None, None),
    ("11,X,1,", ("11", "X"), ("11", "X"), None),
    ("12,NA,1,NA", ("12", "NA"), ("12", "NA"), ("12", "NA")),
]


@pytest.mark.parametrize("profile,position", [("A", 1), ("B", 2), ("C", 3)])
def test_edge_lines(spark, tmp_path, profile, position):
    header = "InvoiceNo,StockCode,Quantity,Description"
    merged = None
    for number, case in enumerate(CASES):
        path = tmp_path / f"{number:02}.csv"
        path.write_text(f"{header}\n{case[0]}\n", encoding="utf-8")
        lines = read_lines(spark, str(path), columns=header.split(","))
        kept = clean_lines(lines, profile).withColumn("case", F.lit(number))
        merged = kept if merged is None else merged.unionByName(kept)
    got = {r["case"]: (r["basket_id"], r["item"]) for r in merged.collect()}
    assert got == {n: case[position] for n, case in enumerate(CASES) if case[position]}


def test_missing_invoice_as_nan_basket(spark):
    lines = spark.createDataFrame(
        [(None, "X", "1"), ("1", "X", "1")], "InvoiceNo string, StockCode string, Quantity string"
    )
    rows = clean_lines(lines, "B", null_basket="nan").collect()
    assert sorted(r["basket_id"] for r in rows) == ["1", "nan"]


def test_numeric_quantity_column(spark):
    lines = spark.createDataFrame(
        [("1", "X", 2.0), ("2", "X", None), ("3", "X", -1.0), ("4", "X", float("nan"))],
        "InvoiceNo string, StockCode string, Quantity double",
    )
    assert [r["basket_id"] for r in clean_lines(lines, "A").collect()] == ["1", "2"]
    assert [r["basket_id"] for r in clean_lines(lines, "B").collect()] == ["1"]


def test_kept_lines_are_the_raw_rows(spark):
    lines = spark.createDataFrame(
        [("1", " X ", "2", 7), ("1", None, "2", 8), ("C1", "X", "1", 9)],
        "InvoiceNo string, StockCode string, Quantity string, extra int",
    )
    assert [tuple(r) for r in kept_lines(lines, "B").collect()] == [("1", " X ", "2", 7)]


def test_unknown_profile_and_missing_columns(spark):
    lines = spark.createDataFrame([("1",)], "InvoiceNo string")
    with pytest.raises(ValueError, match="unknown profile"):
        clean_lines(lines, "D")
    with pytest.raises(ValueError, match="lacks Quantity, StockCode"):
        clean_lines(lines, "A")


def test_cleaning_is_one_scan_without_shuffle(spark, tmp_path):
    lines = spark.createDataFrame(
        [("1", "X", 2.0, "d")], "InvoiceNo string, StockCode string, Quantity double, Description string"
    )
    lines.write.parquet(str(tmp_path / "lines"))
    plan = clean_lines(spark.read.parquet(str(tmp_path / "lines")), "A")._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Description" not in plan.split("ReadSchema")[-1]
