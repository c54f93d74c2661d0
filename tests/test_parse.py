from pyspark.sql import functions as F

from cdrmill.functions.parse import (date_from_name, duration_seconds, parse_fixed_width,
                                     parse_yyyymmdd)
from cdrmill.schema import CDR_COLUMNS, CDR_LINE_WIDTH
from conftest import cdr_line


def test_layout_is_418_wide_with_21_fields():
    assert CDR_LINE_WIDTH == 418
    assert len(CDR_COLUMNS) == 21


def test_parse_full_short_and_empty_lines(spark):
    full = cdr_line(incoming_node="ND1", anum="9100", user_data_3="tail")
    df = spark.createDataFrame([(full,), (full[:30],), ("",)], "value string")
    rows = parse_fixed_width(df).collect()
    assert rows[0]["incoming_node"] == "ND1" and rows[0]["anum"] == "9100"
    assert rows[0]["user_data_3"] == "tail" and rows[0]["bnum"] is None
    assert rows[1]["incoming_node"] == "ND1" and rows[1]["anum"] is None  # short line
    assert all(rows[2][c] is None for c in CDR_COLUMNS)  # empty line


def test_spaces_only_field_is_null(spark):
    df = spark.createDataFrame([(" " * 418,)], "value string")
    assert parse_fixed_width(df).first()["incoming_node"] is None


def test_duration_seconds(spark):
    df = spark.createDataFrame([("NULL",), ("",), ("00AB0000",), ("00005400",), (None,)], "d string")
    got = [r[0] for r in df.select(duration_seconds("d")).collect()]
    assert got == [None, None, None, 3240, None]


def test_bad_date_gives_null_not_error(spark):
    df = spark.createDataFrame([("20241301",), ("20240701",), ("x",)], "d string")
    got = [r[0] for r in df.select(parse_yyyymmdd("d").cast("string")).collect()]
    assert got == [None, "2024-07-01", None]


def test_date_from_name(spark):
    df = spark.createDataFrame([("MED0.20240701155048.cdr",), ("nodate.cdr",),
                                ("A_20240705_x.csv",)], "n string")
    rx = [r[0] for r in df.select(date_from_name("n")).collect()]
    sp = [r[0] for r in df.select(date_from_name(F.col("n"), "split")).collect()]
    assert rx == ["20240701", None, "20240705"]
    assert sp[2] == "20240705"
