"""Column rules on hand-written rows: nulls, ties and edges."""

import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from parcelflow import schemas
from parcelflow.functions import dates, numeric, text


def values(spark, rows, schema, column):
    df = spark.createDataFrame([(i, *(r if isinstance(r, tuple) else (r,))) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r[0] for r in df.orderBy("i").select(column.alias("out")).collect()]


def test_floor_bin(spark):
    got = values(spark, [None, "-", "NA", "G", "PODIUM", "0", "00", "1", "10", "11", "Floor 23", "xyz", " ", "Penthouse", "-1"], "c string", text.floor_bin(F.col("c")))
    below, unknown = "Below 1st Floor", "Unknown"
    assert got == [unknown, unknown, unknown, below, below, below, below, "1-10", "1-10", "11-20", "21-30", unknown, unknown, below, "1-10"]


def test_floor_value(spark):
    assert values(spark, [None, "", "  ", "G", "12A"], "c string", text.floor_value(F.col("c"))) == [0.0, 0.0, 0.0, 0.5, 12.0]


def test_rooms(spark):
    got = values(spark, ["2 bed rooms + hall", "1 Bed Room+Hall", "3 B/R + maid", "4", "Studio", None], "c string", text.rooms_normalised(F.col("c")))
    assert got == ["2 B/R", "1 B/R", "3 B/R", "4 B/R", "Studio", None]
    numbers = values(spark, ["1 B/R", "11 B/R", "Studio", "PENTHOUSE", "More than 3B/R", "7 B/R", "none", None], "c string", text.rooms_number(F.col("c")))
    assert numbers == [1, 11, 11, 621, 4, 7, None, None]
    assert values(spark, ["4 B/R", "10 B/R", "3 B/R", None], "c string", text.room_group(F.col("c"))) == ["More than 3B/R", "More than 3B/R", "3 B/R", None]


def test_developer_rules(spark):
    rule = text.developer_from_project(F.col("n"), F.col("p"))
    rows = [(None, "Damac Springs"), ("", "The SPRINGS"), ("Missing_developer_name_en", "none here"), ("Known", "Damac"), (None, None)]
    assert values(spark, rows, "n string, p string", rule) == ["DAMAC Properties", "Emaar Properties", "Missing_developer_name_en", "Known", None]


def test_link_key(spark):
    key = text.link_key(*(F.col(c) for c in "abcde"))
    rows = [(None, 5, None, None, 70.9), ("3.0", 5, 9, " Studio ", -1.5)]
    assert values(spark, rows, "a string, b int, c bigint, d string, e double", key) == ["0-5-0--70", "3-5-9-Studio--1"]


def test_geo_tag_matches_whole_words(spark):
    tag = text.geo_tag(F.col("t"), F.col("s"), F.col("src"))["country"]
    rows = [("A woman in Dubai", None, "x"), ("a woman", "", "x"), ("In Oman.", "", "x"), ("news", "", "Khaleej Times"), ("Saudi and Kuwait", "", "x"), (None, None, None)]
    assert values(spark, rows, "t string, s string, src string", tag) == ["UAE", "Global", "Oman", "UAE", "Saudi Arabia", "Global"]


def test_list_cell(spark):
    got = values(spark, ["['A', 'B']", "[]", "plain", None, " ['x'] "], "c string", text.list_cell(F.col("c")))
    assert got == [["A", "B"], [], ["plain"], [], ["x"]]


def test_norm_id(spark):
    assert values(spark, [" 12.0 ", "12", "p1", "1.05", None], "c string", text.norm_id(F.col("c"))) == ["12", "12", "p1", "1.05", None]


def test_dates(spark):
    rows = ["Mon, 01 Jan 2024 01:30:00 +0400", "Mon, 01 Jan 2024 23:30:00 GMT", "1 Jan 2024 23:30:00 -0400", "not a date", None]
    assert values(spark, rows, "c string", dates.rfc822_date(F.col("c"))) == [date(2023, 12, 31), date(2024, 1, 1), date(2024, 1, 2), None, None]
    assert values(spark, ["2024-02-30", "2024-02-29", "x", None], "c string", dates.to_date_or_null(F.col("c"))) == [None, date(2024, 2, 29), None, None]
    diff = dates.month_diff(F.col("a"), F.col("b"))
    assert values(spark, [(date(2024, 3, 1), date(2023, 12, 31)), (date(2023, 12, 1), date(2024, 1, 1))], "a date, b date", diff) == [3, -1]


def test_strength(spark):
    got = values(spark, [(0.1, 0.1, 0.1), (2.0, 2.0, 2.0), (None, 1.0, 1.0)], "a double, b double, c double", numeric.strength(*map(F.col, "abc")))
    assert got == [0.2, 1.5, 0.5]


def test_decay_curves(spark):
    t, h, p = F.col("t"), F.lit(3.0), F.lit(4.0)
    assert values(spark, [0], "t int", numeric.sentiment_decay(t, h)) == [1.0]
    start, peak = values(spark, [0, 4], "t int", numeric.price_hump(t, h, p))
    assert start == 0.0 and math.isclose(peak, 1.0, rel_tol=1e-6)


def test_clamp_collapses_empty_interval(spark):
    got = values(spark, [(200.0, 45.0, 60.0), (10.0, 80.0, 60.0), (70.0, 45.0, 90.0)], "v double, lo double, hi double", numeric.clamp(*map(F.col, ["v", "lo", "hi"])))
    assert got == [60.0, 60.0, 70.0]


def test_nan_reads_as_missing(spark):
    assert values(spark, ["NaN", "1.5", "x", None], "c string", numeric.number(F.col("c"))) == [None, 1.5, None, None]


def test_conform_and_require(spark):
    df = spark.createDataFrame([("7", float("nan"))], "a string, b double")
    out = schemas.conform(df, "a int, b double, c date")
    assert out.dtypes == [("a", "int"), ("b", "double"), ("c", "date")]
    assert tuple(out.first()) == (7, None, None)
    with pytest.raises(ValueError, match="missing columns"):
        schemas.require(df, ["a", "z"])
