"""Golden micro-fixtures for the column builders (FIXTURES §3)."""

import datetime as dt
import math

from pyspark.sql import functions as F

from footfall.functions import calendar as cal
from footfall.functions import numeric as num
from footfall.functions import text


def test_id_parts(spark):
    df = spark.createDataFrame([("air_00a106_2017-05-31",)], "id string")
    r = df.select(text.id_store("id").alias("s"), text.id_date_text("id").alias("d")).first()
    assert (r.s, r.d) == ("air_00a106", "2017-05-31")


def test_week_of_month(spark):
    days = [1, 7, 8, 14, 15, 28, 29, 31]
    df = spark.createDataFrame([(dt.date(2017, 1, d),) for d in days], "d date")
    got = [r.w for r in df.select(cal.week_of_month("d").alias("w")).collect()]
    assert got == [1, 1, 2, 2, 3, 4, 5, 5]


def test_day_of_week_monday_zero(spark):
    df = spark.createDataFrame([(dt.date(2017, 1, 1),), (dt.date(2017, 1, 2),)], "d date")
    assert [r.w for r in df.select(cal.day_of_week("d").alias("w")).collect()] == [6, 0]


def test_tokens_and_replace(spark):
    df = spark.createDataFrame([("a b",), ("x/y z",), (None,)], "g string")
    norm = text.replace_char("g", "/", " ")
    out = df.select(*[c.alias(f"t{i}") for i, c in enumerate(text.tokens(norm, 3))]).collect()
    assert [tuple(r) for r in out] == [("a", "b", ""), ("x", "y", "z"), ("nan", "", "")]


def test_threshold_flag(spark):
    df = spark.createDataFrame([(None,), (119,), (120,)], "v long")
    assert [r.f for r in df.select(num.threshold_flag("v", 120).alias("f")).collect()] == [0.0, 0.0, 1.0]


def test_clip_negative_keeps_null(spark):
    df = spark.createDataFrame([(-1.5,), (0.0,), (2.0,), (None,)], "v double")
    assert [r.c for r in df.select(num.clip_negative("v").alias("c")).collect()] == [0.0, 0.0, 2.0, None]


def test_fill_missing_numeric_only(spark):
    df = spark.createDataFrame([(float("nan"), None, None, None, None)],
                               "a double, b double, c int, s string, d date")
    r = num.fill_missing(df).first()
    assert (r.a, r.b, r.c, r.s, r.d) == (-1.0, -1.0, -1, None, None)


def test_round_half_even(spark):
    df = spark.createDataFrame([(2.25,), (2.35,), (0.25,)], "v double")
    assert [r.r for r in df.select(num.round_display("v", 1).alias("r")).collect()] == [2.2, 2.4, 0.2]


def test_log_of_zero_is_null(spark):
    df = spark.createDataFrame([(0,), (10,)], "v long")
    got = [r.l for r in df.select(num.log_value("v").alias("l")).collect()]
    assert got[0] is None and math.isclose(got[1], math.log(10))


def test_date_int(spark):
    df = spark.createDataFrame([(dt.date(2017, 5, 31),)], "d date")
    assert df.select(cal.date_int("d").alias("i")).first().i == 20170531
