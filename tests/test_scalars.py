from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelspark.functions import fixed_values as fv
from panelspark.functions import hashing as H
from panelspark.functions import scalars as S
from panelspark.operators import project
from panelspark.sources import dimensions


def column(spark, values, expr, typ="double"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_parse_date(spark):
    got = column(spark, ["31-12-2023", "2023-12-31", "2023-02-30", "", None, "2023-1-5", "x"], S.parse_date("v"), "string")
    assert got == [dt.date(2023, 12, 31), dt.date(2023, 12, 31), None, None, None, None, None]


def test_calendar(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 6),), (dt.date(2024, 2, 29),)], "d date")
    got = [tuple(r) for r in df.select(*S.calendar_features("d").values()).collect()]
    assert got == [(2024, 1, 1, 0, 0), (2024, 1, 6, 5, 1), (2024, 2, 29, 3, 0)]


def test_seasons(spark):
    months = [*range(1, 13), None]
    labels = column(spark, months, S.season("v"), "int")
    codes = column(spark, months, S.season_code("v"), "int")
    assert labels == ["Winter"] * 2 + ["Summer"] * 3 + ["Rainy"] * 4 + ["Post-Monsoon"] * 2 + ["Winter", None]
    assert codes == [3, 3, 2, 2, 2, 1, 1, 1, 1, 0, 0, 3, None]
    assert column(spark, months + [13], S.month_name("v"), "int")[::4] == ["Jan", "May", "Sep", None]


def test_cast_bad_text_is_null(spark):
    df = spark.createDataFrame([("12",), ("12.5",), ("abc",), (None,)], "v string")
    d = df.select(F.col("v").alias("a"), F.col("v").alias("b"))
    got = [tuple(r) for r in project.cast(d, {"a": "double", "b": "int"}).collect()]
    assert got == [(12.0, 12), (12.5, 12), (None, None), (None, None)]


def test_clip(spark):
    assert column(spark, [1.0, 2.0, 3.0, 4.0, 5.0, None], S.clip("v", 2, 4)) == [2.0, 2.0, 3.0, 4.0, 4.0, None]


def test_clip_is_idempotent(spark):
    once = S.clip("v", 2, 4)
    values = [-5.0, 2.0, 3.3, 99.0, None]
    assert column(spark, values, once) == column(spark, values, S.clip(once, 2, 4))


def test_round(spark):
    assert column(spark, [0.125, 2.675, -2.5], S.round_to("v", 2)) == [0.13, 2.68, -2.5]
    assert column(spark, [0.125, 2.5, -2.5], S.round_to("v", 0, half_even=True)) == [0.0, 2.0, -2.0]


def test_repair_capped(spark):
    c = S.repair_capped("v", 1000.0, F.lit(900.0))
    values = [1000.0, 999.99, 1000.01, None]
    assert column(spark, values, c["value"]) == [900.0, 999.99, 1000.01, None]
    assert column(spark, values, c["was_capped"]) == [True, False, False, False]


def test_alert_level(spark):
    got = column(spark, [650.0, 650.01, 800.0, 800.01, None], S.alert_level("v"))
    assert got == ["Normal", "Moderate", "Moderate", "High", None]


def test_weather_label(spark):
    got = column(spark, [0, 45, 82, 99, 12, None], S.weather_label("v"), "int")
    assert got == ["Clear", "Fog", "Heavy Rain", "Thunderstorm", "Clear", "Clear"]


def test_encode_decode(spark):
    cities = dimensions.city_names()
    back = column(spark, cities, S.decode(S.encode("v", cities), cities), "string")
    assert back == cities
    assert column(spark, ["Delhi", "Atlantis", None], S.encode("v", cities, "null"), "string") == [5, None, None]
    assert column(spark, ["Delhi", "Atlantis"], S.encode("v", cities, "zero"), "string") == [5, 0]
    with pytest.raises(Exception, match="no code for value: Atlantis"):
        column(spark, ["Atlantis"], S.encode("v", cities), "string")


def test_documented_codes():
    assert cities_sorted() and dimensions.sector_names() == ["Commercial", "Healthcare", "Industrial", "Residential"]
    assert dimensions.zone_names() == ["Central", "East", "North", "South", "West"]
    assert sorted(fv.SEASON_CODES, key=fv.SEASON_CODES.get) == sorted(fv.SEASON_CODES)


def cities_sorted():
    names = dimensions.city_names()
    return names == sorted(names) and len(names) == 18


def test_safe_ratio(spark):
    assert column(spark, [8.0, 0.0, None], S.safe_ratio(F.lit(1.0), F.col("v"), 2)) == [0.13, None, None]


def test_hash_numbers(spark):
    d = spark.range(20_000).select(H.row_hash(["id"], 1).alias("h")).select(
        H.uniform(F.col("h")).alias("u"), H.normal(F.col("h")).alias("z"))
    r = d.agg(F.min("u"), F.max("u"), F.avg("u"), F.avg("z"), F.stddev("z")).first()
    assert 0 <= r[0] < 0.01 and 0.99 < r[1] < 1
    assert abs(r[2] - 0.5) < 0.01 and abs(r[3]) < 0.03 and abs(r[4] - 1) < 0.02


def test_projection_helpers(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a_b int, c string")
    assert project.prettify(df).columns == ["A B", "C"]
    assert project.drop_nulls(df).count() == 1
    assert [tuple(r) for r in project.fill(df, {"c": "z"}).collect()] == [(1, "z"), (2, "x")]
    assert project.with_constants(df, {"k": 5}).columns == ["a_b", "c", "k"]
    with pytest.raises(Exception):
        project.keep(df, ["missing"]).collect()
