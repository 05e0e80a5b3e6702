from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from panelspark.operators.asof import asof_join
from panelspark.plans import forecast


def brute(left, right):
    out = []
    for i, k, t in left:
        earlier = [(rt, (v is not None, v or 0, w is not None, w or 0), (v, w)) for rk, rt, v, w in right
                   if None not in (k, t, rk, rt) and rk == k and rt <= t]
        best = max((e[:2] for e in earlier), default=None)
        out.append((i, k, t, *next((e[2] for e in earlier if e[:2] == best), (None, None))))
    return sorted(out, key=str)


@pytest.mark.parametrize("width", [None, 1, 7, 10_000])
def test_against_every_pair(spark, width):
    r = random.Random(3)
    left = [(i, r.choice([1, 1, 1, 2, 3, None]), r.choice([None, *range(60)])) for i in range(300)]
    right = [(r.choice([1, 1, 2, 4, None]), r.choice([None, *range(10, 50)]), r.choice([None, 1, 2, 3]), r.choice([None, 5])) for _ in range(150)]
    a = spark.createDataFrame(left, "i long, k long, t long").repartition(4)
    b = spark.createDataFrame(right, "k long, t long, v long, w long").repartition(3)
    assert sorted(map(tuple, asof_join(a, b, ["k"], "t", ["v", "w"], width).collect()), key=str) == brute(left, right)


def test_dates_empty_sides_and_replaced_columns(spark):
    day = dt.date(2024, 1, 1)
    a = spark.createDataFrame([("x", day + dt.timedelta(days=i), -1.0) for i in range(5)], "k string, t date, v double")
    b = spark.createDataFrame([("x", day + dt.timedelta(days=2), 7.0)], "k string, t date, v double")
    assert [r.v for r in asof_join(a, b, ["k"], "t", ["v"]).orderBy("t").collect()] == [None, None, 7.0, 7.0, 7.0]
    assert asof_join(a.limit(0), b, ["k"], "t", ["v"]).collect() == []
    assert {r.v for r in asof_join(a, b.limit(0), ["k"], "t", ["v"]).collect()} == {None}
    with pytest.raises(ValueError):
        asof_join(a, b.withColumn("t", F.col("t").cast("timestamp")), ["k"], "t", ["v"])


def test_a_hot_entity_is_dealt_over_its_blocks(spark):
    a = spark.range(20_000).select(F.lit(1).alias("k"), F.col("id").alias("t"))
    plan = asof_join(a, a.withColumn("v", F.col("t")), ["k"], "t", ["v"], 500)
    assert plan.where("v <> t or v is null").count() == 0 and plan.count() == 20_000
    assert "CartesianProduct" not in plan._jdf.queryExecution().toString() and "NestedLoop" not in plan._jdf.queryExecution().toString()


def test_covariates_replace_constants(spark):
    entities = spark.createDataFrame([("Delhi", "Residential", "North"), ("Pune", "Residential", "North")], "location string, sector string, zone string")
    days = forecast.scaffold(entities, 3, dt.date(2024, 5, 1))
    seen = spark.createDataFrame([("Delhi", "2024-05-02", 41.5), ("Delhi", "2024-05-03", None)], "location string, date string, temperature double")
    got = forecast.with_covariates(days, seen, ["location"], ["temperature"])
    default = days.first().temperature
    assert got.columns == days.columns
    assert [(r.location, r.temperature) for r in got.orderBy("location", "date").collect()] == [
        ("Delhi", default), ("Delhi", 41.5), ("Delhi", default), *[("Pune", default)] * 3]
