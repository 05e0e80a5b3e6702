"""Literal dimension tables. Their size is fixed, so each carries a broadcast hint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.functions import fixed_values as fv


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return F.broadcast(spark.createDataFrame(rows, schema))


def city(spark: SparkSession) -> DataFrame:
    rows = [(*r[:5], r[5], i) for i, r in enumerate(fv.CITIES)]
    return literal_table(spark, rows, "location string, lat double, lon double, population bigint, "
                                      "area_km2 int, aqi_base int, location_enc int")


def sector_weight(spark: SparkSession) -> DataFrame:
    return literal_table(spark, list(fv.SECTOR_WEIGHTS.items()), "sector string, weight int")


def zone_modifier(spark: SparkSession) -> DataFrame:
    return literal_table(spark, list(fv.ZONE_MODIFIERS.items()), "zone string, modifier double")


def season(spark: SparkSession) -> DataFrame:
    rows = [(m, label, fv.SEASON_CODES[label]) for label, months in fv.SEASON_MONTHS.items() for m in months]
    return literal_table(spark, rows, "month int, season string, season_enc int")


def weather_code(spark: SparkSession) -> DataFrame:
    return literal_table(spark, list(fv.WMO_LABELS.items()), "code int, label string")


def city_names() -> list[str]:
    return [r[0] for r in fv.CITIES]


def sector_names() -> list[str]:
    return sorted(fv.SECTOR_WEIGHTS)


def zone_names() -> list[str]:
    return sorted(fv.ZONE_MODIFIERS)
