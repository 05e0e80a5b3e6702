"""Typed scans."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.runtime import materialize

WEATHER_PAYLOAD = ("daily struct<time: array<string>, temperature_2m_max: array<double>, "
                   "relative_humidity_2m_max: array<double>, weathercode: array<int>>")

REPORT = ("model string, dataset string, total_rows bigint, train_rows bigint, test_rows bigint, "
          "hyperparameters map<string,string>, "
          "metrics struct<rmse: double, mae: double, r2: double, mape: double>")


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None,
             infer: bool = False) -> DataFrame:
    """Headered CSV. With a schema the file is read once; ``infer`` costs a pass over it."""
    reader = spark.read.option("header", True)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer).csv(path)


class Checked(NamedTuple):
    """``good``: rows that fit the schema; ``bad``: line and reason of the others; ``counts``: rows per reason, ``good`` among them."""

    good: DataFrame
    bad: DataFrame
    counts: DataFrame


def read_csv_checked(spark: SparkSession, path: str | list[str], schema: T.StructType | str, bad_path: str | None = None,
                     header: bool = True) -> Checked:
    """CSV, one record a line, headered unless ``header`` is off; lines that do not fit ``schema`` go to a table of their own, none is lost or nulled.

    The reason is ``columns`` where the number of fields differs, else the first column whose text has no value of its type.
    The files are read once, and the split rows written to the shared folder; ``bad_path`` also receives the bad lines as
    JSON. An empty field is null and no fault.
    """
    kind = spark.createDataFrame([], schema).schema if isinstance(schema, str) else schema
    line = "_line"
    whole = T.StructType([*kind.fields, T.StructField(line, T.StringType())])
    read = materialize(spark.read.option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", line)
                       .schema(whole).csv(path), "checked")
    texts = F.from_csv(F.col(line), ", ".join(f"`{f.name}` string" for f in kind.fields))
    fields = F.length(F.regexp_replace(line, '"([^"]|"")*"|[^,]', "")) + 1
    reason = F.when(fields != len(kind.fields), F.lit("columns"))
    for f in kind.fields:
        text = texts[f.name]
        reason = reason.when(text.isNotNull() & text.try_cast(f.dataType).isNull(), F.lit(f.name))
    bad = read.where(F.col(line).isNotNull()).select(F.col(line).alias("line"), reason.otherwise(F.lit("other")).alias("reason"))
    bad = materialize(bad, "bad_lines")
    if bad_path is not None:
        bad.write.json(bad_path)
    good = read.where(F.col(line).isNull()).drop(line)
    counts = good.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit("good").alias("reason"), "row_count").unionByName(
        bad.groupBy("reason").agg(F.count(F.lit(1)).alias("row_count")))
    return Checked(good, bad, counts)


def read_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


def read_weather(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Saved weather responses: one JSON object per line with ``location`` and ``daily``."""
    return weather_rows(spark.read.schema(f"location string, population bigint, {WEATHER_PAYLOAD}").json(path))


def weather_rows(payloads: DataFrame, payload: str | None = None) -> DataFrame:
    """Parallel daily arrays to one row per day, other columns repeated.

    ``payload`` names a column with JSON text; without it the table has a ``daily`` struct.
    """
    if payload is not None:
        parsed = F.from_json(payload, WEATHER_PAYLOAD)
        payloads = payloads.withColumn("daily", parsed["daily"]).drop(payload)
    rest = [c for c in payloads.columns if c != "daily"]
    days = F.arrays_zip(
        F.col("daily.time").alias("date"),
        F.col("daily.temperature_2m_max").alias("temperature"),
        F.col("daily.relative_humidity_2m_max").alias("humidity"),
        F.col("daily.weathercode").alias("weather_code"))
    return payloads.select(*rest, F.inline(days).alias("date", "temperature", "humidity", "weather_code"))


def read_metrics(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Saved evaluation reports: model and its metrics."""
    reports = spark.read.schema(REPORT).option("multiLine", True).json(paths)
    return reports.select("model", "metrics.*")
