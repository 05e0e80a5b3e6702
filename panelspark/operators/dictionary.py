"""A label dictionary that lasts: codes never move, new labels are appended as a new version.

The dictionary is a folder with one Parquet partition per version, each the whole table (value, code, since). It holds one
row per label, however many rows are encoded.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.operators.ranking import rank_rows
from panelspark.runtime import attach, materialize

POLICIES = ("error", "minus_one", "zero", "null")


def versions(spark: SparkSession, path: str) -> list[int]:
    """Versions in the folder, oldest first."""
    try:
        files = spark.read.parquet(path).inputFiles()  # a version without labels has a file too
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return []
        raise
    return sorted({int(v) for f in files for v in re.findall(r"/version=(\d+)/", f)})


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """value, code, since (the version that added the label) of a version, by default the latest."""
    have = versions(spark, path)
    version = (have[-1] if have else None) if version is None else version
    if version not in have:
        raise ValueError(f"no version {version} of the dictionary at {path}")
    return spark.read.parquet(f"{path}/version={version}")


def update(df: DataFrame, column: str, path: str) -> int:
    """Add the labels of ``df`` that the dictionary lacks, in binary order after the highest code; returns the version.

    Null is no label. Without new labels no version is written, but the first one is always. A version that another writer
    has begun is an error, not overwritten.
    """
    spark = df.sparkSession
    have = versions(spark, path)
    labels = df.select(F.col(column).cast("string").alias("value")).where("value is not null").distinct()
    if not have:
        known, version, first = spark.createDataFrame([], "value string, code int, since int"), 1, 0
    else:
        known, version = read(spark, path, have[-1]), have[-1] + 1
        first = known.agg(F.coalesce(F.max("code") + 1, F.lit(0))).first()[0]
    fresh = materialize(rank_rows(labels.join(known, "value", "left_anti"), [F.col("value")], "_rank").select(
        "value", (F.col("_rank") - 1 + first).cast("int").alias("code"), F.lit(version).alias("since")), "labels")
    if have and fresh.isEmpty():
        return have[-1]
    known.unionByName(fresh).write.mode("errorifexists").parquet(f"{path}/version={version}")
    return version


def encode(df: DataFrame, column: str, path: str, version: int | None = None, name: str | None = None, on_unknown: str = "error") -> DataFrame:
    """``df`` with the code of ``column`` in ``name`` (default: ``<column>_enc``), by a version of the dictionary.

    ``on_unknown`` is for labels the version lacks: ``error`` fails when such a row is computed, ``minus_one`` and ``zero`` give
    that code, ``null`` none. A null label gives -1, as elsewhere.
    """
    if on_unknown not in POLICIES:
        raise ValueError(f"on_unknown: one of {', '.join(POLICIES)}")
    name = name or f"{column}_enc"
    side = read(df.sparkSession, path, version).select(F.col("value").alias("_value"), F.col("code").alias("_code"))
    unknown: Column = {"error": F.raise_error(F.concat(F.lit("label not in the dictionary: "), F.col(column).cast("string"))).cast("int"),
                       "minus_one": F.lit(-1), "zero": F.lit(0), "null": F.lit(None).cast("int")}[on_unknown]
    keyed = attach(df.withColumn("_value", F.col(column).cast("string")), side, ["_value"], stored=True)
    code = F.when(F.col("_value").isNull(), F.lit(-1)).when(F.col("_code").isNull(), unknown).otherwise(F.col("_code"))
    return keyed.withColumn(name, code).select(*[c for c in df.columns if c != name], name)
