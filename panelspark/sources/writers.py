"""Sinks. Every table is written by the executors; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.sources.readers import REPORT


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_periods(df: DataFrame, path: str, by: list[str]) -> None:
    """Parquet with one folder per period; only the periods that ``df`` holds are replaced, so a rerun changes nothing.

    Rows of a period are brought together first, a hot one in several parts, so that files stay few.
    """
    df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def write_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int, path: str) -> DataFrame:
    """A table dealt and sorted by ``keys`` once, so that later joins and groupings on them need no shuffle.

    Tables meant to meet must share keys and ``buckets``; choose it so that a bucket fits a task. An existing table is an error.
    """
    (df.repartition(buckets, *keys).write.mode("errorifexists").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))
    return df.sparkSession.table(table)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON record per line; null fields are kept."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def report(metrics: DataFrame, model: str, dataset: str, counts: DataFrame,
           hyperparameters: dict | None = None) -> DataFrame:
    """One-row evaluation report.

    ``metrics`` has one row rmse, mae, r2, mape; ``counts`` one row total_rows, train_rows,
    test_rows. Metrics are rounded to 4 digits.
    """
    params = {k: str(v) for k, v in (hyperparameters or {}).items()}
    pairs = [F.lit(x) for kv in params.items() for x in kv]
    hyper = (F.create_map(*pairs) if pairs else F.create_map()).cast("map<string,string>")
    m = metrics.select(F.struct(*[F.round(c, 4).alias(c) for c in ("rmse", "mae", "r2", "mape")])).scalar()
    return counts.select(
        F.lit(model).alias("model"), F.lit(dataset).alias("dataset"),
        "total_rows", "train_rows", "test_rows", hyper.alias("hyperparameters"), m.alias("metrics"))


def save_report(rep: DataFrame, path: str) -> None:
    rep.coalesce(1).write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REPORT).json(path)


def save_predictions(scored: DataFrame, path: str, actual: str = "actual", predicted: str = "predicted") -> None:
    write_csv(scored.select(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")), path)


def save_importance(importance: DataFrame, path: str) -> None:
    write_csv(importance.coalesce(1), path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Load a fitted pipeline; a missing path raises FileNotFoundError."""
    from py4j.protocol import Py4JJavaError
    try:
        return PipelineModel.load(path)
    except Exception as e:
        text = str(e.java_exception) if isinstance(e, Py4JJavaError) else str(e)
        if "does not exist" in text or "InvalidInput" in text or "PATH_NOT_FOUND" in text:
            raise FileNotFoundError(f"no fitted model at {path}") from e
        raise
