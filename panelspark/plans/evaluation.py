"""Regression metrics, model comparison and residual data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.operators import sampling

METRICS = ["rmse", "mae", "r2", "mape"]
HIGHER_IS_BETTER = {"r2"}


def metrics(scored: DataFrame, by: list[str] | None = None, actual: str = "actual",
            predicted: str = "predicted") -> DataFrame:
    """rmse, mae, r2, mape (percent) and n in one aggregate.

    Rows with a null are skipped; rows with actual 0 do not enter mape; r2 of a constant
    target is null.
    """
    y, p = F.col(actual), F.col(predicted)
    e = y - p
    used = scored.where(y.isNotNull() & p.isNotNull())
    return used.groupBy(*(by or [])).agg(
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        (F.lit(1.0) - F.try_divide(F.sum(e * e), F.count(F.lit(1)) * F.var_pop(y))).alias("r2"),
        (F.avg(F.abs(F.try_divide(e, y))) * 100).alias("mape"),
        F.count(F.lit(1)).alias("n"))


def compare_models(table: DataFrame, models: list[str]) -> DataFrame:
    """metric x model with the best model per metric.

    ``table`` has one row per model: model and the four metrics. On a tie the model that
    comes first in ``models`` wins. The table is read once.
    """
    order = F.array_position(F.array(*[F.lit(m) for m in models]), F.col("model"))
    long = (table.select("model", order.alias("ord"), *METRICS)
            .unpivot(["model", "ord"], METRICS, "metric", "value"))
    signed = F.when(F.col("metric").isin(*HIGHER_IS_BETTER), -F.col("value")).otherwise(F.col("value"))
    place = F.when(F.col("value").isNotNull(), F.struct(signed.alias("v"), "ord"))
    return long.groupBy("metric").agg(
        *[F.max(F.when(F.col("model") == m, F.col("value"))).alias(m) for m in models],
        F.min_by("model", place).alias("best"))


def residual_sample(scored: DataFrame, key: list[str], n: int = 8_000, seed: int = 42) -> DataFrame:
    """Sample of (actual, predicted, residual, abs_residual) with a +-RMSE band flag."""
    e = F.col("actual") - F.col("predicted")
    rmse = metrics(scored).select("rmse").scalar()
    return (sampling.sample_rows(scored, n, key, seed)
            .select(*key, "actual", "predicted", e.alias("residual"), F.abs(e).alias("abs_residual"))
            .withColumn("in_band", F.col("abs_residual") <= rmse))
