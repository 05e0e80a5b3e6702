"""The data behind every chart of the exploration reports, as small tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions import fixed_values as fv
from panelspark.functions import scalars as S
from panelspark.operators import correlation, histogram, quantiles, sampling, summary
from panelspark.runtime import materialize
from panelspark.sources import dimensions


def exploration(ml: DataFrame, sample_key: list[str] | None = None, target: str = fv.TARGET) -> dict[str, DataFrame]:
    """Describe, histograms with centre lines, correlation triangle, trend line, box plot."""
    labelled = ml.withColumn("sector_label", S.decode("sector_enc", dimensions.sector_names()))
    fit = correlation.fit_line(ml, "temperature", target)
    # one row per column, shared by two tables
    stats = materialize(quantiles.describe(ml, fv.HIST_COLUMNS, digits=None), "describe")
    shown = [c for c, t in stats.dtypes if t == "double"]
    tables = {
        "describe": stats.withColumns({c: F.round(c, 2) for c in shown}),
        "histograms": histogram.histogram(ml, fv.HIST_COLUMNS, 50),
        "centre_lines": stats.select("variable", "mean", F.col("p50").alias("median")),
        "correlation": correlation.correlation_matrix(ml, fv.EDA_CORR_COLUMNS, triangle=True),
        "temperature_r": correlation.pearson(ml, "temperature", target),
        "temperature_fit": fit,
        "temperature_line": correlation.line_points(fit, 200),
        "sector_boxes": ordered_boxes(labelled, "sector_label", target, fv.SECTOR_BOX_ORDER),
    }
    if sample_key:
        tables["temperature_sample"] = sampling.sample_rows(ml, 10_000, sample_key)
    return tables


def ordered_boxes(df: DataFrame, category: str, value: str, order: list[str]) -> DataFrame:
    """Box statistics with the fixed category order as a position column."""
    boxes = quantiles.box_stats(df, [category], value)
    place = F.array_position(F.array(*[F.lit(c) for c in order]), F.col(category))
    return boxes.withColumn("position", place).where("position > 0").orderBy("position")


def overview_cities(cleaned: DataFrame, target: str = fv.TARGET) -> DataFrame:
    """Mean of the target per city next to its population."""
    return summary.entity_summary(cleaned, ["location"], target, ["population"], "avg_waste")


def overview(cleaned: DataFrame, target: str = fv.TARGET) -> dict[str, DataFrame]:
    """Sector and month means, city means against population with a line, correlation triangle."""
    cities = overview_cities(cleaned, target)
    millions = cities.withColumn("population_millions", F.col("population") / F.lit(1e6))
    city_fit = correlation.fit_line(millions, "population_millions", "avg_waste")
    months = summary.month_mean(cleaned, "month", target, "avg_waste")
    return {
        "sector_means": summary.group_mean(cleaned, ["sector"], target, "avg_waste"),
        "month_means": months,
        "peak_month": summary.extreme_rows(months, "avg_waste", "month", ["month", "month_name", "avg_waste"]),
        "city_means": cities,
        "city_fit": city_fit,
        "city_line": correlation.line_points(city_fit, 100),
        "correlation": correlation.correlation_matrix(cleaned, fv.VIZ_CORR_COLUMNS, triangle=True),
    }
