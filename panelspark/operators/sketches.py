"""Quantile sketches that are kept by group and day and merged for any period.

A KLL sketch holds some ``3 * k`` values, however many rows it has seen, and is built with partial sketches on the map side;
sketches merge into one of the same error. Daily sketches, stored by period, answer quantiles of a month or of a
larger group without another look at the rows. For exact quantiles see ``panelspark.operators.quantiles``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 400


def rank_error(k: int = K) -> float:
    """Share of the rows by which the rank of an answer may differ, with 99 % confidence."""
    return 2.446 / k ** 0.9433


def sketch(df: DataFrame, by: list[str], value: str, k: int = K) -> DataFrame:
    """``by``... and ``sketch``. Nulls and NaN do not count; a group without any value has no row; a null in ``by`` is a group."""
    x = F.col(value).cast("double")
    return df.where(x.isNotNull() & ~F.isnan(x)).groupBy(*by).agg(F.kll_sketch_agg_double(x, F.lit(k)).alias("sketch"))


def merge(sketches: DataFrame, by: list[str], k: int = K) -> DataFrame:
    """Sketches of coarser groups, or of a period once its days are selected."""
    return sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def quantiles(sketches: DataFrame, by: list[str], shares: list[float]) -> DataFrame:
    """``by``..., ``n`` (rows seen), ``share`` and ``quantile``: a value of the rows whose rank is about ``share``."""
    asked = F.array(*map(F.lit, shares))
    told = F.arrays_zip(asked.alias("share"), F.kll_sketch_get_quantile_double("sketch", asked).alias("quantile"))
    return sketches.select(*by, F.kll_sketch_get_n_double("sketch").alias("n"), F.inline(told).alias("share", "quantile"))


def ranks(sketches: DataFrame, by: list[str], values: list[float]) -> DataFrame:
    """``by``..., ``n``, ``value`` and ``rank``: about which share of the rows is not above the value."""
    asked = F.array(*map(F.lit, values))
    told = F.arrays_zip(asked.alias("value"), F.kll_sketch_get_rank_double("sketch", asked).alias("rank"))
    return sketches.select(*by, F.kll_sketch_get_n_double("sketch").alias("n"), F.inline(told).alias("value", "rank"))
