"""Correlation matrices and least-squares lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MOMENTS = "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double, odd double"


def _partial_moments(k: int):
    """Per task: counts, sums and cross-products of every column pair, rows with a null skipped
    pair by pair, and how many of a pair's rows hold an infinity. Leaves k(k+1)/2 rows per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, ss, p, odd = (np.zeros((k, k)) for _ in range(5))
        for b in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns]).astype(float)
            ok = ~np.isnan(x)
            m = ok.astype(float)
            wild = np.isinf(x)
            x = np.where(ok & ~wild, x, 0.0)
            n += m.T @ m
            s += x.T @ m          # s[i, j]: sum of column i over rows where j is present
            ss += (x * x).T @ m
            p += x.T @ x
            odd += wild.astype(float).T @ m + m.T @ wild
        i, j = np.tril_indices(k)
        cols = [i.astype("int32"), j.astype("int32"), n[i, j], s[i, j], s[j, i], ss[i, j], ss[j, i], p[i, j], odd[i, j]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols],
                                         names=["i", "j", "n", "sx", "sy", "sxx", "syy", "sxy", "odd"])

    return run


def pair_moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """Centred sums of every column pair (lower triangle with diagonal) in one pass.

    Columns are shifted by their mean first (a scalar subquery), so that sums of squares do
    not cancel. The arithmetic per row is a matrix product inside the task, which for k
    columns replaces k(k+1)/2 separate aggregate functions.
    """
    cols = [F.col(c).cast("double").alias(c) for c in columns]
    data = df.select(*cols)
    means = data.agg(F.struct(*[F.avg(F.when(F.abs(c) < float("inf"), F.col(c))).alias(c) for c in columns])).scalar()
    shifted = (data.withColumn("_m", means)
               .select(*[(F.col(c) - F.coalesce(F.col(f"_m.{c}"), F.lit(0.0))).alias(c) for c in columns]))
    parts = shifted.mapInArrow(_partial_moments(len(columns)), _MOMENTS)
    return parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy", "odd")])


def correlation_matrix(df: DataFrame, columns: list[str], triangle: bool = False,
                       undefined: float | None = None) -> DataFrame:
    """Pearson r of all column pairs, long form (x, y, r), pairwise complete rows.

    triangle: only pairs below the diagonal. ``undefined`` replaces r where it is not defined: for
    constant columns, pairs with an infinity in their common rows, and squares beyond a double.
    """
    names = F.array(*[F.lit(c) for c in columns])
    n = F.col("n")
    vx, vy = (F.greatest(F.col(a) - F.try_divide(F.col(b) * F.col(b), n), F.lit(0.0))
              for a, b in (("sxx", "sx"), ("syy", "sy")))
    cov = F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), n)
    # a column that is constant up to rounding has no correlation
    floor = F.lit(1e-24)
    flat = (F.col("odd") > 0) | (n < 2) | (vx <= floor * F.col("sxx")) | (vy <= floor * F.col("syy"))
    r = F.when(~flat, F.try_divide(cov, F.sqrt(vx) * F.sqrt(vy)))
    # least(1, NaN) is 1 in Spark, so NaN has to go first
    r = F.nanvl(r, F.lit(None).cast("double"))
    r = F.greatest(F.lit(-1.0), F.when(r.isNotNull(), F.least(F.lit(1.0), r)))
    r = F.when(~flat, F.when((F.col("i") == F.col("j")) & r.isNotNull(), F.lit(1.0)).otherwise(r))
    if undefined is not None:
        r = F.coalesce(r, F.lit(undefined))
    half = pair_moments(df, columns).select(
        "i", "j", r.alias("r"),
        F.element_at(names, F.col("i") + 1).alias("x"), F.element_at(names, F.col("j") + 1).alias("y"))
    if triangle:
        return half.where("i > j").select("x", "y", "r")
    # mirror the triangle; the diagonal comes once
    return half.select(F.explode(F.when(F.col("i") == F.col("j"), F.array(F.struct("x", "y"))).otherwise(
        F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y"))))).alias("p"),
        "r").select("p.x", "p.y", "r")


def pearson(df: DataFrame, x: str, y: str, by: list[str] | None = None) -> DataFrame:
    """Correlation of two columns; null (not an error) when one is constant."""
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    both = F.when(a.isNotNull() & b.isNotNull(), F.struct(a.alias("a"), b.alias("b")))
    data = df.select(*(by or []), both.alias("p")).where("p is not null")
    r = F.try_divide(F.covar_samp("p.a", "p.b"), F.stddev_samp("p.a") * F.stddev_samp("p.b"))
    return data.groupBy(*(by or [])).agg(r.alias("r"))


def target_correlations(df: DataFrame, target: str, features: list[str],
                        by: list[str] | None = None) -> DataFrame:
    """Matrix over the target and the non-constant features, NaN replaced by 0, long form.

    Constant features are left out; the target always stays, also when it is constant.
    """
    by = list(by or [])
    cols = [target, *features]
    num = {c: F.col(c).cast("double") for c in cols}
    aggs = [F.stddev_samp(num[c]).alias(f"s{i}") for i, c in enumerate(cols)]
    pairs = [(i, j) for i in range(len(cols)) for j in range(i)]
    aggs += [F.covar_samp(num[cols[i]], num[cols[j]]).alias(f"c{i}_{j}") for i, j in pairs]
    wide = df.groupBy(*by).agg(*aggs)

    def cell(i, j):
        a, b = max(i, j), min(i, j)
        r = (F.when(F.col(f"s{i}") > 0, F.lit(1.0)) if i == j
             else F.try_divide(F.col(f"c{a}_{b}"), F.col(f"s{a}") * F.col(f"s{b}")))
        kept = F.lit(True)
        for k in {i, j} - {0}:
            kept = kept & (F.coalesce(F.col(f"s{k}"), F.lit(0.0)) > 0)
        return F.struct(F.lit(cols[i]).alias("x"), F.lit(cols[j]).alias("y"),
                        F.coalesce(r, F.lit(0.0)).alias("r"), kept.alias("kept"))

    cells = F.array(*[cell(i, j) for i in range(len(cols)) for j in range(len(cols))])
    return (wide.select(*by, F.explode(cells).alias("c")).where("c.kept")
            .select(*by, "c.x", "c.y", "c.r"))


def fit_line(df: DataFrame, x: str, y: str, by: list[str] | None = None) -> DataFrame:
    """Least-squares slope and intercept with the x range, over rows where both are present."""
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    data = df.select(*(by or []), a.alias("_x"), b.alias("_y")).where("_x is not null and _y is not null")
    return data.groupBy(*(by or [])).agg(
        F.regr_slope("_y", "_x").alias("slope"), F.regr_intercept("_y", "_x").alias("intercept"),
        F.min("_x").alias("x_min"), F.max("_x").alias("x_max"), F.count(F.lit(1)).alias("n"))


def line_points(fit: DataFrame, points: int, by: list[str] | None = None) -> DataFrame:
    """Evenly spaced points of a fitted line, ends included."""
    i = F.col("i")
    x = F.when(i == points - 1, F.col("x_max")).otherwise(
        F.col("x_min") + i * (F.col("x_max") - F.col("x_min")) / F.lit(float(max(points - 1, 1))))
    return (fit.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
            .select(*(by or []), "i", x.alias("x"), "slope", "intercept")
            .select(*(by or []), "i", "x", (F.col("slope") * F.col("x") + F.col("intercept")).alias("y")))
