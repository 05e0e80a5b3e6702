"""Equal-width histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.operators.quantiles import describe
from panelspark.runtime import attach


def adaptive_bins(n: Column | int) -> Column:
    """Bin count of the forecast histogram: half the rows, at least 5, at most 20."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.least(F.lit(20), F.greatest(F.lit(5), F.floor(n / F.lit(2)))).cast("int")


def histogram(df: DataFrame, values: list[str], bins: int | None = 50,
              by: list[str] | None = None) -> DataFrame:
    """Counts per equal-width bin, one set of edges per column (and group), empty bins included.

    Bins are closed on the left, the last one on both sides. ``bins=None`` picks the count
    from the number of values. A column with one distinct value is widened by half a unit on
    both sides, as plotting libraries do. An infinity is an error. Returns by..., variable, bin (from 1), bin_low,
    bin_high, count.
    """
    by = list(by or [])
    keys = [*by, "variable"]
    long = (df.select(*by, *[F.col(c).cast("double").alias(c) for c in values])
            .unpivot(by, values, "variable", "_v").where(F.col("_v").isNotNull() & ~F.isnan("_v")))
    if by:
        long = long.dropna(subset=by)
    long = long.withColumn("_v", F.when(F.abs("_v") == float("inf"), F.raise_error(
        F.lit("no equal-width bins hold an infinity"))).otherwise(F.col("_v")))
    edges = long.groupBy(keys).agg(
        F.min("_v").alias("_a"), F.max("_v").alias("_b"),
        (F.lit(bins) if bins else adaptive_bins(F.count(F.lit(1)))).alias("_n"))
    flat = F.col("_a") == F.col("_b")
    edges = edges.select(*keys, "_n",
                         F.when(flat, F.col("_a") - 0.5).otherwise(F.col("_a")).alias("lo"),
                         F.when(flat, F.col("_b") + 0.5).otherwise(F.col("_b")).alias("hi"))
    n = F.col("_n")
    data = attach(long, edges, keys, "inner")
    # the bucket of hi itself is n + 1
    slot = F.least(F.width_bucket("_v", F.col("lo"), F.col("hi"), n.cast("bigint")), n.cast("bigint"))
    counts = (data.groupBy(*keys, "lo", "hi", "_n", slot.alias("_slot")).agg(F.count(F.lit(1)).alias("_c"))
              .groupBy(*keys, "lo", "hi", "_n")
              .agg(F.map_from_entries(F.collect_list(F.struct("_slot", "_c"))).alias("_at")))
    width = (F.col("hi") - F.col("lo")) / n
    return (counts.withColumn("bin", F.explode(F.sequence(F.lit(1), n)))
            .select(*keys, "bin",
                    (F.col("lo") + (F.col("bin") - 1) * width).alias("bin_low"),
                    F.when(F.col("bin") == n, F.col("hi")).otherwise(F.col("lo") + F.col("bin") * width).alias("bin_high"),
                    F.coalesce(F.try_element_at("_at", F.col("bin").cast("bigint")), F.lit(0).cast("bigint")).alias("count")))


def centre_lines(df: DataFrame, values: list[str], by: list[str] | None = None,
                 accuracy: int | None = None) -> DataFrame:
    """Mean and median per column: the vertical lines drawn over a histogram."""
    stats = describe(df, values, by, None, accuracy)
    return stats.select(*(by or []), "variable", "mean", F.col("p50").alias("median"))
