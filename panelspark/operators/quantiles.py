"""Exact quantiles without gathering a group in one task.

The built-in ``percentile`` keeps every distinct value of a group in one buffer, so it is used
only when the largest group was counted and is small. Otherwise the wanted ranks are located by counting: the value range of a group is cut in equal cells, rows
are counted per cell (a small, map-side combined aggregate), and only the cells that hold a
wanted rank are looked at again - cut further while they are large, sorted once small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.runtime import attach, materialize

# Groups up to this size may use the built-in percentile.
SMALL_GROUP_ROWS = 2_000_000
CELLS = 16_384
# A located cell with more rows than this is cut again before it is sorted.
SORT_ROW_LIMIT = 1_000_000


def _long(df: DataFrame, values: list[str], by: list[str], missing: bool = False) -> DataFrame:
    """by..., variable, _v: numbers without null group keys; ``missing`` keeps nulls (and NaN as null)."""
    out = df.select(*by, *[F.col(c).cast("double").alias(c) for c in values])
    if by:
        out = out.dropna(subset=by)
    out = out.unpivot(by, values, "variable", "_v")
    if missing:
        out = out.withColumn("_v", F.nanvl("_v", F.lit(None).cast("double")))
    else:
        out = out.where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    return out.withColumn("_v", F.col("_v") + F.lit(0.0))  # -0.0 and 0.0 are one value


def _groups_are_small(df: DataFrame, long: DataFrame, keys: list[str], small_group: int) -> bool:
    """Whether no group exceeds ``small_group`` values; the row count alone often tells."""
    if df.count() <= small_group:
        return True
    return (long.groupBy(keys).count().agg(F.max("count")).first()[0] or 0) <= small_group


def _percentiles(probs: list[float]):
    return F.percentile("_v", F.array(*[F.lit(float(p)) for p in probs]))


def _held(ranks: str, before, upto):
    """Those ranks (zero-based) that fall in [before, upto)."""
    return F.filter(ranks, lambda r: (r >= before) & (r < upto))


def _narrow(long: DataFrame, spans: DataFrame, keys: list[str]) -> DataFrame:
    """Cut each span in equal cells and keep the cells that hold wanted ranks.

    A span is (keys, lo, hi, before, ranks): values in [lo, hi], rows below lo, wanted ranks.
    """
    inside = (attach(long, spans, keys, "inner", stored=True)
              .where(F.col("_v").between(F.col("lo"), F.col("hi"))))
    part = F.try_divide(F.col("_v") - F.col("lo"), F.col("hi") - F.col("lo")) * CELLS
    cell = F.when(F.col("hi") - F.col("lo") < float("inf"), F.floor(part)).otherwise(
        # one end is infinite, or the range overflows: split by sign and finiteness
        F.when(F.col("_v") == float("-inf"), 0).when(F.col("_v") < 0, 1)
        .when(F.col("_v") < float("inf"), 2).otherwise(3))
    counts = (inside.withColumn("_cell", F.coalesce(cell, F.lit(0)).cast("int"))
              .groupBy(*keys, "lo", "before", "ranks", "_cell")
              .agg(F.count(F.lit(1)).alias("rows"), F.min("_v").alias("_min"), F.max("_v").alias("_max")))
    run = Window.partitionBy(*keys, "lo").orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("before") + F.sum("rows").over(run)
    return (counts.withColumn("_upto", upto)
            .withColumn("before", F.col("_upto") - F.col("rows"))
            .withColumn("ranks", _held("ranks", F.col("before"), F.col("_upto")))
            .where(F.size("ranks") > 0)
            .select(*keys, F.col("_min").alias("lo"), F.col("_max").alias("hi"), "before", "rows", "ranks"))


def exact_quantiles(df: DataFrame, values: list[str], probs: list[float],
                    by: list[str] | None = None, small_group: int = SMALL_GROUP_ROWS) -> DataFrame:
    """Linearly interpolated quantiles per group and column.

    Returns ``by..., variable, n, q`` where ``q`` is an array in the order of ``probs``;
    nulls and NaN are skipped, rows with a null group key are dropped. ``n`` counts the
    values used. A (group, column) without values has no row.
    """
    by = list(by or [])
    keys = [*by, "variable"]
    long = _long(df, values, by)
    if _groups_are_small(df, long, keys, small_group):
        return long.groupBy(keys).agg(F.count(F.lit(1)).alias("n"), _percentiles(probs).alias("q"))

    def position(p):
        return (F.col("n") - 1) * F.lit(float(p))

    def rank(p, up):
        return (F.ceil(position(p)) if up else F.floor(position(p))).cast("bigint")

    ranks = F.array_distinct(F.array(*[rank(p, up) for p in probs for up in (False, True)]))
    sizes = materialize(long.groupBy(keys).agg(
        F.count(F.lit(1)).alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi")), "sizes")
    spans = sizes.select(*keys, "lo", "hi", F.lit(0).cast("bigint").alias("before"), ranks.alias("ranks"))
    done = None

    while True:
        spans = materialize(_narrow(long, spans, keys), "spans")
        n_spans, largest = spans.where("lo < hi").agg(F.count(F.lit(1)), F.max("rows")).first()
        if largest is None or largest <= SORT_ROW_LIMIT:
            break
        done = spans.where("lo = hi") if done is None else done.unionByName(spans.where("lo = hi"))
        spans = spans.where("lo < hi")

    closed = spans.where("lo = hi")
    if done is not None:
        closed = closed.unionByName(done)
    found = closed.select(*keys, F.explode("ranks").alias("_r"), F.col("lo").alias("_v"))
    if n_spans:
        open_spans = spans.where("lo < hi").select(*keys, "lo", "hi", "before", "ranks")
        rows = (attach(long, open_spans, keys, "inner", stored=True)
                .where(F.col("_v").between(F.col("lo"), F.col("hi")))
                .groupBy(*keys, "lo", "before", "ranks", "_v").agg(F.count(F.lit(1)).alias("_c")))
        run = Window.partitionBy(*keys, "lo").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
        found = found.unionByName(
            rows.withColumn("_upto", F.col("before") + F.sum("_c").over(run))
            .select(*keys, F.explode(_held("ranks", F.col("_upto") - F.col("_c"), F.col("_upto"))).alias("_r"), "_v"))

    at = found.groupBy(keys).agg(F.map_from_entries(F.collect_list(F.struct("_r", "_v"))).alias("_at"))

    def interpolate(p):
        lo, hi = F.element_at("_at", rank(p, False)), F.element_at("_at", rank(p, True))
        # the operations of ``percentile`` in their order, so that both paths give the same bits
        return F.when(hi == lo, lo).otherwise((F.ceil(position(p)) - position(p)) * lo
                                              + (position(p) - F.floor(position(p))) * hi)

    return (sizes.select(*keys, "n").join(at, keys)
            .select(*keys, "n", F.array(*[interpolate(p) for p in probs]).alias("q")))


def approx_quantiles(df: DataFrame, values: list[str], probs: list[float],
                     by: list[str] | None = None, accuracy: int = 10_000) -> DataFrame:
    """Same shape as :func:`exact_quantiles` from one mergeable sketch per group (one pass)."""
    by = list(by or [])
    return (_long(df, values, by).groupBy(*by, "variable")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.percentile_approx("_v", [float(p) for p in probs], accuracy).alias("q")))


def quantiles(df: DataFrame, values: list[str], probs: list[float], by: list[str] | None = None,
              accuracy: int | None = None) -> DataFrame:
    """Exact unless an ``accuracy`` for the approximate sketch is given."""
    if accuracy is None:
        return exact_quantiles(df, values, probs, by)
    return approx_quantiles(df, values, probs, by, accuracy)


def fill_group_median(df: DataFrame, by: list[str], values: list[str],
                      accuracy: int | None = None) -> DataFrame:
    """Replace nulls (and NaN) by the median of the row's group.

    Groups without any value, and rows without a group key, stay null. Filled columns become
    double, as the median of whole numbers need not be whole.
    """
    med = quantiles(df, values, [0.5], by, accuracy)
    wide = (med.groupBy(by).pivot("variable", values).agg(F.max(F.element_at("q", 1)))
            .withColumnsRenamed({c: f"_med_{c}" for c in values}))
    out = attach(df, wide, by, "left")
    return out.select(*[F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")),
                                   F.col(f"_med_{c}")).alias(c)
                        if c in values else F.col(c) for c in df.columns])


def describe(df: DataFrame, values: list[str], by: list[str] | None = None, digits: int | None = 2,
             accuracy: int | None = None, small_group: int = SMALL_GROUP_ROWS) -> DataFrame:
    """count, mean, std (sample), min, 25 %, 50 %, 75 %, max per column, one row per column."""
    by = list(by or [])
    keys = [*by, "variable"]
    probs = [0.25, 0.5, 0.75]
    long = _long(df, values, by, missing=True)
    moments = [F.count("_v").alias("count"), F.avg("_v").alias("mean"), F.stddev_samp("_v").alias("std"),
               F.min("_v").alias("min"), F.max("_v").alias("max")]
    if accuracy is not None:
        both = long.groupBy(keys).agg(*moments, F.percentile_approx("_v", probs, accuracy).alias("q"))
    elif _groups_are_small(df, long, keys, small_group):
        both = long.groupBy(keys).agg(*moments, _percentiles(probs).alias("q"))
    else:
        q = exact_quantiles(df, values, probs, by, small_group)
        both = long.groupBy(keys).agg(*moments).join(q.select(*keys, "q"), keys, "left")
    stats = {"mean": F.col("mean"), "std": F.col("std"), "min": F.col("min"), "p25": F.element_at("q", 1),
             "p50": F.element_at("q", 2), "p75": F.element_at("q", 3), "max": F.col("max")}
    return both.select(*keys, "count", *[(c if digits is None else F.round(c, digits)).alias(n) for n, c in stats.items()])


def box_stats(df: DataFrame, by: list[str], value: str, whisker: float = 1.5,
              accuracy: int | None = None) -> DataFrame:
    """Box-plot numbers per group: quartiles, whiskers inside 1.5 IQR, outliers, mean, count."""
    q = (quantiles(df, [value], [0.25, 0.5, 0.75], by, accuracy)
         .select(*by, F.element_at("q", 1).alias("q1"), F.element_at("q", 2).alias("median"),
                 F.element_at("q", 3).alias("q3")))
    v = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    data = attach(df.select(*by, v.alias("_v")).dropna(), q, by, "inner")
    reach = F.lit(whisker) * (F.col("q3") - F.col("q1"))
    inside = F.col("_v").between(F.col("q1") - reach, F.col("q3") + reach)
    return data.groupBy(*by, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
        F.avg("_v").alias("mean"),
        F.count(F.lit(1)).alias("n"))
