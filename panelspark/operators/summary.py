"""Counts, profiles, group means and KPIs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _is_missing(df: DataFrame, c: str) -> Column:
    missing = F.col(c).isNull()
    return missing | F.isnan(c) if dict(df.dtypes)[c] in ("double", "float") else missing


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """Row and column count of each named stage as one table (one query, no separate jobs)."""
    out = None
    for i, (name, df) in enumerate(stages.items()):
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(i).alias("step"), F.lit(name).alias("stage"), "row_count",
            F.lit(len(df.columns)).alias("column_count"))
        out = one if out is None else out.unionByName(one)
    return out


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing values (null or NaN) per column in one pass: column_name, nulls."""
    columns = columns or df.columns
    one = df.agg(*[F.count_if(_is_missing(df, c)).alias(c) for c in columns])
    return one.unpivot([], columns, "column_name", "nulls")


def total_nulls(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: all missing values of the table."""
    return null_counts(df, columns).agg(F.sum("nulls").alias("total_nulls"))


def duplicate_count(df: DataFrame) -> DataFrame:
    """One row: rows, distinct_rows, duplicates (full-row equality)."""
    return (df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_c"))
            .agg(F.coalesce(F.sum("_c"), F.lit(0)).alias("row_count"), F.count(F.lit(1)).alias("distinct_rows"))
            .withColumn("duplicates", F.col("row_count") - F.col("distinct_rows")))


def group_mean(df: DataFrame, by: list[str], value: str, name: str = "mean_value",
               digits: int | None = None) -> DataFrame:
    """Mean per group, largest first; rows with a null group key are left out."""
    mean = F.avg(value)
    return (df.dropna(subset=by).groupBy(*by)
            .agg((mean if digits is None else F.round(mean, digits)).alias(name))
            .orderBy(F.desc(name), *by))


def group_mean_of_sums(df: DataFrame, by: list[str], total: str, rows: str, name: str = "mean_value") -> DataFrame:
    """Mean per group from pre-aggregated sums and row counts (fact table summed per join key
    before the joins), largest first."""
    return (df.dropna(subset=by).groupBy(*by)
            .agg(F.try_divide(F.sum(total), F.sum(rows)).alias(name)).orderBy(F.desc(name), *by))


def month_mean(df: DataFrame, month: Column | str, value: str, name: str = "mean_value") -> DataFrame:
    """Mean per month number with its short name, in calendar order."""
    m = F.col(month) if isinstance(month, str) else month
    names = F.date_format(F.make_date(F.lit(2000), F.col("month"), F.lit(1)), "MMM")
    return (df.groupBy(m.alias("month")).agg(F.avg(value).alias(name)).where("month is not null")
            .select("month", names.alias("month_name"), name).orderBy("month"))


def entity_summary(df: DataFrame, entity: list[str], value: str, static: list[str],
                   name: str = "mean_value") -> DataFrame:
    """Mean per entity next to attributes that are constant per entity."""
    return df.dropna(subset=entity).groupBy(*entity).agg(
        F.avg(value).alias(name), *[F.max(c).alias(c) for c in static])


def kpis(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """avg, peak, low (1 decimal) and total (no decimals), overall or per series.

    Sums are first rounded to 6 digits, so the order of summation cannot flip a half.
    """
    def shown(x, digits):
        return F.round(F.round(x, 6), digits)
    return df.groupBy(*(by or [])).agg(
        shown(F.avg(value), 1).alias("avg"), shown(F.max(value), 1).alias("peak"),
        shown(F.min(value), 1).alias("low"), shown(F.sum(value), 0).alias("total"))


def value_range(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(by or [])).agg(F.min(value).alias("min_value"), F.max(value).alias("max_value"))


def profile(df: DataFrame, date: str, categories: list[str], measure: str) -> DataFrame:
    """One row: rows, missing cells, duplicate rows, date range, distinct categories, measure range.

    Rows are first grouped to distinct rows with their count; everything else is read from
    that one aggregate.
    """
    missing = F.lit(0)
    for c in df.columns:
        missing = missing + _is_missing(df, c).cast("int")
    distinct = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_c"))
    return distinct.agg(
        F.coalesce(F.sum("_c"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(missing * F.col("_c")), F.lit(0)).alias("missing_values"),
        (F.coalesce(F.sum("_c"), F.lit(0)) - F.count(F.lit(1))).alias("duplicate_rows"),
        F.date_format(F.min(date), "yyyy-MM-dd").alias("first_date"),
        F.date_format(F.max(date), "yyyy-MM-dd").alias("last_date"),
        *[F.count_distinct(c).alias(f"distinct_{c}") for c in categories],
        F.min(measure).alias("min_value"), F.max(measure).alias("max_value"))


def extreme_rows(df: DataFrame, value: str, tie: str, keep: list[str], by: list[str] | None = None) -> DataFrame:
    """Rows holding the largest and the smallest value; the first by ``tie`` wins.

    Returns by..., peak_<column> and low_<column> for each kept column.
    """
    row = F.struct(*keep)
    high = F.min_by(row, F.struct((-F.col(value)).alias("v"), F.col(tie).alias("t")))
    low = F.min_by(row, F.struct(F.col(value).alias("v"), F.col(tie).alias("t")))
    out = df.where(F.col(value).isNotNull()).groupBy(*(by or [])).agg(high.alias("_hi"), low.alias("_lo"))
    return out.select(*(by or []), *[F.col(f"_hi.{c}").alias(f"peak_{c}") for c in keep],
                      *[F.col(f"_lo.{c}").alias(f"low_{c}") for c in keep])


def share(df: DataFrame, value: str, name: str = "share") -> DataFrame:
    """Fraction of the column total; null when the total is 0."""
    total = df.agg(F.sum(value).alias("t")).scalar()
    return df.withColumn(name, F.try_divide(F.col(value), total))
