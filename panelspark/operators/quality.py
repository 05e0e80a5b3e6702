"""Table assertions and the audited cleaning step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions import fixed_values as fv
from panelspark.functions.scalars import parse_date
from panelspark.operators.audit import Trail
from panelspark.operators.project import cast
from panelspark.operators.summary import _is_missing


class ValidationError(AssertionError):
    """A table did not pass its checks."""


def checks(df: DataFrame, min_rows: int | None = fv.MIN_ROWS, no_nulls: bool = True) -> DataFrame:
    """One row per check: check_name, passed, observed (one pass over the table)."""
    missing = F.lit(0)
    for c in df.columns:
        missing = missing + _is_missing(df, c).cast("int")
    one = df.agg(F.coalesce(F.sum(missing), F.lit(0)).alias("nulls"), F.count(F.lit(1)).alias("rows"))
    rows = []
    if no_nulls:
        rows.append(F.struct(F.lit("no_nulls").alias("check_name"), (F.col("nulls") == 0).alias("passed"),
                             F.col("nulls").alias("observed")))
    if min_rows is not None:
        rows.append(F.struct(F.lit("min_rows").alias("check_name"), (F.col("rows") >= min_rows).alias("passed"),
                             F.col("rows").alias("observed")))
    return one.select(F.inline(F.array(*rows)))


def require(df: DataFrame, min_rows: int | None = fv.MIN_ROWS, no_nulls: bool = True) -> None:
    """Raise :class:`ValidationError` unless all checks pass."""
    failed = [f"{r.check_name}: observed {r.observed}"
              for r in checks(df, min_rows, no_nulls).where("not passed").collect()]
    if failed:
        raise ValidationError("; ".join(failed))


def typed(df: DataFrame, types: dict[str, str], dates: list[str]) -> DataFrame:
    """Safe casts and date parsing; text that does not fit becomes null."""
    return cast(df, types).withColumns({c: parse_date(c) for c in dates})


def clean(df: DataFrame, types: dict[str, str], dates: list[str]) -> DataFrame:
    """Cast, parse dates, drop duplicate rows, drop rows with a null."""
    return typed(df, types, dates).dropDuplicates().dropna()


def clean_to(df: DataFrame, types: dict[str, str], dates: list[str], path: str) -> DataFrame:
    """Write :func:`clean` to ``path`` as Parquet and return its audit, counted by that same job: step, stage, row_count,
    column_count and, for the de-duplicated rows, missing values by column."""
    trail = Trail()
    rows = trail.watch(typed(df, types, dates), "loaded")
    rows = trail.watch(rows.dropDuplicates(), "deduplicated", rows.columns)
    trail.watch(rows.dropna(), "complete").write.parquet(path)
    return trail.table(df.sparkSession)


def clean_audit(df: DataFrame, types: dict[str, str], dates: list[str]) -> DataFrame:
    """Row counts of every cleaning step from a single aggregate: step, stage, row_count.

    Distinct typed rows carry their multiplicity, so the counts before and after each step
    need no pass of their own.
    """
    t = typed(df, types, dates)
    whole = F.lit(True)
    for c in t.columns:
        whole = whole & ~_is_missing(t, c)
    one = t.groupBy(*t.columns).agg(F.count(F.lit(1)).alias("_c")).agg(
        F.coalesce(F.sum("_c"), F.lit(0)).alias("loaded"),
        F.count(F.lit(1)).alias("deduplicated"),
        F.count_if(whole).alias("complete"))
    steps = ["loaded", "deduplicated", "complete"]
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("step"), F.lit(s).alias("stage"), F.col(s).alias("row_count"))
        for i, s in enumerate(steps)])))
