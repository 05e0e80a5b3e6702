"""As-of join: to every row the last value on or before its time, per entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.runtime import materialize

# Instants of one entity and time block.
BLOCK_ROWS = 1_000_000


def _number(df: DataFrame, time: str) -> Column:
    """A time as a number that grows with it."""
    kind = dict(df.dtypes)[time]
    if kind == "date":
        return F.unix_date(time)
    if kind.startswith("timestamp"):
        return F.unix_micros(F.col(time).cast("timestamp"))
    return F.col(time)


def asof_join(left: DataFrame, right: DataFrame, by: list[str], time: str, values: list[str], width: float | None = None) -> DataFrame:
    """``left`` with ``values`` of the last row of ``right`` that has the same ``by`` and a ``time`` on or before its own.

    Both tables have ``by`` and ``time`` (a date, a timestamp or a number, of one type). Of several rows of ``right`` at one time
    the largest by ``values`` counts. Rows of ``left`` without an earlier value, or with a null in ``by`` or ``time``, get null;
    rows of ``right`` with such a null match nothing. A value may be null itself. Columns of ``left`` that are named in
    ``values`` are replaced. Either table may be empty.

    No range is joined: both sides are reduced to distinct instants (equal ones meet on the map side) and dealt by entity
    and time block, so that a hot entity spreads over its blocks. Inside a block a window fills forward; the last value of
    every block is carried into the later ones, one row a block. ``width`` is the span of a block in days, microseconds or the
    number's own unit; by default it follows the number of instants.
    """
    if dict(left.dtypes)[time] != dict(right.dtypes)[time]:
        raise ValueError(f"{time} has two types: {dict(left.dtypes)[time]} and {dict(right.dtypes)[time]}")
    complete = [*by, time]
    fact = F.struct(*values)
    asked = left.select(*complete).dropna().groupBy(*complete).agg(F.lit(True).alias("_asked"))
    known = right.dropna(subset=complete).groupBy(*complete).agg(F.max(fact).alias("_fact"))
    instants = materialize(asked.unionByName(known, allowMissingColumns=True).groupBy(*complete).agg(
        F.max("_asked").alias("_asked"), F.max("_fact").alias("_fact")).withColumn("_n", _number(left, time)), "instants")
    if width is None:
        low, high, n = instants.agg(F.min("_n"), F.max("_n"), F.count(F.lit(1))).first()
        width = max((high - low) / max(1, n // BLOCK_ROWS), 1) if n else 1
    here = [*by, "_block"]
    dealt = instants.withColumn("_block", F.floor(F.col("_n") / F.lit(width)))
    filled = dealt.withColumn("_last", F.last("_fact", ignorenulls=True).over(
        Window.partitionBy(*here).orderBy("_n").rowsBetween(Window.unboundedPreceding, 0)))
    ends = dealt.groupBy(*here).agg(F.max_by("_fact", F.when(F.col("_fact").isNotNull(), F.col("_n"))).alias("_end"))
    # one row a block and entity
    carried = ends.select(*here, F.last("_end", ignorenulls=True).over(
        Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)).alias("_carried"))
    found = materialize(filled.where("_asked").join(carried, here, "left").select(
        *complete, F.coalesce("_last", "_carried").alias("_found")), "asof")
    kept = [c for c in left.columns if c not in values]
    return left.select(*kept).join(found, complete, "left").select(*kept, *[F.col(f"_found.{v}").alias(v) for v in values])
