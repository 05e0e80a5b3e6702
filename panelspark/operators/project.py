"""Projections, casts, fills and null filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.functions.scalars import clip


def keep(df: DataFrame, columns: list[str]) -> DataFrame:
    """Ordered column subset; unknown names raise."""
    return df.select(*columns)


def drop(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.drop(*columns)


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def prettify(df: DataFrame) -> DataFrame:
    """Column names for display: underscores to spaces, Title Case."""
    return df.withColumnsRenamed({c: c.replace("_", " ").title() for c in df.columns})


_INTEGER_BITS = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}


def safe_cast(c: Column, source: str, target: str) -> Column:
    """Cast that gives null for values that do not fit.

    Whole numbers are range-checked, which is cheaper than a failing ``try_cast`` per row. A
    number text such as '12.5' becomes an integer by way of double (truncated).
    """
    if target in _INTEGER_BITS and source in _INTEGER_BITS:
        if _INTEGER_BITS[target] >= _INTEGER_BITS[source]:
            return c.cast(target)
        top = 1 << (_INTEGER_BITS[target] - 1)
        return F.when(c.between(-top, top - 1), c.cast(target))
    if target in _INTEGER_BITS and source == "string":
        return F.coalesce(c.try_cast(target), c.try_cast("double").try_cast(target))
    return c.try_cast(target)


def cast(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast columns in one projection; values that do not fit become null instead of failing."""
    source = dict(df.dtypes)
    return df.withColumns({c: safe_cast(F.col(c), source[c], t) for c, t in types.items()})


def with_bounded_sum(df: DataFrame, name: str, terms: list[Column], lo: float, hi: float, digits: int) -> DataFrame:
    """Add the sum of terms, clipped and rounded: the form of the waste and air-quality formulas.

    The sum is a column of its own first, so costly terms (hashes) are evaluated once although
    clipping refers to them several times.
    """
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return df.withColumn("_sum", total).withColumn(name, F.round(clip("_sum", lo, hi), digits)).drop("_sum")


def with_constants(df: DataFrame, values: dict) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def fill(df: DataFrame, values: dict) -> DataFrame:
    """Replace nulls by constants per column."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def drop_nulls(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Remove rows with a null (or NaN) in any of the columns."""
    return df.dropna(how="any", subset=subset)


def features_and_target(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """Features in order plus ``label``, all double."""
    return df.select(*[F.col(c).cast("double").alias(c) for c in features],
                     F.col(target).cast("double").alias("label"))
