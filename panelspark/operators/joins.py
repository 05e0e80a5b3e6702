"""Expansion, dimension lookups and side-by-side series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.runtime import materialize


def cross_expand(df: DataFrame, *dims: dict[str, list] | DataFrame) -> DataFrame:
    """Every row of ``df`` with every row of each dimension.

    A ``{column: values}`` mapping is exploded in place, so the fact table is neither shuffled nor
    joined. A DataFrame is materialised first: the planner knows its bytes and broadcasts it if it may.
    """
    for dim in dims:
        if isinstance(dim, dict):
            for name, values in dim.items():
                df = df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
        else:
            df = df.crossJoin(materialize(dim))
    return df


def lookup(df: DataFrame, dim: DataFrame, on: list[str] | str, defaults: dict | None = None) -> DataFrame:
    """Left equi-join to a dimension keyed by ``on``; missing keys give null or the defaults.

    No hint is set here: the planner broadcasts by measured size, and adaptive execution
    splits hot keys when both sides shuffle. Literal dimensions carry their own hint.
    """
    out = df.join(dim, on, "left")
    if defaults:
        out = out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})
    return out


def side_by_side(df: DataFrame, key: str, series: str, value: str, names: list[str]) -> DataFrame:
    """One row per key and one column per named series (e.g. two forecasts per date).

    A key with several rows in one series is an error, as only one of them could be shown.
    """
    one = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit(f"several rows for one {key} and {series}"))).otherwise(
        F.max(value))
    single = df.where(F.col(series).isin(names)).groupBy(key, series).agg(one.alias("_one"))
    return single.groupBy(key).pivot(series, names).agg(F.max("_one"))


def stack_tables(tables: list[DataFrame]) -> DataFrame:
    """Rows of all tables, matched by column name."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def drop_duplicates(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return df.dropDuplicates(subset)
