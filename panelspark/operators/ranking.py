"""Global ranks and label encoding without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.runtime import attach, materialize


def rank_rows(df: DataFrame, order: list[Column], rank: str = "rank") -> DataFrame:
    """Number all rows 1..n in the given order (ties broken by later order columns).

    The table is range-sorted and written with its position inside each partition; partition
    sizes, one row per partition, then give the offsets. ``order`` should be unique per row.
    """
    position = F.monotonically_increasing_id()
    placed = materialize(df.orderBy(*order).withColumn("_id", position)
                         .withColumn("_part", F.shiftright("_id", 33)), "ranked")
    run = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per sort partition
    offsets = (placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_c"))
               .select("_part", F.coalesce(F.sum("_c").over(run), F.lit(0)).alias("_off")))
    within = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return (placed.join(F.broadcast(offsets), "_part")
            .withColumn(rank, F.col("_off") + within + 1).drop("_id", "_part", "_off"))


def label_mappings(df: DataFrame, columns: list[str]) -> DataFrame:
    """(name, value, code) for all columns from one pass: distinct non-null values of each column
    in binary order, numbered from 0."""
    types = dict(df.dtypes)
    if other := [c for c in columns if types[c] != "string"]:
        raise ValueError(f"codes follow the order of texts, these columns are not texts: {other}")
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns])
    values = df.select(F.inline(pairs)).where("value is not null").distinct()
    ranked = rank_rows(values, [F.col("name"), F.col("value")], "_rank")
    # one row per column
    first = ranked.groupBy("name").agg(F.min("_rank").alias("_first"))
    return (ranked.join(F.broadcast(first), "name")
            .select("name", "value", (F.col("_rank") - F.col("_first")).cast("int").alias("code")))


def label_mapping(df: DataFrame, column: str) -> DataFrame:
    """(value, code) of one column."""
    return label_mappings(df, [column]).drop("name")


def label_encode(df: DataFrame, columns: list[str], suffix: str = "_enc",
                 source: DataFrame | None = None) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Add an alphabetical code per text column (null gives -1); also return the mapping tables.

    ``source`` may name a cheaper table with the same distinct values, e.g. the rows before
    duplicates were removed.
    """
    all_maps = materialize(label_mappings(df if source is None else source, columns), "labels")
    mappings = {}
    for c in columns:
        mappings[c] = all_maps.where(F.col("name") == c).drop("name")
        side = mappings[c].withColumnsRenamed({"value": c, "code": f"{c}{suffix}"})
        df = attach(df, side, [c], "left", stored=True)
        df = df.withColumn(f"{c}{suffix}", F.coalesce(F.col(f"{c}{suffix}"), F.lit(-1)))
    return df, mappings


def top_rows(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """First n rows in order: a short report, kept per task and merged."""
    return df.orderBy(*order).limit(n)


def sort_rows(df: DataFrame, order: list[Column]) -> DataFrame:
    return df.orderBy(*order)
