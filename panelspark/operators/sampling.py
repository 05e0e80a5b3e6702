"""Reproducible samples, splits and shuffles driven by a hash of the row key.

``key`` must identify a row; one that repeats at the cut is an error. Order by hash is a fixed random order of the rows, whatever the
partitioning; a sample is its head, a split cuts it. Only the hash threshold is searched for,
so no operator here sorts or moves the table (except :func:`shuffle_rows`, which is a sort).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions.hashing import hex_number, row_hash

# 5 hex digits: about a million buckets, whatever the table size.
BUCKET_DIGITS = 5


def _threshold(df: DataFrame, key: list[str], seed, k: Column):
    """(hash, key...) of the k-th row in hash order, or None when k is 0; ``k`` may use column ``n``.

    Two passes over the key columns, run here and now: the one row found becomes a literal, so
    later passes over a sample or split only compare.
    """
    hashed = df.select(row_hash(key, seed).alias("h"), *key)
    bucket = F.substring("h", 1, BUCKET_DIGITS)
    counts = hashed.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("c"))
    # at most 16^5 rows of counts, so a single window over them is bounded
    upto = F.sum("c").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    edge = (counts.select("bucket", "c", upto.alias("upto"), F.sum("c").over(Window.partitionBy()).alias("n"))
            .withColumn("k", F.least(k, F.col("n")))
            .where((F.col("upto") - F.col("c") < F.col("k")) & (F.col("k") <= F.col("upto")))
            .select("bucket", (F.col("k") - F.col("upto") + F.col("c")).alias("rank")).first())
    if edge is None:
        return None
    place = Window.partitionBy("bucket").orderBy("h", *key)
    last = (hashed.withColumn("bucket", bucket).where(F.col("bucket") == edge["bucket"])
            .withColumn("rank", F.row_number().over(place)).withColumn("upto", F.count(F.lit(1)).over(place))
            .where(F.col("rank") == edge["rank"]).select("h", *key, "upto").first())
    if last["upto"] > edge["rank"]:
        raise ValueError(f"{key} does not identify a row: {last['upto'] - edge['rank']} more rows share the key at the cut")
    return last


def _before(df: DataFrame, key: list[str], seed, k: Column) -> Column:
    last = _threshold(df, key, seed, k)
    if last is None:
        return F.lit(False)
    types = dict(df.dtypes)
    # one struct comparison, so the hash is computed once per row; the key decides equal hashes
    here = F.struct(row_hash(key, seed).alias("h"), *key)
    edge = F.struct(F.lit(last["h"]).alias("h"), *[F.lit(last[c]).cast(types[c]).alias(c) for c in key])
    return here <= edge


def sample_rows(df: DataFrame, n: int, key: list[str], seed=42) -> DataFrame:
    """Exactly min(n, rows) rows, without replacement."""
    return df.where(_before(df, key, seed, F.lit(n).cast("bigint")))


def exact_split(df: DataFrame, test_size: float, key: list[str], seed=42, flag: str = "is_test") -> DataFrame:
    """Mark exactly ceil(test_size * rows) rows as test."""
    k = F.ceil(F.round(F.lit(float(test_size)) * F.col("n"), 6)).cast("bigint")
    return df.withColumn(flag, _before(df, key, seed, k))


def hash_split(df: DataFrame, test_percent: int, key: list[str], seed=42, flag: str = "is_test") -> DataFrame:
    """Mark about ``test_percent`` of the rows as test; no extra pass over the data."""
    return df.withColumn(flag, hex_number(row_hash(key, seed), 1, 8) % 100 < test_percent)


def shuffle_rows(df: DataFrame, key: list[str], seed=42, order: str | None = None) -> DataFrame:
    """All rows in hash order; ``order`` keeps the hash as a column."""
    h = row_hash(key, seed)
    if order:
        return df.withColumn(order, h).orderBy(order, *key)
    return df.orderBy(h, *key)
