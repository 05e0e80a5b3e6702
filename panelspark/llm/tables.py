"""What the operators of this package share on the Spark side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.runtime import materialize

# Stands for a null identifier inside an operator; such rows are treated as one document.
NULL_ID = -(1 << 63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def key_of(name: str) -> Column:
    """Identifier column in which null is ``NULL_ID``, so that it survives equi-joins."""
    return F.coalesce(F.col(name).cast("long"), F.lit(NULL_ID))


def id_of(key: Column) -> Column:
    return F.when(key != F.lit(NULL_ID), key)


def addressed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows as ``key``, ``hi``, ``lo`` and ``text``; rows that agree in the first three are equal in ``doc_id`` and text.

    ``hi`` and ``lo`` are the halves of the text's md5 where the ``doc_id`` has other texts as well, and else 0, so
    that the records of ordinary rows stay small once packed.
    """
    def half(at: int) -> Column:
        return F.conv(F.substring(F.md5(F.coalesce("text", F.lit("")).cast("binary")), at, 16), 16, -10).cast("long")

    rows = docs.select(key_of(doc_id).alias("key"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("hi", half(1)).withColumn("lo", half(17))
    several = materialize(rows.groupBy("key").agg(*(f(c).alias(f"{f.__name__}_{c}") for c in ("hi", "lo") for f in (F.min, F.max)))
                          .where("min_hi <> max_hi or min_lo <> max_lo").select("key", F.lit(True).alias("several")), "several")
    return rows.join(several, "key", "left").select(
        "key", *(F.when(F.col("several"), F.col(c)).otherwise(F.lit(0).cast("long")).alias(c) for c in ("hi", "lo")), "text")


def digest_of(df: DataFrame) -> Column:
    """128 bits of all columns of a row: equal for equal rows only; null differs from an empty string."""
    parts = [F.coalesce(F.md5(F.col(f"`{c}`").cast("string").cast("binary")), F.lit("-")) for c in df.columns]
    return F.unhex(F.md5(F.concat_ws(",", *parts).cast("binary")))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it as long as ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_bytes(df: DataFrame, text: str) -> int:
    """Bytes of all texts; one aggregate over one column."""
    return int(df.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0)
