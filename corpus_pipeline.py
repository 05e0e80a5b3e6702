"""A training corpus from ``documents``: judge, deduplicate, decontaminate, pseudonymise, mix.

Every stage takes the session, the documents its predecessor kept and the folder of the other tables, and
returns documents; the last one returns the mix. Between stages the documents are Parquet files in the
shared folder, so a lost executor costs no more than its own stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm import decontaminate, mixing, near_dedup, pii, tables, weak_labels
from panelspark.runtime import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it is fitted on this stage's own input.

    Null and empty texts are judged as empty texts; equal texts go or stay together. Labels may be missing. An empty
    table gives an empty one, and columns named like the classifier's own (``kept``, ``junk_score``) come back as they were.
    """
    rows = _aside(docs, "doc_id", "text")
    model = weak_labels.fit(rows, tables.table(spark, sf_dir, "labels"))
    return weak_labels.score(rows, model).where("kept").select(*rows.columns).toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class, the one with the smallest ``doc_id``; rows that share an identifier are told apart.

    Texts without a word, null included, are alone, but of wholly equal rows one stays. A null ``doc_id`` sorts first; the
    digest of the row decides ties. An empty table gives an empty one; other columns pass unchanged.
    """
    return near_dedup.first_of_classes(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a window of a benchmark item, each judged by its own text.

    Texts without a word stay. Equal rows go or stay together. With an empty ``benchmark`` every row stays; an empty
    table gives an empty one. Other columns pass unchanged.
    """
    mark = tables.free_name(docs, "row_digest")
    rows = docs.withColumn(mark, tables.digest_of(docs))
    found = decontaminate.judged(rows.select(F.col(mark).alias("key"), F.col("text").cast("string").alias("text")),
                                 tables.table(spark, sf_dir, "benchmark"))
    out = found.where("contaminated").select(F.col("key").alias(mark)).distinct()
    return rows.join(out, mark, "left_anti").select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms in their texts; ``n_chars`` follows the text.

    Every row stays; null stays null and an empty text empty. Equal values get equal pseudonyms in all rows. Other columns
    pass unchanged, also one named ``pii_kinds``. The key is the session's (``pii.session_key``).
    """
    masked = pii.mask(docs, pii.session_key(spark), kinds=tables.free_name(docs, "pii_kinds"))
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return masked.select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often the corpus takes each document that is left.

    Null is a source like any other; texts without words are listed and never taken. Rows of equal ``doc_id``, size and
    source are interchangeable. An empty table gives an empty mix; other columns are left out.
    """
    return mixing.mix(docs)


def _aside(docs: DataFrame, *used: str) -> DataFrame:
    """``docs`` with names of its own for all columns that a stage does not use, so that no added column meets them."""
    return docs.toDF(*(c if c in used else f"given_{i}" for i, c in enumerate(docs.columns)))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("personal_data", personal_data), ("mix", mix)]
# The classifier's weights and the permutations have no SQL form; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
