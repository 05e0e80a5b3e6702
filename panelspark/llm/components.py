"""Connected components of a link table, by the smallest member, entirely on Spark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.runtime import materialize


def components(links: DataFrame) -> DataFrame:
    """Smallest node (``comp``) of the component of every ``node`` that has a link.

    ``links`` has long columns ``a`` and ``b``. Each round gives a node the smallest label among its neighbours
    and then the label of that label, so that chains shrink by half; rounds end when no label changes. Labels
    are written after every round: lineage stays short and a lost executor costs one round.
    """
    both = materialize(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                       .where("a <> b").distinct(), "links")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("comp")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("comp").alias("near"))
        step = labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        root = labels.select(F.col("node").alias("comp"), F.col("comp").alias("root"))
        new = materialize(step.join(root, "comp", "left").select(
            "node", "old", F.least("comp", F.coalesce("root", "comp")).alias("comp")), "labels")
        if new.where("old <> comp").isEmpty():
            return new.select("node", "comp")
        labels = new.select("node", "comp")
