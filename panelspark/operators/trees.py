"""Tree ensembles as tables: nodes of fitted models, scoring by joins, importances by gain, weight and cover.

A node table has one row per node: ``tree``, ``node`` (1 is the root, the children of n are 2n and 2n + 1), ``feature`` (null in
leaves), ``threshold`` (rows up to it go ``left``), ``left``, ``right``, ``value`` (what the leaf adds to a prediction), ``gain`` of
the split and ``cover`` (rows that reached the node). It holds ``2**depth`` rows a tree, whatever the training data.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelspark.runtime import attach, materialize, scratch_path

COLUMNS = ["tree", "node", "feature", "threshold", "left", "right", "value", "gain", "cover"]


def node_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Node table of ``(tree, node, feature, threshold, value, gain, cover)`` rows, written to the shared folder."""
    table = spark.createDataFrame(rows, "tree int, node int, feature string, threshold double, value double, gain double, cover double")
    return materialize(_with_children(table), "nodes")


def _with_children(table: DataFrame) -> DataFrame:
    inner = F.col("feature").isNotNull()
    return table.withColumns({"left": F.when(inner, 2 * F.col("node")), "right": F.when(inner, 2 * F.col("node") + 1)}).select(*COLUMNS)


def of_model(model: PipelineModel, features: list[str]) -> DataFrame:
    """Node table of the fitted forest or boosted trees at the end of a pipeline.

    Leaf values carry the tree's weight (a forest's trees count equally), so a prediction is their sum. The nodes are read
    from the model's own saved form; at most 31 levels.
    """
    regressor = model.stages[-1]
    spark = SparkSession.active()
    path = scratch_path(spark, "model")
    regressor.write().save(path)
    stored = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    weights = [float(w) for w in regressor.treeWeights]
    whole = sum(weights) if type(regressor).__name__.startswith("RandomForest") else 1.0
    plain = materialize(stored.select(
        F.col("treeID").cast("int").alias("tree"), F.col("id").cast("int").alias("id"),
        F.when(F.col("leftChild") >= 0, F.element_at(F.array(*map(F.lit, features)), F.col("split.featureIndex") + 1)).alias("feature"),
        F.when(F.col("leftChild") >= 0, F.element_at("split.leftCategoriesOrThreshold", 1)).alias("threshold"),
        (F.col("prediction") * F.element_at(F.array(*[F.lit(w / whole) for w in weights]), F.col("treeID").cast("int") + 1)).alias("value"),
        F.when(F.col("leftChild") >= 0, F.col("gain")).otherwise(F.lit(0.0)).alias("gain"),
        F.col("rawCount").cast("double").alias("cover"),
        F.col("leftChild").alias("l"), F.col("rightChild").alias("r")), "stored_nodes")
    level, levels = plain.where("id = 0").withColumn("node", F.lit(1)), []
    while not level.isEmpty():  # one round a level
        levels.append(level)
        below = level.where("feature is not null").select("tree", F.inline(F.array(
            F.struct(F.col("l").alias("id"), (2 * F.col("node")).alias("node")),
            F.struct(F.col("r").alias("id"), (2 * F.col("node") + 1).alias("node")))))
        level = materialize(below.join(plain, ["tree", "id"]), "level")
    return materialize(_with_children(reduce(DataFrame.unionByName, levels)), "nodes")


def depth_of(nodes: DataFrame) -> int:
    deepest = nodes.agg(F.max("node")).first()[0]
    return int(deepest).bit_length() - 1 if deepest else 0


def outputs(nodes: DataFrame, df: DataFrame, features: list[str], key: list[str]) -> DataFrame:
    """``key``..., ``tree`` and ``value``: what every tree says to every row.

    Rows go down all trees at once, one join with the node table a level; the planner broadcasts the table while it is
    small. A row costs as many joins as there are trees and levels, so rows are dealt by key before, however few files they
    come from. A null or NaN feature goes left.
    """
    place = {f: i + 1 for i, f in enumerate(features)}
    values = F.array(*[F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")) for f in features]).alias("_x")
    trees = [r["tree"] for r in nodes.select("tree").distinct().orderBy("tree").collect()]
    dealt = df.select(*key, values).repartition(*key)
    rows = dealt.select(*key, "_x", F.explode(F.array(*map(F.lit, trees)) if trees else F.array().cast("array<int>")).alias("tree"),
                        F.lit(1).alias("node"))
    inner = nodes.where("feature is not null").select(
        "tree", "node", F.coalesce(*[F.when(F.col("feature") == f, F.lit(i)) for f, i in place.items()]).alias("_at"),
        "threshold", "left", "right")
    inner = materialize(inner, "inner")
    for _ in range(depth_of(nodes)):
        x = F.element_at("_x", F.col("_at"))
        rows = attach(rows, inner, ["tree", "node"], stored=True).select(
            *key, "_x", "tree", F.when(F.col("_at").isNull(), F.col("node")).when(x > F.col("threshold"), F.col("right"))
            .otherwise(F.col("left")).alias("node"))
    return rows.join(nodes.select("tree", "node", "value"), ["tree", "node"]).select(*key, "tree", "value")


def scores(nodes: DataFrame, df: DataFrame, features: list[str], key: list[str], name: str = "prediction", base: float = 0.0) -> DataFrame:
    """``key``... and the prediction, summed up from ``outputs`` (map-side first, as all trees of a row share a task)."""
    return outputs(nodes, df, features, key).groupBy(*key).agg((F.lit(base) + F.sum("value")).alias(name))


def round_scores(nodes: DataFrame, df: DataFrame, features: list[str], key: list[str], label: str, base: float = 0.0) -> DataFrame:
    """``key``..., ``round``, ``actual`` and ``predicted`` after each tree: prefix sums of the trees' outputs per row."""
    told = outputs(nodes, df.withColumn("_y", F.col(label).cast("double")), features, [*key, "_y"])
    upto = Window.partitionBy(*key).orderBy("tree").rowsBetween(Window.unboundedPreceding, 0)
    return told.select(*key, F.col("tree").alias("round"), F.col("_y").alias("actual"),
                       (F.lit(base) + F.sum("value").over(upto)).alias("predicted"))


def importance(nodes: DataFrame, features: list[str]) -> DataFrame:
    """Per feature: ``weight`` (splits), ``total_gain``, ``gain`` (mean of a split), ``total_cover``, ``cover`` (mean) and ``share`` of the
    total gain; a feature without splits has zeros."""
    split = nodes.where("feature is not null").groupBy("feature").agg(
        F.count(F.lit(1)).alias("weight"), F.sum("gain").alias("total_gain"), F.sum("cover").alias("total_cover"))
    every = nodes.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    filled = every.join(split, "feature", "left").na.fill(0)
    whole = F.sum("total_gain").over(Window.partitionBy())  # one row a feature
    return filled.select("feature", "weight", "total_gain", F.coalesce(F.try_divide("total_gain", "weight"), F.lit(0.0)).alias("gain"),
                         "total_cover", F.coalesce(F.try_divide("total_cover", "weight"), F.lit(0.0)).alias("cover"),
                         F.coalesce(F.try_divide("total_gain", whole), F.lit(0.0)).alias("share"))


# Levels of up to so many splits are passed split by split, one comparison of whole columns each.
_NARROW = 64


def descend(x: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    """The node of every row ``levels`` below the root. ``x`` has a line per feature; ``feature`` and ``cut`` are by node, -1 is none.

    Rows up to the cut go left, and so do rows that have come to a leaf: ``leaves`` carries values along.
    """
    node = np.ones(x.shape[1], dtype=np.uint8 if levels < 8 else np.uint16 if levels < 16 else np.int64)
    over, here = np.empty((2, x.shape[1]), dtype=bool)
    for deep in range(levels):
        ids = (1 << deep) + np.flatnonzero(feature[1 << deep:2 << deep] >= 0)
        right = np.zeros(x.shape[1], dtype=bool)
        if len(ids) <= _NARROW:
            # plain numbers: numpy's own would widen the columns of bytes
            for j, f, c in zip(ids.tolist(), feature[ids].tolist(), cut[ids].tolist(), strict=True):
                np.greater(x[f], c, out=over)
                np.equal(node, j, out=here)
                over &= here
                right |= over
        else:
            at = np.flatnonzero(feature[node] >= 0)
            right[at] = x[feature[node[at]], at] > cut[node[at]]
        node = (node << 1) | right
    return node


def leaves(feature: np.ndarray, value: np.ndarray, levels: int) -> np.ndarray:
    """``value`` by node, with those of leaves handed down to the nodes where ``descend`` puts their rows."""
    out = value.copy()
    for deep in range(levels):
        ids = (1 << deep) + np.flatnonzero(feature[1 << deep:2 << deep] < 0)
        out[2 * ids] = out[ids]
    return out


def predict(nodes: DataFrame, df: DataFrame, features: list[str], name: str = "prediction", base: float = 0.0) -> DataFrame:
    """``df`` with the sum of all trees in Arrow batches; the node table, bounded by trees and depth, travels with the code.

    A null or NaN feature goes left. ``name`` replaces a column of that name.
    """
    width = 2 << depth_of(nodes)
    rows = nodes.select("tree", "node", "feature", "threshold", "value").orderBy("tree", "node").collect()
    place = {t: i for i, t in enumerate(dict.fromkeys(r["tree"] for r in rows))}
    feature, threshold, value = np.full((len(place), width), -1), np.zeros((len(place), width)), np.zeros((len(place), width))
    for r in rows:
        i, n = place[r["tree"]], r["node"]
        value[i, n] = r["value"]
        if r["feature"] is not None:
            feature[i, n], threshold[i, n] = features.index(r["feature"]), r["threshold"]
    levels = width.bit_length() - 2
    value = [leaves(f, v, levels) for f, v in zip(feature, value, strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([batch[f"_x{i}"].to_numpy(zero_copy_only=False) for i in range(len(features))])
            out = np.full(batch.num_rows, base)
            for f, t, v in zip(feature, threshold, value, strict=True):
                out += v[descend(x, f, t, levels)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], pa.array(out)], names=[*kept, name])

    kept = [c for c in df.columns if c != name]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != name)
    given = df.select(*kept, *[F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(features)])
    return given.mapInArrow(run, f"{fields + ', ' if fields else ''}`{name}` double")
