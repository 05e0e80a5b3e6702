"""Random forests of many rows: the trees MLlib's regressor describes, grown on histograms of binned features.

The parameters are those of ``RandomForestRegressor`` and the result is its model. Features are cut once at quantiles, one byte
a value; rows are drawn per tree by a hash of the row (Poisson for a bootstrap), features per node. All trees grow together, a job
a level: a task passes its rows block by block, down every tree, and adds up rows, labels and squares by node, drawn feature and
bin; the sums of a tree are added up and its nodes split where the sums meet, so that only splits reach the driver.

MLlib's own trainer walks all trees for every row, over sums of all trees at once; here a block passes one tree at a time, by whole
columns, and memory is bounded by the block and by ``CELLS`` sums, however many rows there are.

Labels are whole steps, so sums are exact in any order: a forest depends on rows, seed and parameters, not on partitions or files.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.plans import boosting
from panelspark.runtime import materialize, scratch_path

# Rows of a block, rows of a task at most, and sums a task keeps at a time.
BLOCK_ROWS, ROWS_PER_TASK, CELLS = 1 << 16, 1 << 22, 1 << 23
SUMS = 3  # rows, labels, squares of labels


class Settings(NamedTuple):
    """``cuts`` are the upper bounds of all bins but the last, by feature; a label is ``base`` and whole steps of ``unit``, its
    square counts in ``square`` steps."""

    cuts: list[np.ndarray]
    trees: int
    depth: int
    columns: int
    rows: float
    bootstrap: bool
    least_gain: float
    least_rows: int
    seed: int
    base: float
    unit: float
    square: float

    @property
    def bins(self) -> int:
        return max(len(c) for c in self.cuts) + 1


class Level(NamedTuple):
    """The splits above a level by tree and node (leaves send rows left), the place of each node in the sums (-1: not
    split any further) and the features drawn for it."""

    deep: int
    feature: np.ndarray
    cut: np.ndarray
    slot: np.ndarray
    drawn: list[np.ndarray]


def able(regressor: RandomForestRegressor, data: DataFrame) -> bool:
    """Whether ``grow`` covers the parameters: numeric features, one byte a bin, rows of equal weight."""
    attributes = data.schema[regressor.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
    return (isinstance(regressor, RandomForestRegressor) and not regressor.isDefined("weightCol") and regressor.getMaxBins() <= 256
            and regressor.getMaxDepth() <= 20 and regressor.getMinWeightFractionPerNode() == 0 and not {"nominal", "binary"} & set(attributes))


def features_per_node(strategy: str, features: int, trees: int) -> int:
    """MLlib's reading of ``featureSubsetStrategy`` for regression."""
    if strategy == "auto":
        strategy = "onethird" if trees > 1 else "all"
    named = {"all": features, "sqrt": math.ceil(math.sqrt(features)), "log2": max(1, math.ceil(math.log2(features))), "onethird": math.ceil(features / 3)}
    if strategy in named:
        return named[strategy]
    return min(int(strategy), features) if strategy.isdigit() else math.ceil(float(strategy) * features)


def bounds(s: Settings) -> np.ndarray:
    """Hashes from which on a row is drawn once, twice, ..."""
    if not s.bootstrap:
        return np.array([min(int((1 - s.rows) * 2.0 ** 64), 2 ** 64 - 1)], dtype=np.uint64)
    share, upto, out = math.exp(-s.rows), 0.0, []
    while len(out) < 64:
        upto += share
        share *= s.rows / (len(out) + 1)
        if upto * 2.0 ** 64 >= 2.0 ** 64 - 2048:
            break
        out.append(int(upto * 2.0 ** 64))
    return np.array(out, dtype=np.uint64)


def drawn_rows(keys: np.ndarray, tree: int, s: Settings, at_least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that take part in a tree, and how many times."""
    if not s.bootstrap and s.rows >= 1:
        return np.arange(len(keys)), np.ones(len(keys))
    salt = boosting._mixed(np.array([((s.seed & 0xFFFFFFFF) << 32) + tree], dtype=np.uint64))
    hashed = boosting._mixed(keys ^ salt)
    at = np.flatnonzero(hashed >= at_least[0])
    hashed, times = hashed[at], np.ones(len(at))
    for bound in at_least[1:]:
        more = hashed >= bound
        if not more.any():
            break
        times += more
    return at, times


def drawn_columns(tree: int, deep: int, s: Settings) -> np.ndarray:
    """Features that a node may split by, a line for every place of the level, in order."""
    n = len(s.cuts)
    if s.columns == n:
        return np.tile(np.arange(n), (1 << deep, 1))
    drawn = np.random.Generator(np.random.PCG64([s.seed & 0xFFFFFFFF, tree, deep])).random((1 << deep, n))
    return np.sort(np.argsort(drawn, axis=1, kind="stable")[:, :s.columns], axis=1)


def packed(bins: np.ndarray, steps: np.ndarray, key: np.ndarray) -> bytes:
    return b"".join(np.ascontiguousarray(x).tobytes() for x in (bins, steps, key))


def _blocks(packs: Iterator[bytes], features: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Bins by feature, labels in steps and keys, in blocks of ``BLOCK_ROWS`` or somewhat more."""
    def read(held):
        parts = []
        for b in held:
            n = len(b) // (features + 12)
            parts.append((np.frombuffer(b, np.uint8, n * features).reshape(features, n), np.frombuffer(b, np.int32, n, n * features),
                          np.frombuffer(b, np.uint64, n, n * (features + 4))))
        return tuple(np.concatenate(x, axis=-1) for x in zip(*parts, strict=True))
    held, n = [], 0
    for b in packs:
        held.append(b)
        n += len(b) // (features + 12)
        if n >= BLOCK_ROWS:
            yield read(held)
            held, n = [], 0
    if held:
        yield read(held)


def add_up(cells: np.ndarray, block: tuple[np.ndarray, np.ndarray, np.ndarray], tree: int, level: Level, s: Settings, at_least: np.ndarray) -> None:
    """Add a block's rows to the sums of a tree: by node, drawn feature, bin."""
    bins, steps, key = block
    at, times = drawn_rows(key, tree, s, at_least)
    flat, length, width = bins.reshape(-1), bins.shape[1], s.bins
    node = np.ones(len(at), dtype=np.int64)
    start, cut = level.feature[tree].astype(np.int64) * length, level.cut[tree]
    for _ in range(level.deep):  # in range by construction: take need not check
        where = start.take(node, mode="clip")
        where += at
        right = flat.take(where, mode="clip") > cut.take(node, mode="clip")
        node <<= 1
        node |= right
    place = level.slot[tree].take(node, mode="clip")
    if (place < 0).any():
        kept = np.flatnonzero(place >= 0)
        place, at, times = place[kept], at[kept], times[kept]
    label = steps[at].astype(np.float64)
    first = times * label
    second = np.floor(label * label / s.square + 0.5)
    second *= times
    drawn = level.drawn[tree]
    for k in range(drawn.shape[1]):
        where = (drawn[:, k].astype(np.int64) * length).take(place, mode="clip")
        where += at
        cell = place * width
        cell += flat.take(where, mode="clip")
        for i, x in enumerate((times, first, second)):
            cells[i, :, k] += np.bincount(cell, x, len(drawn) * width).reshape(-1, width)


def best_splits(cells: np.ndarray, drawn: np.ndarray, s: Settings) -> np.ndarray:
    """The best split of every node of a tree: gain, feature, bin, then rows, labels, squares of the node and of the left child.

    The gain is the loss of variance; equal gains go to the first drawn feature, then the lowest bin. Without one the feature is -1.
    """
    left = np.cumsum(cells, axis=3)
    whole = left[:, :, 0, -1]
    left = left[..., :-1]
    n, total = whole[0][:, None, None], whole[1][:, None, None]
    with np.errstate(invalid="ignore", divide="ignore"):
        right_n = n - left[0]
        apart = left[1] / left[0] - (total - left[1]) / right_n
        gain = (left[0] / n) * (right_n / n) * apart * apart * s.unit ** 2
    fits = (left[0] >= max(s.least_rows, 1)) & (right_n >= max(s.least_rows, 1)) & (gain > 0) & (gain >= s.least_gain)
    fits &= np.arange(gain.shape[2]) < np.array([len(c) for c in s.cuts])[drawn][:, :, None]
    flat = np.where(fits, gain, 0.0).reshape(len(drawn), -1)
    out = np.zeros((len(drawn), 9))
    out[:, 1], out[:, 3:6] = -1, whole.T
    if flat.shape[1]:
        best, every = np.argmax(flat, axis=1), np.arange(len(drawn))
        column, bin_ = best // gain.shape[2], best % gain.shape[2]
        found = flat[every, best] > 0
        out[:, 0], out[:, 1], out[:, 2] = flat[every, best], np.where(found, drawn[every, column], -1), np.where(found, bin_, 0)
        out[:, 6:9] = left[:, every, column, bin_].T
    return out


def level_splits(rows: RDD, level: Level, s: Settings) -> dict[int, np.ndarray]:
    """Splits of all nodes of a level by tree, in as many jobs as ``CELLS`` asks for."""
    n, width, at_least = len(s.cuts), s.bins, bounds(s)
    waiting, out = [t for t in range(s.trees) if len(level.drawn[t])], {}
    sc = rows.context
    told = sc.broadcast(level)
    while waiting:
        group, size = [], 0
        while waiting and (not group or size + level.drawn[waiting[0]].size * width * SUMS <= CELLS):
            size += level.drawn[waiting[0]].size * width * SUMS
            group.append(waiting.pop(0))

        def count(packs, group=tuple(group)):
            lv = told.value
            cells = {t: np.zeros((SUMS, *lv.drawn[t].shape, width)) for t in group}
            for block in _blocks(packs, n):
                for t in group:
                    add_up(cells[t], block, t, lv, s, at_least)
            return iter(cells.items())

        def split(tree_cells):
            return tree_cells[0], best_splits(tree_cells[1], told.value.drawn[tree_cells[0]], s)
        parts = min(len(group), rows.getNumPartitions())
        out |= dict(rows.mapPartitions(count).reduceByKey(np.add, parts).map(split).collect())  # nine numbers a node
    told.destroy()
    return out


def grow(rows: RDD, s: Settings) -> list[np.ndarray]:
    """Trees as ``(node, feature, bin, gain, rows, labels, squares)`` by node. Nodes count from 1, the children of n are 2n and 2n + 1."""
    size = 2 << s.depth
    feature, cut = np.zeros((s.trees, size), dtype=np.uint8), np.full((s.trees, size), 255, dtype=np.uint8)
    ids = [np.ones(1, dtype=np.int64)] * s.trees
    told: list[list[np.ndarray]] = [[] for _ in range(s.trees)]
    for deep in range(max(s.depth, 1)):
        slot = np.full((s.trees, 2 << deep), -1, dtype=np.int64)
        for t in range(s.trees):
            slot[t, ids[t]] = np.arange(len(ids[t]))
        drawn = [drawn_columns(t, deep, s)[ids[t] - (1 << deep)] for t in range(s.trees)]
        found = level_splits(rows, Level(deep, feature[:, :2 << deep], cut[:, :2 << deep], slot, drawn), s)
        for t, best in found.items():
            if not s.depth:
                best[:, :2] = 0, -1
            told[t].append(np.column_stack([ids[t], best[:, 1], best[:, 2], best[:, 0], best[:, 3:6]]))
            split = best[:, 1] >= 0
            here, best = ids[t][split], best[split]
            feature[t, here], cut[t, here] = best[:, 1], best[:, 2]
            sums = np.stack([best[:, 6:9], best[:, 3:6] - best[:, 6:9]], axis=1).reshape(-1, 3)
            below = np.stack([2 * here, 2 * here + 1], axis=1).reshape(-1)
            # the last level's nodes and those of one label are leaves
            done = (sums[:, 2] * sums[:, 0] - sums[:, 1] ** 2 / s.square <= 0) if deep + 1 < s.depth else np.ones(len(below), dtype=bool)
            leaves = np.full((int(done.sum()), 7), 0.0)
            leaves[:, 0], leaves[:, 1], leaves[:, 4:] = below[done], -1, sums[done]
            told[t].append(leaves)
            ids[t] = below[~done]
        ids = [i if t in found else i[:0] for t, i in enumerate(ids)]
        if not any(len(i) for i in ids):
            break
    return [np.concatenate(x) for x in told]


def _stored(trees: list[np.ndarray], s: Settings) -> pa.Table:
    """Nodes in the form MLlib keeps them: numbered from 0 along every tree, the left side first."""
    out = []
    for t, told in enumerate(trees):
        by_node = {int(x[0]): x for x in told}
        order, waiting = [], [1]
        while waiting:
            node = waiting.pop()
            order.append(node)
            if by_node[node][1] >= 0:
                waiting += [2 * node + 1, 2 * node]
        place = {node: i for i, node in enumerate(order)}
        for node in order:
            _, f, b, gain, n, y, yy = by_node[node]
            mean, inner = y / n * s.unit if n else 0.0, f >= 0
            square = yy / n * s.square * s.unit ** 2 if n else 0.0
            sums = [n, n * (s.base + mean), n * (square + 2 * s.base * mean + s.base ** 2)]
            out.append((t, place[node], s.base + mean, max(square - mean * mean, 0.0), sums, int(n), gain if inner else -1.0,
                        place[2 * node] if inner else -1, place[2 * node + 1] if inner else -1, int(f),
                        [float(s.cuts[int(f)][int(b)])] if inner else []))
    i32, f64 = pa.int32(), pa.float64()
    kinds = [i32, i32, f64, f64, pa.list_(f64), pa.int64(), f64, i32, i32, i32, pa.list_(f64)]
    names = ["treeID", "id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "featureIndex", "threshold"]
    return pa.table({c: pa.array(x, k) for c, x, k in zip(names, zip(*out, strict=True), kinds, strict=True)})


def model_of(regressor: RandomForestRegressor, trees: list[np.ndarray], s: Settings, few: DataFrame) -> RandomForestRegressionModel:
    """The trees as MLlib's model, by way of its saved form; ``few`` rows give that form its frame."""
    spark = few.sparkSession
    path = scratch_path(spark, "forest")
    regressor.fit(few).write().save(path)
    nodes = spark.createDataFrame(_stored(trees, s))
    split = F.struct("featureIndex", F.col("threshold").alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories"))
    nodes.select("treeID", F.struct("id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild",
                                    split.alias("split")).alias("nodeData")).write.mode("overwrite").parquet(f"{path}/data")
    return RandomForestRegressionModel.load(path)


def _binned(cuts: list[np.ndarray], base: float, unit: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = np.array([np.searchsorted(c, batch[f"_x{i}"].to_numpy()) for i, c in enumerate(cuts)], dtype=np.uint8)
            steps = np.floor((batch["_label"].to_numpy() - base) / unit + 0.5).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array([packed(bins, steps, batch["_key"].to_numpy().view(np.uint64))], pa.binary())], names=["data"])
    return run


def fit(regressor: RandomForestRegressor, data: DataFrame, key: list[str], tasks: int | None = None) -> RandomForestRegressionModel:
    """Grow the forest that ``regressor`` describes; ``key`` names the columns by whose values rows are drawn (equal rows
    one by one). As with MLlib a null or NaN label is an error."""
    n = len(data.select(regressor.getFeaturesCol()).first()[0])
    x, y = vector_to_array(regressor.getFeaturesCol()), F.col(regressor.getLabelCol()).cast("double")
    label = F.when(y.isNull() | F.isnan(y), F.raise_error(F.lit("labels must not be null or NaN"))).otherwise(y)
    names = [f"_x{i}" for i in range(n)]
    rows = data.select(F.xxhash64(*(key or [regressor.getLabelCol()])).alias("_key"), x.alias("_x"), label.alias("_label")).select(
        "_key", "_label", *[F.col("_x")[i].alias(c) for i, c in enumerate(names)])
    nth = F.row_number().over(Window.partitionBy("_key").orderBy("_label", *names))
    given = materialize(rows.withColumn("_key", F.xxhash64("_key", nth)), "given")
    least, most, every = given.agg(F.min("_label"), F.max("_label"), F.count(F.lit(1))).first()
    span = max(most - least, max(abs(most), abs(least)) * 2.0 ** -20) or 1.0
    bits = max(8, min(31, 53 - every.bit_length()))  # as fine as sums over all rows stay exact
    unit = 2.0 ** (math.ceil(math.log2(span)) - bits)
    base = math.floor((least + most) / 2 / unit) * unit
    s = Settings(boosting.bin_cuts(given, names, regressor.getMaxBins()), regressor.getNumTrees(), regressor.getMaxDepth(),
                 features_per_node(regressor.getFeatureSubsetStrategy(), n, regressor.getNumTrees()), regressor.getSubsamplingRate(),
                 regressor.getBootstrap(), regressor.getMinInfoGain(), regressor.getMinInstancesPerNode(), regressor.getSeed(), base, unit, 2.0 ** (bits - 2))
    tasks = tasks or max(data.sparkSession.sparkContext.defaultParallelism, -(-every // ROWS_PER_TASK))
    blocks = given.mapInArrow(_binned(s.cuts, base, unit), "data binary").repartition(tasks).rdd
    kept = blocks.map(lambda r: bytes(r["data"])).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        trees = grow(kept, s)
    finally:
        kept.unpersist()
    return model_of(regressor, trees, s, data.limit(2))
