"""Forests grown on histograms against MLlib's own trees and against a walk in plain Python."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import functions as F

from panelspark.operators import trees
from panelspark.plans import forest, models

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def frame(spark):
    r = random.Random(3)
    rows = []
    for i in range(600):
        a, b, c = float(r.randint(0, 9)), float(r.randint(0, 4)), float(r.randint(0, 2))
        rows.append((i, a, b if i else None, c, 3 * a + b * c + r.random()))
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y double").repartition(5).cache()


def grown(monkeypatch, pipe, df):
    with monkeypatch.context() as m:
        m.setattr(models, "FOREST_ROWS", 0)
        m.setattr(models.RandomForestRegressor, "fit", small_only(models.RandomForestRegressor.fit))
        return models.fit(pipe, df)


def small_only(fit):
    """MLlib's trainer walks all trees for every row; it may only make the frame of the saved form."""
    def run(self, df, params=None):
        assert df.count() <= 2
        return fit(self, df, params)
    return run


def test_unsampled_trees_are_those_of_mllib(spark, frame, monkeypatch):
    pipe = models.random_forest(FEATURES, "y", num_trees=1, max_depth=5, subsample=1.0, bootstrap=False)
    own, theirs = grown(monkeypatch, pipe, frame), models.fit(pipe, frame)
    assert isinstance(own.stages[-1], RandomForestRegressionModel) and own.stages[-1].getNumTrees == 1
    a, b = (trees.of_model(m, FEATURES).orderBy("node").collect() for m in (own, theirs))
    assert [(r.node, r.feature, r.cover) for r in a] == [(r.node, r.feature, r.cover) for r in b] and len(a) > 30
    assert [r.value for r in a] == pytest.approx([r.value for r in b], abs=1e-7)
    assert [r.gain for r in a] == pytest.approx([r.gain for r in b], abs=1e-6)
    assert own.stages[-1].featureImportances.toArray() == pytest.approx(theirs.stages[-1].featureImportances.toArray(), abs=1e-7)
    d = frame.where("b is not null")
    both = models.score(own, d, "y", ["id"]).join(models.score(theirs, d, "y", ["id"]).select("id", F.col("predicted").alias("p")), "id").collect()
    assert len(both) == 599 and all(r.predicted == pytest.approx(r.p, abs=1e-7) for r in both)


def test_sampled_forest_keeps_its_parameters_and_fits_as_well(spark, frame, monkeypatch):
    pipe = models.random_forest(FEATURES, "y", num_trees=100, max_depth=6)
    own, theirs = grown(monkeypatch, pipe, frame), models.fit(pipe, frame)
    d = frame.where("b is not null")
    error = [models.score(m, d, "y").agg(F.avg(F.col("abs_error") ** 2)).first()[0] for m in (own, theirs)]
    assert error[0] == pytest.approx(error[1], rel=0.25)
    nodes = trees.of_model(own, FEATURES)
    assert nodes.select("tree").distinct().count() == 100 and nodes.agg(F.max("node")).first()[0] < 128
    covers = [r.cover for r in nodes.where("node = 1").collect()]
    assert len(set(covers)) > 5 and np.mean(covers) == pytest.approx(0.8 * 599, rel=0.05)
    assert len({r.feature for r in nodes.where("node = 1").collect()}) > 1  # one of three features a node
    assert own.stages[-1].extractParamMap().keys() == theirs.stages[-1].extractParamMap().keys()


def test_model_depends_on_rows_not_on_layout(frame, monkeypatch):
    pipe = models.random_forest(FEATURES, "y", num_trees=4, max_depth=4)
    monkeypatch.setattr(forest, "BLOCK_ROWS", 100)
    one = trees.of_model(grown(monkeypatch, pipe, frame), FEATURES).collect()
    monkeypatch.setattr(forest, "CELLS", 1)  # a job a tree
    two = trees.of_model(grown(monkeypatch, pipe, frame.coalesce(1).orderBy("y")), FEATURES).collect()
    assert sorted(map(str, one)) == sorted(map(str, two))


def test_equal_rows_are_drawn_one_by_one(spark, monkeypatch):
    d = spark.createDataFrame([(1.0, 0.0, 0.0, float(i % 2)) for i in range(2000)], "a double, b double, c double, y double")
    nodes = trees.of_model(grown(monkeypatch, models.random_forest(FEATURES, "y", num_trees=5, max_depth=3), d), FEATURES).collect()
    assert len(nodes) == 5  # nothing to split by
    assert all(1400 < r.cover < 1800 for r in nodes) and len({r.cover for r in nodes}) > 1


def test_labels_must_be_there(spark, frame, monkeypatch):
    pipe = models.random_forest(FEATURES, "y", num_trees=2, max_depth=2)
    with pytest.raises(Exception, match="null or NaN"):
        grown(monkeypatch, pipe, frame.withColumn("y", F.nullif("y", F.col("y"))))
    constant = grown(monkeypatch, pipe, frame.withColumn("y", F.lit(2.5)))
    assert constant.stages[-1].totalNumNodes == 2 and models.score(constant, frame, "y").first().predicted == 2.5


def test_rows_are_drawn_as_poisson():
    s = forest.Settings([np.arange(3.0)], 2, 3, 1, 0.8, True, 0.0, 1, 42, 0.0, 1.0, 1.0)
    keys = np.random.default_rng(1).integers(0, 2 ** 63, 200_000).astype(np.uint64)
    at, times = forest.drawn_rows(keys, 0, s, forest.bounds(s))
    every = np.bincount(np.concatenate([times.astype(int), np.zeros(len(keys) - len(at), int)]), minlength=4) / len(keys)
    assert every[:4] == pytest.approx([math.exp(-0.8) * 0.8 ** k / math.factorial(k) for k in range(4)], abs=0.005)
    assert set(forest.drawn_rows(keys, 1, s, forest.bounds(s))[0].tolist()) != set(at.tolist())
    plain = s._replace(bootstrap=False)
    at, times = forest.drawn_rows(keys, 0, plain, forest.bounds(plain))
    assert len(at) / len(keys) == pytest.approx(0.8, abs=0.01) and set(times) == {1.0}
    assert [forest.features_per_node(x, 6, 100) for x in ("auto", "all", "sqrt", "log2", "onethird", "4", "0.5", "9")] == [2, 6, 3, 3, 2, 4, 3, 6]
    assert forest.features_per_node("auto", 6, 1) == 6
