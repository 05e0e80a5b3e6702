"""Boosting against a trainer that looks at every split of every node in plain Python; tree tables against their models."""

from __future__ import annotations

import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.operators import trees
from panelspark.plans import boosting, models

FEATURES = ["a", "b", "c"]
SCHEMA = "id long, a double, b double, c double, y double, late boolean"


def table(n=400, seed=4):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = float(r.randint(0, 9)), r.choice([0.5, 1.5, 2.5, None, math.nan]), float(r.randint(0, 3))
        rows.append((i, a, b, c, 3 * a + (b or 0 if b == b else 0) * c + r.random(), i % 4 == 0))
    return [*rows, (n, 1.0, 1.0, 1.0, None, False)]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(table(), SCHEMA).repartition(5).cache()


def plain(rows, keys, rounds, s: boosting.Settings, base):
    """Predictions after each round, and nodes, by trying every cut on the values themselves."""
    def value(row, f):
        x = row[1 + f]
        return -math.inf if x is None or math.isnan(x) else x
    p = {r[0]: base for r in rows}
    history, nodes = [], []
    for t in range(1, rounds + 1):
        res = {r[0]: math.floor((r[4] - p[r[0]]) / s.unit + 0.5) for r in rows}
        mask = dict(zip([r[0] for r in rows], boosting.drawn_rows(np.array([keys[r[0]] for r in rows]), t, s), strict=True))
        columns = boosting.drawn_columns(t, s)

        def go(n, depth, here):
            used = [r for r in here if mask[r[0]] and not r[5]]
            g, h = sum(res[r[0]] for r in used), len(used)
            def worth(g, h):
                return (g * s.unit) * (g * s.unit) / (h + s.l2)
            best = (s.least_gain, None, None)
            for f in columns if depth else ():
                for cut in s.cuts[f]:
                    left = [res[r[0]] for r in used if value(r, f) <= cut]
                    if min(len(left), h - len(left)) >= s.least_rows:
                        gain = 0.5 * (worth(sum(left), len(left)) + worth(g - sum(left), h - len(left)) - worth(g, h))
                        if gain > best[0]:
                            best = (gain, f, cut)
            step = s.step * ((g * s.unit) / (h + s.l2))
            nodes.append((t, n, None if best[1] is None else FEATURES[best[1]], best[2], step, h))
            if best[1] is None:
                for r in here:
                    p[r[0]] += step
                return
            go(2 * n, depth - 1, [r for r in here if value(r, best[1]) <= best[2]])
            go(2 * n + 1, depth - 1, [r for r in here if value(r, best[1]) > best[2]])
        go(1, s.depth, rows)
        history.append(dict(p))
    return history, nodes


@pytest.mark.parametrize("tasks", [1, 2])
def test_equals_a_plain_trainer(frame, tasks):
    rounds, depth = (12, 3) if tasks == 1 else (2, 2)
    unit = 2.0 ** -20
    model = boosting.boost(frame, ["id"], FEATURES, "y", rounds=rounds, depth=depth, max_bins=8, unit=unit, valid="late", chunk=5, tasks=tasks)
    rows = [r for r in table() if r[4] is not None]
    keys = {r.id: np.int64(r.h).view(np.uint64) for r in frame.select("id", F.xxhash64("id").alias("h")).collect()}
    cuts = boosting.bin_cuts(frame.where("not late and y is not null"), FEATURES, 8)
    assert all(0 < len(c) < 8 for c in cuts)
    s = boosting.Settings(cuts, depth, 0.1, 0.8, 0.8, 1.0, 0.0, 1, 42, unit)
    learned = [r for r in rows if not r[5]]
    base = sum(math.floor(r[4] / unit + 0.5) for r in learned) // len(learned) * unit
    history, nodes = plain(rows, keys, rounds, s, base)
    assert model.base == base
    got = sorted((r.tree, r.node, r.feature or "", r.threshold or 0.0, r.value, r.cover) for r in model.nodes.collect())
    assert got == sorted((t, n, f or "", float(c or 0.0), v, float(h)) for t, n, f, c, v, h in nodes)
    for r in boosting.predict(model, frame).where("y is not null").collect():
        assert r.prediction == pytest.approx(history[-1][r.id], abs=1e-9)
    late = [r for r in rows if r[5]]
    for r in model.rounds.collect():
        e = [x[4] - history[r["round"] - 1][x[0]] for x in late]
        y = np.array([x[4] for x in late])
        assert (r.rmse, r.mae) == pytest.approx((math.sqrt(np.mean(np.square(e))), np.mean(np.abs(e))), rel=1e-5)
        assert r.r2 == pytest.approx(1 - np.mean(np.square(e)) / y.var(), abs=1e-5)
        assert r.mape == pytest.approx(100 * np.mean(np.abs(e / y)), rel=1e-5)
    assert model.rounds.count() == rounds


def test_model_does_not_depend_on_layout(frame):
    one, two = (boosting.boost(d, ["id"], FEATURES, "y", rounds=6, depth=3, max_bins=16).nodes.collect() for d in (frame, frame.repartition(11)))
    assert sorted(map(str, one)) == sorted(map(str, two))


def test_early_stopping_keeps_the_best_rounds(spark):
    r = random.Random(1)
    d = spark.createDataFrame([(i, r.random(), r.random(), 0.0, r.random(), i % 2 == 0) for i in range(120)], SCHEMA)
    model = boosting.boost(d, ["id"], FEATURES, "y", rounds=60, depth=4, step=0.5, valid="late", patience=4, chunk=7)
    losses = [r.rmse for r in model.rounds.orderBy("round").collect()]
    best = int(np.argmin(losses)) + 1
    assert len(losses) == best + 4 < 60 and model.nodes.agg(F.max("tree")).first()[0] == best
    whole = boosting.boost(d, ["id"], FEATURES, "y", rounds=len(losses), depth=4, step=0.5, valid="late")
    assert [r.rmse for r in whole.rounds.orderBy("round").collect()] == losses


def test_penalty_constant_and_empty(spark):
    d = spark.createDataFrame([(i, float(i % 2), 0.0, 0.0, float(i % 2), None) for i in range(40)], SCHEMA)
    free, held = (boosting.boost(d, ["id"], FEATURES, "y", rounds=1, depth=1, rows=1.0, columns=1.0, l2=l2).nodes for l2 in (0.0, 20.0))
    assert [round(r.value, 6) for r in free.where("node > 1").orderBy("node").collect()] == [-0.05, 0.05]
    assert [round(r.value, 6) for r in held.where("node > 1").orderBy("node").collect()] == [-0.025, 0.025]
    same = boosting.boost(d.withColumn("y", F.lit(2.0)), ["id"], FEATURES, "y", rounds=2)
    assert same.nodes.count() == 2 and boosting.predict(same, d).first().prediction == pytest.approx(2.0)
    with pytest.raises(ValueError):
        boosting.boost(d.limit(0), ["id"], FEATURES, "y")


@pytest.mark.parametrize("kind", ["forest", "boosted"])
def test_tables_of_fitted_models(frame, kind):
    d = frame.where("y is not null and b is not null and not isnan(b)")
    pipe = (models.random_forest(FEATURES, "y", num_trees=5, max_depth=4) if kind == "forest"
            else models.gradient_boosting(FEATURES, "y", rounds=5, max_depth=3))
    model = models.fit(pipe, d)
    nodes = trees.of_model(model, FEATURES)
    assert nodes.columns == trees.COLUMNS and nodes.where("node = 1").count() == 5
    whole = model.transform(d).select("id", F.col("prediction").alias("whole"))
    joined = trees.scores(nodes, d, FEATURES, ["id"], "joined").join(whole, "id").join(trees.predict(nodes, d.select("id", *FEATURES), FEATURES), "id").collect()
    assert len(joined) == d.count()
    assert all(r.joined == pytest.approx(r.whole) and r.prediction == pytest.approx(r.whole) for r in joined)
    last = trees.round_scores(nodes, d, FEATURES, ["id"], "y")
    top = last.agg(F.max("round")).first()[0]
    ends = {r.id: r.predicted for r in last.where(F.col("round") == top).collect()}
    assert all(ends[r.id] == pytest.approx(r.whole) for r in joined)
    by_feature = {r.feature: r for r in trees.importance(nodes, [*FEATURES, "unused"]).collect()}
    assert by_feature["unused"].weight == 0 and sum(r.share for r in by_feature.values()) == pytest.approx(1)
    assert sum(r.weight for r in by_feature.values()) == nodes.where("feature is not null").count()


def test_levels_as_jobs_give_the_model_of_one_task(frame):
    """Across updates of the predictions and chunks. Tasks that waited for each other took over a second a level."""
    def told(tasks, **more):
        m = boosting.boost(frame, ["id"], FEATURES, "y", rounds=12, depth=4, valid="late", tasks=tasks, **more)
        return sorted(map(tuple, m.nodes.collect()), key=str), [tuple(r) for r in m.rounds.orderBy("round").collect()]
    one = told(1)
    start = time.monotonic()
    assert told(3, chunk=10) == one
    assert time.monotonic() - start < 40
    assert told(3, patience=2) == told(1, patience=2, chunk=5)


def test_blocks_are_read_as_they_come(monkeypatch):
    """A task holds one block of rows, however many its partition has."""
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 100)
    seen = []

    def blocks():
        for i in range(50):
            seen.append(i)
            n = 40
            yield boosting._Rows(np.full((2, n), i, np.uint8), np.arange(n) + 0.5, np.zeros(n), np.arange(n, dtype=np.uint64), np.arange(n) % 2 == 0).packed()
    rows = boosting._joined(blocks(), 2)
    first = next(rows)
    assert len(first.y) == 120 and len(seen) == 3 and first.bins[1, 119] == 2 and first.y[40] == 0.5
    assert sum(len(r.y) for r in rows) == 50 * 40 - 120


@pytest.mark.parametrize("levels", [3, 9])
def test_descend_equals_a_walk(levels):
    """Early leaves, levels of many splits, missing values to the left."""
    r = np.random.default_rng(levels)
    feature, cut = np.full(2 << levels, -1), np.zeros(2 << levels)
    for n in range(1, 1 << levels):
        if (n == 1 or feature[n // 2] >= 0) and (n < 4 or r.random() < 0.95):
            feature[n], cut[n] = r.integers(3), r.random()
    assert levels < 9 or (feature[256:512] >= 0).sum() > trees._NARROW
    x, value = r.random((3, 500)), r.random(2 << levels)
    x[0, :50] = np.nan
    got = trees.leaves(feature, value, levels)[trees.descend(x, feature, cut, levels)]
    for i in range(500):
        n = 1
        while feature[n] >= 0:
            n = 2 * n + int(x[feature[n], i] > cut[n])
        assert got[i] == value[n]


def test_rows_of_one_file_go_down_the_trees_in_many_tasks(spark):
    """Joins ran in as many tasks as the rows had files."""
    nodes = trees.node_table(spark, [(t, n, "a" if n == 1 else None, 0.5 if n == 1 else None, float(n * t), 0.0, 1.0) for t in (1, 2) for n in (1, 2, 3)])
    d = spark.createDataFrame([(i if i else None, i % 2 + 0.0) for i in range(100)] + [(7, 0.0)], "id long, a double").coalesce(1)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        told = trees.outputs(nodes, d, ["a"], ["id"]).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len({r.task for r in told}) > 1
    want = [(i if i else None, t, t * (2.0 + i % 2)) for i in range(100) for t in (1, 2)] + [(7, 1, 2.0), (7, 2, 4.0)]
    assert sorted(((r.id, r.tree, r.value) for r in told), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("depth", [1, 3, 6])
def test_sets_of_leaves_equal_a_walk(depth):
    """Walking every waiting tree was most of a round's first job."""
    r = np.random.default_rng(depth)
    s = boosting.Settings([np.arange(k - 1.0) for k in (64, 256, 1, 5, 40)], depth, 0.1, 1.0, 1.0, 1.0, 0.0, 1, 42, 1.0)
    bins = np.array([r.integers(0, len(c) + 1, 3000) for c in s.cuts], dtype=np.uint8)
    grown = []
    for _ in range(3):
        nodes, waiting = [], [1]
        while waiting:
            n = waiting.pop()
            f = int(r.integers(5)) if n < 1 << depth and (n == 1 or r.random() < 0.9) else -1
            f = -1 if f >= 0 and not len(s.cuts[f]) else f
            nodes.append((n, f, int(r.integers(len(s.cuts[f]))) if f >= 0 else 0, r.random(), 0.0, 1.0))
            waiting += [2 * n, 2 * n + 1] if f >= 0 else []
        grown.append(np.array(nodes))
    want, got = np.zeros(3000), np.zeros(3000)
    for nodes in grown:
        want += boosting.leaf_values(bins, nodes, depth)
    boosting.Leaves(grown, s).add(bins, got)
    assert (got == want).all() and len(set(got)) > depth


def test_rows_are_written_before_labels_are_looked_at(frame, monkeypatch):
    """A condition on a computed label made Spark compute it a second time for every row, without common parts."""
    plans = []

    def noted(df, name="side"):
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return kept(df, name)
    kept = boosting.materialize
    monkeypatch.setattr(boosting, "materialize", noted)
    labelled = frame.withColumn("y", F.col("y") * 2 + 1)
    model = boosting.boost(labelled, ["id"], FEATURES, "y", rounds=1, depth=1, rows=1.0)
    assert "Filter" not in dict(plans)["given"]
    assert model.nodes.where("node = 1").first().cover == 400  # the row without a label is left out
