from __future__ import annotations

import random

import numpy as np
import pytest

from panelspark.operators import leastsquares, sketches

FEATURES = ["a", "b", "c"]


def table():
    r = random.Random(1)
    rows = []
    for i in range(400):
        g, a, b = r.choice(["x", "x", "y", None]), r.random() * 100, r.random()
        rows.append((g, i % 5, a, b, None if i % 50 == 0 else r.random() - 5, 3 * a - 40 * b + 7 + r.random() + (g == "x") * a))
    rows += [("one", 0, 1.0, 2.0, 3.0, 4.0), ("flat", 0, 1.0, 2.0, 3.0, 4.0), ("flat", 1, 1.0, 3.0, 5.0, 6.0), ("nan", 1, float("nan"), 1.0, 1.0, 1.0)]
    return rows


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(table(), "g string, day int, a double, b double, c double, y double").repartition(4).cache()


def fitted(rows):
    x = np.array([[1, *r[2:5]] for r in rows])
    y = np.array([r[5] for r in rows])
    return np.linalg.lstsq(x, y, rcond=None)[0]


def test_each_group_solves_its_normal_equations(frame):
    solved = leastsquares.solve(leastsquares.gram(frame, ["g"], FEATURES, "y"), ["g"], FEATURES)
    got = {}
    for r in solved.collect():
        got.setdefault(r.g, {})[r.feature] = r
    assert set(got) == {"x", "y", None, "one", "flat"}
    for g in ("x", "y", None):
        rows = [r for r in table() if r[0] == g and r[4] is not None]
        beta = np.array([got[g][f].coefficient for f in ("intercept", *FEATURES)])
        assert got[g]["a"].n == len(rows) and got[g]["a"].rank == 3
        np.testing.assert_allclose(beta, fitted(rows), rtol=1e-6, atol=1e-6)
    assert got["one"]["a"].coefficient == 0 and got["one"]["intercept"].coefficient == 4
    flat = {f: r.coefficient for f, r in got["flat"].items()}
    assert flat["a"] == 0 and got["flat"]["b"].rank == 1
    assert flat["intercept"] + flat["b"] * 2 + flat["c"] * 3 == pytest.approx(4)


def test_days_add_up_and_are_brought_up_to_date(frame):
    whole = leastsquares.solve(leastsquares.gram(frame, [], FEATURES, "y"), [], FEATURES).collect()
    daily = leastsquares.gram(frame.where("day < 3"), ["day"], FEATURES, "y")
    later = leastsquares.gram(frame.where("day >= 3"), ["day"], FEATURES, "y")
    merged = leastsquares.solve(leastsquares.merge(daily.unionByName(later), []), [], FEATURES).collect()
    assert {r.feature: round(r.coefficient, 6) for r in whole} == {r.feature: round(r.coefficient, 6) for r in merged}


def test_predictions_and_empty(frame):
    solved = leastsquares.solve(leastsquares.gram(frame, ["g"], FEATURES, "y"), ["g"], FEATURES)
    out = leastsquares.predict(frame, solved, ["g"], FEATURES)
    assert out.count() == frame.count() and out.where("g = 'nan' and predicted is not null").count() == 0
    assert out.where("g is null and c is not null and predicted is null").count() == 0
    assert out.where("g = 'y' and abs(predicted - y) > 1").count() == 0
    assert leastsquares.solve(leastsquares.gram(frame.limit(0), ["g"], FEATURES, "y"), ["g"], FEATURES).collect() == []


def test_merged_sketches_keep_their_error(spark):
    r = random.Random(2)
    rows = [(r.choice("xxy"), i % 9, r.choice([r.gauss(0, 1), 1.0])) for i in range(30_000)] + [("x", 1, None), ("z", 1, None), ("y", 2, float("nan"))]
    d = spark.createDataFrame(rows, "g string, day int, v double").repartition(6)
    daily = sketches.sketch(d, ["g", "day"], "v").cache()
    shares = [0.0, 0.1, 0.5, 0.9, 1.0]
    for by, days in ((["g"], range(9)), ([], range(9)), (["g"], (2, 3))):
        told = sketches.quantiles(sketches.merge(daily.where(daily.day.isin(*days)), by), by, shares).collect()
        assert {getattr(t, "g", None) for t in told} == ({"x", "y"} if by else {None})
        for t in told:
            values = np.array([v for g, day, v in rows if day in days and (not by or g == t.g) and v is not None and v == v])
            assert t.n == len(values) and t.quantile in values
            assert (values < t.quantile).mean() <= t.share + sketches.rank_error() and (values <= t.quantile).mean() >= t.share - sketches.rank_error()
    at = sketches.ranks(sketches.merge(daily, []), [], [-9.0, 1.0, 9.0]).orderBy("value").collect()
    assert [round(r["rank"], 2) for r in at][::2] == [0.0, 1.0] and 0.8 < at[1]["rank"] < 1
    assert sketches.quantiles(sketches.sketch(d.limit(0), ["g"], "v"), ["g"], shares).collect() == []
