from __future__ import annotations

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from panelspark import runtime
from panelspark.operators import correlation, histogram, joins, quality, quantiles, ranking, sampling, summary


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def interpolated(values, p):
    v = sorted(values)
    pos = (len(v) - 1) * p
    lo, hi = math.floor(pos), math.ceil(pos)
    return v[lo] + (v[hi] - v[lo]) * (pos - lo)


@pytest.mark.parametrize("small", [0, 10**9])
def test_quantiles_match_sorted_values(spark, small):
    rng = random.Random(3)
    data = {"a": [rng.lognormvariate(0, 4) for _ in range(500)], "b": [1.5] * 40, "c": [float(rng.randint(0, 5)) for _ in range(333)],
            "d": [7.0], "e": [-3.0, 8.0], "f": [0.0] * 5 + [1e300, -1e300, 1e-300, -1e-300]}
    recs = [(k, v) for k, vs in data.items() for v in vs] + [("a", None), ("g", None), (None, 1.0), ("c", float("nan"))]
    df = spark.createDataFrame(recs, "k string, v double").repartition(5)
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r.k: r for r in quantiles.exact_quantiles(df, ["v"], probs, ["k"], small_group=small).collect()}
    assert sorted(got) == sorted(data)
    for k, vs in data.items():
        assert got[k].n == len(vs)
        assert got[k].q == pytest.approx([interpolated(vs, p) for p in probs], rel=1e-12), k


def test_quantiles_recut_large_cells(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "SORT_ROW_LIMIT", 3)
    rng = random.Random(5)
    vs = [rng.lognormvariate(0, 5) for _ in range(2000)] + [4.25] * 700
    df = spark.createDataFrame([(v,) for v in vs], "v double")
    q = quantiles.exact_quantiles(df, ["v"], [0.1, 0.5, 0.77], small_group=0).first().q
    assert q == pytest.approx([interpolated(vs, p) for p in (0.1, 0.5, 0.77)], rel=1e-12)


def test_quantiles_with_infinities(spark):
    vs = [float("-inf"), -1.0, 0.0, 2.0, 3.0, 4.0, float("inf")]
    df = spark.createDataFrame([(v,) for v in vs], "v double")
    q = quantiles.exact_quantiles(df, ["v"], [0.25, 0.5, 0.75], small_group=0).first().q
    assert q == [-0.5, 2.0, 3.5]


def test_fill_group_median(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 4.0), ("a", None), ("b", None), ("c", 9.0), ("c", float("nan")), (None, None), (None, 2.0)],
                               "g string, v double")
    got = sorted(((r.g or "~"), r.v) if r.v is not None else ((r.g or "~"), -1.0) for r in quantiles.fill_group_median(df, ["g"], ["v"]).collect())
    assert got == [("a", 1.0), ("a", 2.5), ("a", 4.0), ("b", -1.0), ("c", 9.0), ("c", 9.0), ("~", -1.0), ("~", 2.0)]


def test_describe_single_row(spark):
    r = quantiles.describe(spark.createDataFrame([(3.0,)], "v double"), ["v"]).first()
    assert (r["count"], r["mean"], r["std"], r["p50"]) == (1, 3.0, None, 3.0)


@pytest.mark.parametrize("small", [0, 10**9])
def test_describe_without_values(spark, small):
    df = spark.createDataFrame([(None, 1.0), (float("nan"), 2.0)], "a double, b double")
    got = {r.variable: r for r in quantiles.describe(df, ["a", "b"], small_group=small).collect()}
    assert (got["a"]["count"], got["a"]["mean"], got["a"].p50) == (0, None, None)
    assert (got["b"]["count"], got["b"].p25, got["b"]["max"]) == (2, 1.25, 2.0)


def test_approx_quantiles(spark):
    df = spark.range(10_001).select(F.col("id").cast("double").alias("v"))
    q = quantiles.quantiles(df, ["v"], [0.5], accuracy=1000).first().q
    assert abs(q[0] - 5000) <= 20


def test_box_stats(spark):
    data = [("one", 5.0)] + [("flat", 2.0)] * 4 + [("wide", float(v)) for v in [*range(10, 31), -100, 200]]
    df = spark.createDataFrame(data, "g string, v double")
    got = {r.g: r for r in quantiles.box_stats(df, ["g"], "v").collect()}
    assert (got["one"].q1, got["one"].whisker_low, got["one"].outliers) == (5.0, 5.0, 0)
    assert (got["flat"].whisker_high, got["flat"].outliers) == (2.0, 0)
    assert (got["wide"].whisker_low, got["wide"].whisker_high, got["wide"].outliers, got["wide"].n) == (10.0, 30.0, 2, 23)


def test_correlation_properties(spark):
    rng = random.Random(1)
    data = [(float(i), 2.0 * i + 5, rng.random(), 4.0, None if i % 3 else rng.random() + 1e9) for i in range(300)]
    df = spark.createDataFrame(data, "a double, b double, c double, k double, m double").repartition(4)
    cols = ["a", "b", "c", "k", "m"]
    full = {(r.x, r.y): r.r for r in correlation.correlation_matrix(df, cols).collect()}
    assert len(full) == 25
    assert all(v is None or abs(v) <= 1 for v in full.values())
    assert all(full[x, y] == full[y, x] for x in cols for y in cols)
    assert full["a", "b"] == pytest.approx(1.0) and full["k", "a"] is None and full["k", "k"] is None
    pairs = [(d[0], d[4]) for d in data if d[4] is not None]
    assert full["a", "m"] == pytest.approx(statistics.correlation(*zip(*pairs)), abs=1e-6)
    low = {(r.x, r.y) for r in correlation.correlation_matrix(df, cols, triangle=True).collect()}
    assert low == {(cols[i], cols[j]) for i in range(5) for j in range(i)}


def test_pearson_edge_cases(spark):
    df = spark.createDataFrame([("flat", 1.0, 2.0), ("flat", 3.0, 2.0), ("one", 1.0, 1.0), ("two", 1.0, 5.0), ("two", 2.0, 3.0)],
                               "g string, x double, y double")
    got = {r.g: r.r for r in correlation.pearson(df, "x", "y", ["g"]).collect()}
    assert got["flat"] is None and got["one"] is None and got["two"] == pytest.approx(-1.0)


def test_target_correlations_keeps_constant_target(spark):
    df = spark.createDataFrame([(1.0, 5.0, 7.0), (1.0, 6.0, 7.0), (1.0, 9.0, 7.0)], "t double, f double, k double")
    got = {(r.x, r.y): r.r for r in correlation.target_correlations(df, "t", ["f", "k"]).collect()}
    assert got == {("t", "t"): 0.0, ("t", "f"): 0.0, ("f", "t"): 0.0, ("f", "f"): 1.0}


def test_line(spark):
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 3.0), (4.0, 9.0), (None, 3.0)], "x double, y double")
    fit = correlation.fit_line(df, "x", "y")
    pts = [(r.x, r.y) for r in correlation.line_points(fit, 5).orderBy("i").collect()]
    assert [x for x, _ in pts] == [0.0, 1.0, 2.0, 3.0, 4.0]
    assert [y for _, y in pts] == pytest.approx([1.0, 3.0, 5.0, 7.0, 9.0])


def test_histogram(spark):
    df = spark.createDataFrame([(0.0, 3.0), (1.0, 3.0), (1.0, 3.0), (9.9, 3.0), (10.0, 3.0), (None, 3.0)], "v double, flat double")
    got = histogram.histogram(df, ["v", "flat"], 5).collect()
    by = {(r.variable, r.bin): r["count"] for r in got}
    assert [by["v", i] for i in range(1, 6)] == [3, 0, 0, 0, 2]
    assert sum(by["flat", i] for i in range(1, 6)) == 6
    edges = sorted((r.bin_low, r.bin_high) for r in got if r.variable == "flat")
    assert edges[0][0] == 2.5 and edges[-1][1] == 3.5


def test_adaptive_bins(spark):
    got = spark.createDataFrame([(n,) for n in (1, 7, 14, 30, 100)], "n int").select(histogram.adaptive_bins(F.col("n"))).collect()
    assert [r[0] for r in got] == [5, 5, 7, 15, 20]


@pytest.mark.parametrize("n", [0, 1, 4, 5, 10, 1003])
def test_exact_split_counts(spark, n):
    df = spark.range(n)
    marked = sampling.exact_split(df, 0.2, ["id"])
    test = [r.id for r in marked.where("is_test").collect()]
    assert len(test) == math.ceil(0.2 * n)
    again = sampling.exact_split(df.repartition(7), 0.2, ["id"]).where("is_test")
    assert sorted(test) == sorted(r.id for r in again.collect())


@pytest.mark.parametrize("n", [0, 1, 9, 400, 900])
def test_sample_size(spark, n):
    df = spark.range(400)
    got = {r.id for r in sampling.sample_rows(df, n, ["id"]).collect()}
    assert len(got) == min(n, 400)
    assert got == {r.id for r in sampling.sample_rows(df.repartition(3), n, ["id"]).collect()}


def test_samples_nest_and_split_is_their_complement(spark):
    df = spark.range(1000)
    a = {r.id for r in sampling.sample_rows(df, 100, ["id"]).collect()}
    b = {r.id for r in sampling.sample_rows(df, 200, ["id"]).collect()}
    assert a < b == {r.id for r in sampling.exact_split(df, 0.2, ["id"]).where("is_test").collect()}


def test_shuffle_keeps_rows(spark):
    got = [r.id for r in sampling.shuffle_rows(spark.range(200), ["id"]).collect()]
    assert sorted(got) == list(range(200)) and got != list(range(200))


def test_rank_rows(spark):
    df = spark.createDataFrame([(i, float(i % 3)) for i in range(500)], "id int, v double").repartition(6)
    got = [(r.id, r.v) for r in ranking.rank_rows(df, [F.desc("v"), F.col("id")]).orderBy("rank").collect()]
    assert got == sorted(((i, float(i % 3)) for i in range(500)), key=lambda t: (-t[1], t[0]))
    assert ranking.rank_rows(df.where("id < 0"), [F.col("id")]).count() == 0


def test_label_encode_binary_order(spark):
    df = spark.createDataFrame([("b",), ("A",), (None,), ("a",), ("B",), ("b",)], "c string")
    out, maps = ranking.label_encode(df, ["c"])
    assert {(r.c, r.c_enc) for r in out.collect()} == {("A", 0), ("B", 1), ("a", 2), ("b", 3), (None, -1)}
    assert rows(maps["c"]) == [("A", 0), ("B", 1), ("a", 2), ("b", 3)]


def with_broadcast(spark, limit, run):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        return run()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("limit", ["-1", "10m"])
def test_joins_agree_with_and_without_broadcast(spark, limit):
    df = spark.createDataFrame([("hot", i, {"a": i}) for i in range(300)] + [("x", 1, {}), ("lost", 2, None)],
                               "k string, v int, m map<string,int>")
    side = spark.createDataFrame([("hot", 10), ("x", 20)], "k string, w int")
    dim = spark.range(100, 125).withColumnRenamed("id", "d")

    def run():
        left = runtime.attach(df, side, ["k"], "left")
        return left.count(), left.where("w is null").count(), joins.cross_expand(df, dim).count()
    assert with_broadcast(spark, limit, run) == (302, 1, 302 * 25)


def test_side_by_side_refuses_two_rows_for_one_cell(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "a", 9.0), (1, "b", 2.0)], "k int, s string, v double")
    with pytest.raises(Exception, match="several rows"):
        joins.side_by_side(df, "k", "s", "v", ["a", "b"]).collect()


def test_undefined_correlations_are_null(spark):
    inf = float("inf")
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 3.5), (3.0, 4.0), (inf, None)], "a double, b double")
    r = {(x.x, x.y): x.r for x in correlation.correlation_matrix(df, ["a", "b"]).collect()}
    expected = correlation.pearson(df, "a", "b").first().r
    assert r["a", "b"] == pytest.approx(expected) and r["a", "a"] is None and r["b", "b"] == 1.0
    wild = spark.createDataFrame([(1.0, inf), (2.0, 3.5), (3.0, 4.0)], "a double, b double")
    assert {x.r for x in correlation.correlation_matrix(wild, ["a", "b"], triangle=True).collect()} == {None}
    huge = spark.createDataFrame([(1e200, 1e200), (-1e200, 3.0), (3.0, 4.0)], "a double, b double")
    assert {x.r for x in correlation.correlation_matrix(huge, ["a", "b"], triangle=True).collect()} == {None}


def test_both_quantile_paths_give_the_same_bits(spark):
    inf, r = float("inf"), random.Random(4)
    groups = {"plain": [r.uniform(-5, 5) for _ in range(101)], "low": [-inf, 5.0], "wide": [-1.7e308, 1.7e308], "one": [3.0],
              "ties": [1.0, 1.0, 2.0, 2.0], "ends": [-inf, inf, 0.0]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v double")
    probs = [i / 37 for i in range(38)] + [0.25, 0.5, 0.75]
    small = {x.g: x.q for x in quantiles.exact_quantiles(df, ["v"], probs, ["g"]).collect()}
    counted = {x.g: x.q for x in quantiles.exact_quantiles(df.repartition(7), ["v"], probs, ["g"], small_group=0).collect()}
    assert {g: list(map(repr, q)) for g, q in small.items()} == {g: list(map(repr, q)) for g, q in counted.items()}


def test_repeated_keys_at_the_cut_are_an_error(spark):
    df = spark.range(100).selectExpr("id div 50 k")
    with pytest.raises(ValueError, match="does not identify"):
        sampling.sample_rows(df, 10, ["k"])


def test_infinities_have_no_bins_and_numbers_no_labels(spark):
    df = spark.createDataFrame([(1.0,), (float("inf"),)], "v double")
    with pytest.raises(Exception, match="infinity"):
        histogram.histogram(df, ["v"], 4).collect()
    with pytest.raises(ValueError, match="not texts"):
        ranking.label_encode(df, ["v"])


def test_lookup_defaults(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    dim = spark.createDataFrame([("a", 1)], "k string, n int")
    assert rows(joins.lookup(df, dim, "k", {"n": 9}).select("n")) == [(1,), (9,), (9,)]


def test_extreme_rows_first_wins(spark):
    df = spark.createDataFrame([("s", "d3", 5.0), ("s", "d1", 5.0), ("s", "d2", 1.0), ("s", "d4", 1.0), ("s", "d0", None)], "s string, d string, v double")
    assert rows(summary.extreme_rows(df, "v", "d", ["d", "v"], ["s"])) == [("s", "d1", 5.0, "d2", 1.0)]


def test_counts(spark):
    df = spark.createDataFrame([(1.0, "a"), (1.0, "a"), (float("nan"), None)], "x double, y string")
    assert {r.column_name: r.nulls for r in summary.null_counts(df).collect()} == {"x": 1, "y": 1}
    assert tuple(summary.duplicate_count(df).first()) == (3, 2, 1)
    assert summary.total_nulls(df).first()[0] == 2
    assert tuple(summary.duplicate_count(df.limit(0)).first()) == (0, 0, 0)
    p = summary.profile(df.withColumn("d", F.make_date(F.lit(2024), F.lit(2), F.lit(29))), "d", ["y"], "x").first()
    assert (p.row_count, p.missing_values, p.duplicate_rows, p.distinct_y, p.first_date) == (3, 2, 1, 1, "2024-02-29")


def test_month_and_group_means_skip_null_keys(spark):
    df = spark.createDataFrame([("a", 2, 1.0), ("a", 2, 3.0), (None, None, 9.0), ("b", 11, 5.0)], "g string, m int, v double")
    assert [tuple(r) for r in summary.group_mean(df, ["g"], "v").collect()] == [("b", 5.0), ("a", 2.0)]
    assert [tuple(r) for r in summary.month_mean(df, "m", "v").collect()] == [(2, "Feb", 2.0), (11, "Nov", 5.0)]


def test_share_of_zero_total(spark):
    df = spark.createDataFrame([(1.0,), (-1.0,)], "v double")
    assert [r.share for r in summary.share(df, "v").collect()] == [None, None]


def test_quality(spark):
    good = spark.range(10)
    quality.require(good, min_rows=10)
    with pytest.raises(quality.ValidationError, match="min_rows: observed 10"):
        quality.require(good, min_rows=11)
    bad = spark.createDataFrame([(None,), (1,)], "v int")
    with pytest.raises(quality.ValidationError, match="no_nulls: observed 1"):
        quality.require(bad, min_rows=None)
    assert rows(quality.checks(good.limit(0), 1)) == [("min_rows", False, 0), ("no_nulls", True, 0)]


def test_clean_audit_matches_clean(spark):
    raw = spark.createDataFrame([("1", "2.5", "2023-01-02"), ("1", "2.5", "02-01-2023"), ("2", "x", "2023-01-02"), ("3", "4", "bad"), ("4", "1", "2024-02-29")],
                                "k string, v string, d string")
    types = {"k": "int", "v": "double"}
    assert quality.clean(raw, types, ["d"]).count() == 2
    assert {r.stage: r.row_count for r in quality.clean_audit(raw, types, ["d"]).collect()} == {"loaded": 5, "deduplicated": 4, "complete": 2}


def test_stage_counts(spark):
    got = summary.stage_counts({"a": spark.range(3), "b": spark.range(0)}).orderBy("step").collect()
    assert [tuple(r) for r in got] == [(0, "a", 3, 1), (1, "b", 0, 1)]
