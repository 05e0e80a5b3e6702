"""The whole chain on a small waste panel: payloads to forecast tables."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from panelspark.functions import fixed_values as fv
from panelspark.operators import quality
from panelspark.plans import eda, evaluation, forecast, models, waste
from panelspark.runtime import materialize, scratch_path
from panelspark.sources import dimensions, readers, writers

DAYS = 40


def payload(i: int) -> str:
    days = [str(dt.date(2023, 12, 10) + dt.timedelta(d)) for d in range(DAYS)]
    codes = sorted(fv.WMO_LABELS)
    return json.dumps({"daily": {
        "time": days,
        "temperature_2m_max": [None if d % 17 == 3 else 20 + (i * 7 + d * 3) % 19 + 0.5 for d in range(DAYS)],
        "relative_humidity_2m_max": [None if d % 19 == 5 else 40.0 + (i * 5 + d) % 50 for d in range(DAYS)],
        "weathercode": [None if d % 23 == 1 else codes[(i + d) % len(codes)] for d in range(DAYS)]}})


@pytest.fixture(scope="module")
def weather(spark):
    rows = [(c[0], c[3], payload(i)) for i, c in enumerate(fv.CITIES)]
    df = spark.createDataFrame(rows, "location string, population bigint, payload string")
    return readers.weather_rows(df, "payload")


@pytest.fixture(scope="module")
def raw(weather):
    return materialize(waste.build_raw(weather))


@pytest.fixture(scope="module")
def engineered(raw):
    df, maps = waste.engineer(raw)
    return materialize(df), maps


def test_weather_rows(weather):
    assert weather.count() == 18 * DAYS
    assert weather.columns == ["location", "population", "date", "temperature", "humidity", "weather_code"]


def test_read_weather_files(spark, weather):
    path = scratch_path(spark, "weather_json")
    lines = [json.dumps({"location": c[0], "population": c[3], **json.loads(payload(i))}) for i, c in enumerate(fv.CITIES)]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    got = readers.read_weather(spark, path)
    assert sorted(got.columns) == sorted(weather.columns)
    assert got.select(weather.columns).exceptAll(weather).count() == 0


def test_raw_panel(raw):
    assert raw.columns == fv.RAW_COLUMNS
    assert raw.count() == 18 * DAYS * 20
    quality.require(raw, min_rows=14_000)
    r = raw.agg(F.min("waste_amount"), F.max("waste_amount"), F.min("pollution_index"), F.max("pollution_index")).first()
    assert 50 <= r[0] and r[1] == 1000 and 20 <= r[2] and r[3] <= 500
    means = {x.sector: x.m for x in raw.groupBy("sector").agg(F.avg("waste_amount").alias("m")).collect()}
    assert means["Industrial"] > means["Commercial"] > means["Residential"] > means["Healthcare"]


def test_raw_panel_is_reproducible(weather, raw):
    again = waste.build_raw(weather.repartition(5))
    assert again.exceptAll(raw).count() == 0
    assert waste.shuffled(raw).limit(50).count() == 50


def test_stored_measures_replace_expected_values(spark, weather, raw):
    """Amounts of a cell add up, the highest index counts, bounds hold; what is not measured stays as expected."""
    schema = "location string, date string, sector string, zone string, waste_amount double, pollution_index double"
    day = "2023-12-12"
    rows = [("Delhi", day, "Healthcare", "North", 60.1, 90.0), ("Delhi", day, "Healthcare", "North", 60.2, 70.0),
            ("Delhi", day, "Healthcare", "South", 5000.0, float("nan")), ("Delhi", day, "Healthcare", "East", None, 3.0),
            ("Atlantis", day, "Healthcare", "North", 60.1, 90.0), ("Delhi", "1999-01-01", "Healthcare", "North", 60.1, 90.0),
            (None, day, "Healthcare", "North", 60.1, 90.0)]
    got = waste.build_raw(weather, spark.createDataFrame(rows, schema))
    assert got.count() == raw.count() and got.columns == raw.columns
    key = {}
    for name, df in (("got", got), ("raw", raw)):
        for r in df.where(f"location = 'Delhi' and date = '{day}' and sector = 'Healthcare'").collect():
            key[r.zone, name] = (r.waste_amount, r.pollution_index)
    assert key["North", "got"] == (120.3, 90.0) and key["South", "got"] == (1000.0, key["South", "raw"][1])
    assert key["East", "got"] == (key["East", "raw"][0], 20.0) and key["West", "got"] == key["West", "raw"]
    assert got.exceptAll(raw).count() <= 3
    none = waste.build_raw(weather, spark.createDataFrame([], schema))
    assert none.exceptAll(raw).count() == 0 and none.count() == raw.count()


def test_expected_values(raw):
    r = raw.where("location = 'Bangalore' and sector = 'Healthcare' and zone = 'West' and temperature is not null").first()
    assert r.waste_amount == pytest.approx(13_190_000 * 0.00005 + r.temperature * 0.5 + r.humidity * 0.1 + 80 * 0.98, abs=0.2)
    assert r.pollution_index == pytest.approx(85 + (r.humidity - 60) * 0.3, abs=0.2)


def test_engineered_columns_and_codes(engineered):
    df, maps = engineered
    assert df.columns == fv.CLEAN_COLUMNS
    quality.require(df, min_rows=14_000)
    for name, expected in (("location", dimensions.city_names()), ("sector", dimensions.sector_names()),
                           ("zone", dimensions.zone_names())):
        assert [r.value for r in maps[name].orderBy("code").collect()] == expected
        assert df.where(F.col(f"{name}_enc") != F.array_position(F.array(*map(F.lit, expected)), F.col(name)) - 1).count() == 0
    assert {r.season for r in df.select("season").distinct().collect()} == {"Winter"}
    types = dict(df.dtypes)
    assert (types["temperature"], types["humidity"], types["month"], types["population"]) == ("float", "smallint", "tinyint", "bigint")
    delhi = df.where("location = 'Delhi'").first()
    assert delhi.population_density == pytest.approx(32_940_000 / 1484, rel=1e-6)


def test_capped_values_are_repaired(raw, engineered):
    capped = raw.where("waste_amount = 1000").count()
    fixed = engineered[0].where("waste_amount > 1000").count()
    assert capped > 0 and 0 < fixed <= capped
    assert engineered[0].agg(F.max("waste_amount")).first()[0] <= 1200
    flagged = waste.repair_cap(raw)
    assert flagged.where("was_capped").count() == capped
    assert flagged.where("was_capped and (waste_amount < 800 or waste_amount > 1200)").count() == 0


def test_csv_hand_over_and_spark_clean(spark, engineered):
    path = scratch_path(spark, "cleaned")
    df = engineered[0]
    writers.write_csv(df.unionByName(df.limit(7)), path)
    text = readers.read_csv(spark, path)
    assert set(dict(text.dtypes).values()) == {"string"}
    cleaned = waste.clean(text)
    assert cleaned.count() == df.count() and dict(cleaned.dtypes)["date"] == "date"
    audit = {r.stage: r.row_count for r in waste.clean_audit(text).collect()}
    assert audit == {"loaded": df.count() + 7, "deduplicated": df.count(), "complete": df.count()}
    ml = waste.ml_ready(cleaned)
    assert ml.columns == [*fv.FEATURES, "waste_amount"]


def test_exploration_tables(engineered):
    df = engineered[0]
    tables = eda.exploration(waste.ml_ready(df))
    assert tables["describe"].count() == 5
    assert tables["histograms"].count() == 250
    assert tables["histograms"].agg(F.sum("count")).first()[0] == 5 * df.count()
    assert tables["correlation"].count() == 91
    assert [r.sector_label for r in tables["sector_boxes"].collect()] == fv.SECTOR_BOX_ORDER
    assert tables["temperature_line"].count() == 200
    seen = eda.overview(df)
    assert seen["city_means"].count() == 18 and seen["city_line"].count() == 100
    assert [r.month_name for r in seen["month_means"].collect()] == ["Jan", "Dec"]
    assert [r.sector for r in seen["sector_means"].collect()][0] == "Industrial"


@pytest.fixture(scope="module")
def halves(engineered):
    keyed = engineered[0].withColumn("row", F.concat_ws("|", *waste.PANEL_KEY))
    train, test = models.split(keyed, ["row"])
    return materialize(train), materialize(test)


def test_models_beat_the_mean(spark, halves):
    train, test = halves
    total = train.count() + test.count()
    assert test.count() == -(-total // 5)
    scores = None
    for name, pipe in (("Random Forest", models.random_forest(num_trees=6, max_depth=6)),
                       ("Boosted Trees", models.gradient_boosting(rounds=8, max_depth=4)),
                       ("Linear Reg", models.linear())):
        fitted = models.fit(pipe, train)
        m = evaluation.metrics(models.score(fitted, test)).withColumn("model", F.lit(name))
        assert m.first().r2 > 0.5, name
        scores = m if scores is None else scores.unionByName(m)
        if name == "Boosted Trees":
            losses = [r.mse for r in models.round_losses(fitted, test).orderBy("round").collect()]
            assert len(losses) == 8 and losses[-1] < losses[0]
        if name == "Random Forest":
            imp = models.tree_importance(fitted, fv.FEATURES, spark).orderBy("rank").collect()
            assert imp[0].feature == "population" or imp[0].importance >= imp[1].importance
            assert sum(r.importance for r in imp) == pytest.approx(1.0)
            meta = models.metadata(fitted, fv.FEATURES, fv.TARGET, 42, spark).first()
            assert (meta.num_trees, meta.max_depth, len(meta.feature_importances)) == (6, 6, 14)
    table = evaluation.compare_models(scores, ["Random Forest", "Boosted Trees", "Linear Reg"])
    assert table.count() == 4 and "best" in table.columns


def test_reload_gives_equal_scores(spark, halves):
    train, test = halves
    model = models.fit(models.random_forest(num_trees=3, max_depth=4), train)
    path = scratch_path(spark, "model")
    writers.save_model(model, path)
    a = models.score(model, test, keep=["row"])
    b = models.score(writers.load_model(path), test, keep=["row"])
    assert a.exceptAll(b).count() == 0
    with pytest.raises(FileNotFoundError):
        writers.load_model(path + "-missing")


def test_forecast(spark, halves):
    model = models.fit(models.linear(), halves[0])
    entities = spark.createDataFrame([("Delhi", "Industrial", "Central"), ("Kochi", "Healthcare", "West")],
                                     "location string, sector string, zone string")
    out = forecast.predict_future(entities, model, 14, dt.date(2024, 2, 25))
    assert out.count() == 28
    dates = [r.date for r in out.where("location = 'Delhi'").orderBy("date").collect()]
    assert dates[0] == "2024-02-25" and "2024-02-29" in dates and dates[-1] == "2024-03-09"
    assert out.where("predicted_waste not between 50 and 1200").count() == 0
    series = ["location", "sector", "zone"]
    kpis = forecast.forecast_kpis(out, series)
    level = {r.location: r.alert for r in forecast.alerts(kpis).collect()}
    assert level["Delhi"] == "High" and level["Kochi"] == "Normal"
    assert forecast.peak_and_low(out, series).count() == 2
    both = forecast.compare(out, "location", ["Delhi", "Kochi"])
    assert both.columns == ["date", "Delhi", "Kochi"] and both.count() == 14
    places = forecast.city_map(kpis, dimensions.city(spark))
    assert places.count() == 18 and places.where("level is not null").count() == 2
    assert forecast.feature_correlations(out).count() > 0


def test_scaffold_days(spark):
    e = spark.createDataFrame([("Delhi", "Industrial", "East")], "location string, sector string, zone string")
    one = forecast.future_features(e, 1, dt.date(2023, 12, 31)).first()
    assert (one.date, one.month, one.day_of_week, one.is_weekend, one.season_enc) == ("2023-12-31", 12, 6, 1, 3)
    days = forecast.future_features(e, 3, dt.date(2023, 12, 30)).orderBy("date").collect()
    assert [r.date for r in days] == ["2023-12-30", "2023-12-31", "2024-01-01"]
    unknown = spark.createDataFrame([("Atlantis", "Industrial", "East")], "location string, sector string, zone string")
    with pytest.raises(Exception, match="no code for value: Atlantis"):
        forecast.future_features(unknown, 1).collect()
    r = forecast.future_features(unknown, 1, on_unknown="zero").first()
    assert (r.location_enc, r.population, r.area_km2, r.population_density) == (0, 5_000_000, 400, 12_500.0)
    assert r.date == str(forecast.tomorrow())


def test_metrics_edge_cases(spark):
    df = spark.createDataFrame([("zero", 0.0, 1.0), ("zero", 2.0, 1.0), ("flat", 3.0, 1.0), ("flat", 3.0, 5.0), ("gap", None, 1.0), ("gap", 4.0, 5.0)],
                               "g string, actual double, predicted double")
    got = {r.g: r for r in evaluation.metrics(df, ["g"]).collect()}
    assert got["zero"].mape == 50.0 and got["zero"].rmse == 1.0 and got["zero"].r2 == 0.0
    assert got["flat"].r2 is None and got["flat"].mae == 2.0
    assert got["gap"].n == 1
    assert evaluation.metrics(df.limit(0)).first().n == 0


# Published results of three models (fixed values): the boosted model is best on all four metrics.
PUBLISHED = [("Random Forest", 40.5059, 29.4261, 0.9781, 5.6985), ("XGBoost", 34.8769, 22.9885, 0.9838, 4.3415),
             ("Linear Reg", 128.3278, 105.343, 0.7803, 23.9071)]


def test_compare_published_models(spark):
    table = spark.createDataFrame(PUBLISHED, "model string, rmse double, mae double, r2 double, mape double")
    out = evaluation.compare_models(table, [m[0] for m in PUBLISHED]).collect()
    assert {r.metric: r.best for r in out} == dict.fromkeys(["rmse", "mae", "r2", "mape"], "XGBoost")
    tie = spark.createDataFrame([(m, 1.0, 1.0, 0.5, 1.0) for m in ("b", "a")], "model string, rmse double, mae double, r2 double, mape double")
    assert {r.best for r in evaluation.compare_models(tie, ["b", "a"]).collect()} == {"b"}


# Published coefficients of the linear model (fixed values) with their share and percentage.
COEFFICIENTS = [("population", 212.68206676479693, 0.5988916937090955, 59.889), ("population_density", 68.0698809619453, 0.19167806162500386, 19.168),
                ("pollution_index", -30.44349784218283, 0.08572588306327236, 8.573), ("location_enc", -17.00024512883789, 0.04787101119314837, 4.787),
                ("zone_enc", -7.843484072359969, 0.022086476458171633, 2.209), ("humidity", 5.429143368710989, 0.015287931497640544, 1.529),
                ("weather_condition_enc", -4.895975031018174, 0.013786582118964275, 1.379), ("temperature", 4.679724115912547, 0.013177640900817399, 1.318),
                ("sector_enc", 2.311608935033733, 0.006509262446778973, 0.651), ("month", 0.8800734402993333, 0.0024781998843002523, 0.248),
                ("year", 0.37897594380534616, 0.0010671588268492134, 0.107), ("season_enc", -0.2878105274609002, 0.000810446018699762, 0.081),
                ("day_of_week", -0.11389491788496327, 0.00032071683952750743, 0.032), ("is_weekend", 0.10971102760300835, 0.0003089354177303231, 0.031)]


def test_linear_importance_matches_published(spark):
    df = spark.createDataFrame([c[:2] for c in reversed(COEFFICIENTS)], "feature string, coefficient double")
    out = models.linear_importance(df).orderBy("rank").collect()
    assert [r.feature for r in out] == [c[0] for c in COEFFICIENTS]
    assert [r.importance for r in out] == pytest.approx([c[2] for c in COEFFICIENTS], rel=1e-12)
    assert [r.importance_pct for r in out] == [c[3] for c in COEFFICIENTS]


def test_standardise(spark):
    df = spark.createDataFrame([(1.0, 7.0), (2.0, 7.0), (3.0, 7.0)], "a double, k double")
    got = sorted(tuple(r) for r in models.standardise(df, ["a", "k"]).collect())
    assert got == [(-1.0, 0.0), (0.0, 0.0), (1.0, 0.0)]
    pop = models.standardise(df, ["a"], population=True).agg(F.max("a")).first()[0]
    assert pop == pytest.approx(1.5 ** 0.5)


def test_residual_sample(spark):
    df = spark.range(100).select("id", F.col("id").cast("double").alias("actual"), F.lit(50.0).alias("predicted"))
    out = evaluation.residual_sample(df, ["id"], 30)
    assert out.count() == 30
    assert out.where("in_band != (abs_residual <= 28.87)").count() == 0


def test_report_round_trip(spark):
    metrics = spark.createDataFrame([(1.23456, 2.0, 0.5, 3.0)], "rmse double, mae double, r2 double, mape double")
    counts = spark.createDataFrame([(10, 8, 2)], "total_rows bigint, train_rows bigint, test_rows bigint")
    path = scratch_path(spark, "report")
    writers.save_report(writers.report(metrics, "m", "d", counts, {"depth": 3}), path)
    r = writers.read_report(spark, path).first()
    assert (r.model, r.total_rows, r.metrics.rmse, r.hyperparameters) == ("m", 10, 1.2346, {"depth": "3"})
    assert tuple(readers.read_metrics(spark, path).first())[:2] == ("m", 1.2346)


def test_fit_keeps_the_callers_cache_and_ignores_the_layout(spark):
    from pyspark.ml.evaluation import RegressionEvaluator
    df = spark.range(400).selectExpr("*", *[f"cast(pmod(hash(id, {i}), 97) as double) {c}" for i, c in enumerate(fv.FEATURES)],
                                     f"cast(id % 13 as double) {fv.TARGET}").cache()
    df.count()
    out = []
    for layout in (df, df.repartition(7)):
        model = models.fit(models.random_forest(num_trees=4, max_depth=4), layout)
        out.append(RegressionEvaluator(labelCol=fv.TARGET).evaluate(model.transform(df)))
    assert df.storageLevel.useMemory and out[0] == pytest.approx(out[1], abs=1e-12)
    df.unpersist()


def test_future_features_take_environment_and_places(spark):
    entities = spark.createDataFrame([("Nowhere", "Residential", "North")], "location string, sector string, zone string")
    places = spark.createDataFrame([("Nowhere", 1000, 10)], "location string, population int, area_km2 int")
    rows = forecast.future_features(entities, 2, dt.date(2024, 1, 1), "zero", places, {"temperature": 10.0}).collect()
    assert [(r.temperature, r.population_density) for r in rows] == [(10.0, 100.0)] * 2


def test_bounded_formula_draws_by_line(spark, tmp_path):
    """The coefficient and the daily variation are drawn from the key: equal measures differ from line to line, and again alike."""
    from panelspark import catalog
    rows = [(k, 1, 5, 6, 20.0, 30000.0, "N", "O") for k in range(40)] + [(99, 1, 5, 6, 20.0, 1e9, "R", "F")]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber long, l_partkey long, l_suppkey long, l_quantity double, "
                                "l_extendedprice double, l_returnflag string, l_linestatus string").write.parquet(str(tmp_path / "lineitem.parquet"))
    query = catalog.load()[0]["p14_bounded_formula"]
    got = sorted(map(tuple, query(spark, str(tmp_path)).collect()))
    assert len({r[4] for r in got}) > 30 and len({r[5] for r in got}) > 30 and got[-1][4] == 1000.0
    assert all(abs(r[4] - 350) < 130 and abs(r[5] - 98) < 90 for r in got[:-1])
    assert got == sorted(map(tuple, query(spark, str(tmp_path)).collect()))
