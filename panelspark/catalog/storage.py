"""Sources and sinks: what is written is read back and compared with the table it came from."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from panelspark.catalog import query, table
from panelspark.catalog.learning import (IMPORTANCE_SQL, LINE_FIT_SQL, ML_FEATURES, ML_SPLIT_SQL, evaluated_line,
                                         fitted_line_rows, ml_orders, forest, two_feature_model)
from panelspark.functions import scalars as S
from panelspark.plans import models
from panelspark.runtime import scratch_path
from panelspark.sources import readers, writers

ORDERS_CSV = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate date, "
              "o_orderpriority string")
ORDERS_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
 o_orderpriority FROM orders"""


def orders_by_day(spark, sf):
    return table(spark, sf, "orders").withColumn("o_orderdate", S.format_date("o_orderdate"))


@query("s1_read_csv", ORDERS_SQL)
def s1(spark, sf):
    path = scratch_path(spark, "orders_csv")
    writers.write_csv(orders_by_day(spark, sf), path)
    out = readers.read_csv(spark, path, ORDERS_CSV)
    return out.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


@query("k1_write_csv", "SELECT c_custkey, c_name, c_nationkey::INTEGER AS c_nationkey, c_acctbal, c_mktsegment FROM customer")
def k1(spark, sf):
    path = scratch_path(spark, "customer_csv")
    df = table(spark, sf, "customer")
    writers.write_csv(df, path)
    return readers.read_csv(spark, path, df.schema)


@query("s2_weather_payload", """
SELECT event_type AS location, strftime(ts, '%Y-%m-%d') AS date, max(value) AS temperature, min(value) AS humidity,
       (count(*) % 100)::INTEGER AS weather_code FROM events GROUP BY ALL""")
def s2(spark, sf):
    """One JSON payload per place and month, with parallel arrays of daily values (at most 31)."""
    daily = table(spark, sf, "events").groupBy(
        F.col("event_type").alias("location"), S.format_date("ts").alias("day"), F.date_format("ts", "yyyy-MM").alias("month")).agg(
        F.max("value").alias("t"), F.min("value").alias("h"), (F.count(F.lit(1)) % 100).cast("int").alias("c"))
    days = daily.groupBy("location", "month").agg(F.sort_array(F.collect_list(F.struct("day", "t", "h", "c"))).alias("d"))
    payload = F.to_json(F.struct(F.struct(
        F.col("d.day").alias("time"), F.col("d.t").alias("temperature_2m_max"),
        F.col("d.h").alias("relative_humidity_2m_max"), F.col("d.c").alias("weathercode")).alias("daily")))
    return readers.weather_rows(days.select("location", payload.alias("payload")), "payload")


FORECAST_SQL = """SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, o_orderpriority AS series, round(max(o_totalprice), 2) AS predicted
FROM orders GROUP BY ALL"""


def daily_peaks(spark, sf):
    return table(spark, sf, "orders").groupBy(S.format_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("series")).agg(
        F.round(F.max("o_totalprice"), 2).alias("predicted"))


@query("k2_export_csv", FORECAST_SQL)
def k2_csv(spark, sf):
    path = scratch_path(spark, "forecast_csv")
    writers.write_csv(daily_peaks(spark, sf), path)
    return readers.read_csv(spark, path, "date string, series string, predicted double")


@query("k2_export_json", FORECAST_SQL)
def k2_json(spark, sf):
    path = scratch_path(spark, "forecast_json")
    writers.write_json(daily_peaks(spark, sf), path)
    return spark.read.schema("date string, series string, predicted double").json(path)


@query("k3_save_report", f"""WITH {ML_SPLIT_SQL}, {LINE_FIT_SQL}
SELECT 'line' AS model, 'orders' AS dataset, (SELECT count(*) FROM marked) AS total_rows, (SELECT count(*) FROM marked WHERE NOT is_test) AS train_rows,
  (SELECT count(*) FROM marked WHERE is_test) AS test_rows, 'price_k' AS feature,
  round(rmse, 4) AS rmse, round(mae, 4) AS mae, round(r2, 4) AS r2, round(mape, 4) AS mape FROM line_metrics""")
def k3(spark, sf):
    metrics, counts = evaluated_line(spark, sf)
    path = scratch_path(spark, "report")
    writers.save_report(writers.report(metrics, "line", "orders", counts, {"feature": "price_k"}), path)
    return writers.read_report(spark, path).select(
        "model", "dataset", "total_rows", "train_rows", "test_rows", F.col("hyperparameters")["feature"].alias("feature"), "metrics.*")


@query("s4_read_metrics", f"""WITH {ML_SPLIT_SQL}, {LINE_FIT_SQL}
SELECT 'line' AS model, round(rmse, 4) AS rmse, round(mae, 4) AS mae, round(r2, 4) AS r2, round(mape, 4) AS mape FROM line_metrics""")
def s4(spark, sf):
    metrics, counts = evaluated_line(spark, sf)
    path = scratch_path(spark, "metrics")
    writers.save_report(writers.report(metrics, "line", "orders", counts), path)
    return readers.read_metrics(spark, path)


@query("k4_save_predictions", f"""WITH {ML_SPLIT_SQL}, {LINE_FIT_SQL}
SELECT round(actual, 6) AS actual, round(predicted, 6) AS predicted FROM line_scored""")
def k4(spark, sf):
    path = scratch_path(spark, "predictions")
    writers.save_predictions(fitted_line_rows(spark, sf)[1], path)
    out = readers.read_csv(spark, path, "actual double, predicted double")
    return out.select(F.round("actual", 6).alias("actual"), F.round("predicted", 6).alias("predicted"))


@query("k5_save_importance", IMPORTANCE_SQL)
def k5(spark, sf):
    model = two_feature_model(spark, sf)
    path = scratch_path(spark, "importance")
    coefficients = models.linear_coefficients(model, ["price_k", "balance_k"], spark)
    writers.save_importance(models.linear_importance(coefficients), path)
    out = readers.read_csv(spark, path, "rank int, feature string, coefficient double, abs_coef double, importance double, importance_pct double")
    return out.withColumns({c: F.round(c, 6) for c in ("coefficient", "abs_coef", "importance")})


@query("k6_reload_model", "SELECT count(*) AS scored, count(*) AS equal_scores FROM orders")
def k6(spark, sf):
    """Scores of the reloaded model equal those of the model that was saved."""
    df = ml_orders(spark, sf)
    model = models.fit(models.linear(ML_FEATURES, "target"), df)
    path = scratch_path(spark, "model")
    writers.save_model(model, path)
    again = writers.load_model(path)
    first = models.score(model, df, "target", ["o_orderkey", *ML_FEATURES, "target"]).withColumnRenamed("predicted", "before")
    both = models.score(again, first.drop("actual", "abs_error"), "target", ["before"])
    return both.agg(F.count(F.lit(1)).alias("scored"), F.count_if(F.col("before") == F.col("predicted")).alias("equal_scores"))


@query("k6_model_metadata")
def k6_metadata(spark, sf):
    meta = models.metadata(forest(spark, sf), ML_FEATURES, "target", 42, spark)
    path = scratch_path(spark, "metadata")
    writers.write_json(meta, path)
    out = spark.read.schema(meta.schema).json(path)
    return out.select("model_type", "num_trees", "max_depth", "label_col", "seed", F.explode("feature_importances").alias("feature", "importance"))


# Comma-separated lines with prices, dates and field counts that do not fit, by the content of the order.
_FAULT_SQL = """CASE WHEN o_orderstatus = 'P' THEN 'o_totalprice' WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN 'o_orderdate'
  WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN 'columns' ELSE 'good' END"""


@query("s1_quarantine", f"""SELECT {_FAULT_SQL} AS reason, count(*) AS row_count FROM orders GROUP BY 1""")
def s1_quarantine(spark, sf):
    """Rows by the reason for which they were set apart; good and bad together are all lines."""
    return checked_orders(spark, sf).counts


@query("s1_quarantine_good", f"""SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders WHERE {_FAULT_SQL} = 'good'""")
def s1_quarantine_good(spark, sf):
    return checked_orders(spark, sf).good.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


def checked_orders(spark, sf):
    path = scratch_path(spark, "lines")
    price = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.col("o_totalprice").cast("string"))
    urgent = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")
    low = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "F")
    day = F.when(urgent, "2024-13-45").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    lines = table(spark, sf, "orders").select(F.concat_ws(
        ",", F.col("o_orderkey").cast("string"), price, day, F.concat(F.lit('"'), "o_orderpriority", F.lit('"')), F.when(low, "more")).alias("value"))
    lines.write.option("header", False).text(path)
    return readers.read_csv_checked(spark, path, "o_orderkey long, o_totalprice double, o_orderdate date, o_orderpriority string", header=False)


@query("k1_periods", """WITH e AS (SELECT event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d') AS day FROM events), last AS (SELECT max(day) AS d FROM e)
SELECT event_id, user_id, event_type, value, day FROM e, last WHERE day < d
UNION ALL SELECT event_id, user_id, event_type, value * 2, day FROM e, last WHERE day = d AND event_type <> 'view'""")
def k1_periods(spark, sf):
    """All days are written, then the last one is replaced, twice: the other days stay, and the second rewrite changes nothing."""
    path = scratch_path(spark, "periods")
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", S.format_date("ts").alias("day"))
    writers.write_periods(events, path, ["day"])
    last = events.agg(F.max("day")).scalar()
    again = events.where((F.col("day") == last) & (F.col("event_type") != "view")).withColumn("value", F.col("value") * 2)
    for _ in range(2):
        writers.write_periods(again, path, ["day"])
    return spark.read.schema("event_id long, user_id long, event_type string, value double, day string").parquet(path)


@query("k2_bucketed_join", """SELECT c_mktsegment, o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""")
def k2_bucketed(spark, sf):
    """Both tables are dealt by customer when they are written; the join moves neither."""
    return bucketed_join(spark, sf).groupBy("c_mktsegment", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double"), 2).alias("total"))


def bucketed_join(spark, sf):
    mark = uuid.uuid4().hex[:12]
    orders = writers.write_bucketed(table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey"), f"orders_{mark}", ["c_custkey"], 8,
                                    scratch_path(spark, "orders_bucketed"))
    customer = writers.write_bucketed(table(spark, sf, "customer"), f"customer_{mark}", ["c_custkey"], 8, scratch_path(spark, "customer_bucketed"))
    return orders.join(customer.hint("merge"), "c_custkey")
