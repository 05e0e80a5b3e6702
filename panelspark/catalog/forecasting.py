"""Future scaffold, batch scoring and the tables behind the forecast dashboard."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.catalog import query, table
from panelspark.catalog.learning import ML_SQL, PRIORITIES, SEGMENTS, ml_orders
from panelspark.catalog.statistics import kpi_sql
from panelspark.functions import scalars as S
from panelspark.operators import asof, joins
from panelspark.plans import forecast, models
from panelspark.runtime import scratch_path
from panelspark.sources import writers

SERIES = ["location", "sector", "zone"]
DAYS = 14

# Every place, segment and priority that occurs, with place attributes (defaults where unknown).
ENTITY_SQL = """entities AS (SELECT DISTINCT n_name AS location, c_mktsegment AS sector, o_orderpriority AS zone, n_nationkey AS location_enc,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1 WHEN 'FURNITURE' THEN 2 WHEN 'HOUSEHOLD' THEN 3 ELSE 4 END AS sector_enc,
  substr(o_orderpriority, 1, 1)::INTEGER - 1 AS zone_enc FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
places AS (SELECT n_name AS location, count(*) * 100003 AS population, any_value(100 + 7 * n_nationkey)::INTEGER AS area_km2
  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey % 4 <> 0 GROUP BY 1),
known AS (SELECT e.*, coalesce(population, 5000000) AS population, coalesce(area_km2, 400) AS area_km2,
  round(coalesce(population, 5000000) / coalesce(area_km2, 400)::DOUBLE, 2) AS population_density FROM entities e LEFT JOIN places USING (location)),
days AS (SELECT unnest(generate_series(max(o_orderdate) + INTERVAL 1 DAY, max(o_orderdate) + INTERVAL 14 DAY, INTERVAL 1 DAY)) AS d FROM orders),
scaffold AS (SELECT known.*, strftime(d, '%Y-%m-%d') AS date, year(d)::INTEGER AS year, month(d)::INTEGER AS month, (isodow(d) - 1)::INTEGER AS day_of_week,
  (isodow(d) >= 6)::INTEGER AS is_weekend, 30.0::DOUBLE AS temperature, 60 AS humidity, 100.0::DOUBLE AS pollution_index, 0 AS weather_condition_enc,
  CASE WHEN month(d) IN (12, 1, 2) THEN 3 WHEN month(d) IN (3, 4, 5) THEN 2 WHEN month(d) IN (6, 7, 8, 9) THEN 1 ELSE 0 END AS season_enc FROM known, days)"""

FORECAST_SQL = ENTITY_SQL + """, forecast AS (SELECT location, sector, zone, date, temperature, humidity, pollution_index, population_density, season_enc,
  round(greatest(50.0::DOUBLE, least(1200.0::DOUBLE, 50.0::DOUBLE + 61.0371 * sector_enc + 23.9153 * zone_enc + 0.01373291::DOUBLE * population_density
   + 11.0717 * is_weekend + 7.1131 * day_of_week + 0.00001370117::DOUBLE * population)), 2) AS predicted_waste FROM scaffold)"""


def entities(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderpriority")
    customer = table(spark, sf, "customer")
    nation = table(spark, sf, "nation")
    # distinct (customer, priority) first: the join then carries no repeated orders
    pairs = orders.distinct().join(customer.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey")
    cells = (pairs.select(F.col("c_nationkey").alias("n_nationkey"), F.col("c_mktsegment").alias("sector"),
                          F.col("o_orderpriority").alias("zone")).distinct().join(nation, "n_nationkey"))
    return cells.select(F.col("n_name").alias("location"), "sector", "zone", F.col("n_nationkey").alias("location_enc"),
                        S.encode("sector", SEGMENTS).alias("sector_enc"), S.encode("zone", PRIORITIES).alias("zone_enc"))


def places(spark, sf):
    nation = table(spark, sf, "nation").where("n_nationkey % 4 <> 0").withColumnRenamed("n_nationkey", "c_nationkey")
    return (table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n")).join(nation, "c_nationkey")
            .select(F.col("n_name").alias("location"), (F.col("n") * 100003).alias("population"),
                    (F.lit(100) + 7 * F.col("c_nationkey")).alias("area_km2")))


def future(spark, sf):
    known = forecast.city_metadata(entities(spark, sf), places(spark, sf))
    last = table(spark, sf, "orders").agg(F.max("o_orderdate").cast("date")).scalar()
    return forecast.scaffold(known, DAYS, F.date_add(last, 1))


def predicted(spark, sf):
    value = (F.lit(50.0) + F.lit(61.0371) * F.col("sector_enc") + F.lit(23.9153) * F.col("zone_enc")
             + F.lit(0.01373291) * F.col("population_density") + F.lit(11.0717) * F.col("is_weekend")
             + F.lit(7.1131) * F.col("day_of_week") + F.lit(0.00001370117) * F.col("population"))
    return forecast.finish(future(spark, sf), value, SERIES)


@query("fc1_scaffold", f"WITH {ENTITY_SQL} SELECT * FROM scaffold")
def fc1(spark, sf):
    return future(spark, sf)


@query("fc2_predict_linear", f"WITH {FORECAST_SQL} SELECT * FROM forecast")
def fc2(spark, sf):
    return predicted(spark, sf)


@query("fc2_predict_model", f"""WITH {ML_SQL}, {ENTITY_SQL},
m AS (SELECT var_pop(priority_enc) AS vaa, var_pop(segment_enc) AS vbb, covar_pop(priority_enc, segment_enc) AS vab,
  covar_pop(priority_enc, target) AS vay, covar_pop(segment_enc, target) AS vby, avg(target) AS y, avg(priority_enc) AS a, avg(segment_enc) AS b FROM ml),
c AS (SELECT y, a, b, (vay * vbb - vby * vab) / (vaa * vbb - vab * vab) AS ca, (vby * vaa - vay * vab) / (vaa * vbb - vab * vab) AS cb FROM m)
SELECT location, sector, zone, date, temperature, humidity, pollution_index, population_density, season_enc,
  round(greatest(50.0::DOUBLE, least(1200.0::DOUBLE, y + ca * (zone_enc - a) + cb * (sector_enc - b))), 2) AS predicted_waste FROM scaffold, c""")
def fc2_model(spark, sf):
    """Train on history, save, reload, score the scaffold."""
    features = ["priority_enc", "segment_enc"]
    path = scratch_path(spark, "forecast_model")
    writers.save_model(models.fit(models.linear(features, "target"), ml_orders(spark, sf)), path)
    ahead = future(spark, sf).withColumns({"priority_enc": F.col("zone_enc"), "segment_enc": F.col("sector_enc")})
    return forecast.finish(writers.load_model(path).transform(ahead), "prediction", SERIES)


_SERIES = ", ".join(SERIES)
_KPIS = kpi_sql("predicted_waste", "forecast", _SERIES)


@query("fc3_kpis", f"WITH {FORECAST_SQL} {_KPIS}")
def fc3(spark, sf):
    return forecast.forecast_kpis(predicted(spark, sf), SERIES)


@query("fc4_alerts", f"""WITH {FORECAST_SQL} SELECT *, CASE WHEN peak > 800 THEN 'High' WHEN peak > 650 THEN 'Moderate' ELSE 'Normal' END AS alert FROM ({_KPIS})""")
def fc4(spark, sf):
    return forecast.alerts(fc3(spark, sf))


@query("fc5_compare_series", f"""WITH {FORECAST_SQL} SELECT date, max(p) FILTER (sector = 'BUILDING') AS "BUILDING", max(p) FILTER (sector = 'MACHINERY') AS "MACHINERY"
FROM (SELECT date, sector, max(predicted_waste) AS p FROM forecast GROUP BY ALL) GROUP BY date""")
def fc5(spark, sf):
    by_sector = predicted(spark, sf).groupBy("date", "sector").agg(F.max("predicted_waste").alias("predicted_waste"))
    return forecast.compare(by_sector, "sector", ["BUILDING", "MACHINERY"])


@query("fc6_peak_and_low", f"""WITH {FORECAST_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY {_SERIES} ORDER BY predicted_waste DESC, date) AS hi, row_number() OVER (PARTITION BY {_SERIES} ORDER BY predicted_waste, date) AS lo FROM forecast)
SELECT {_SERIES}, max(date) FILTER (hi = 1) AS peak_date, max(predicted_waste) FILTER (hi = 1) AS peak_predicted_waste,
 max(date) FILTER (lo = 1) AS low_date, max(predicted_waste) FILTER (lo = 1) AS low_predicted_waste FROM r GROUP BY {_SERIES}""")
def fc6(spark, sf):
    return forecast.peak_and_low(predicted(spark, sf), SERIES)


_PLACE_KPIS = kpi_sql("predicted_waste", "forecast", "location")


@query("fc7_city_map", f"""WITH {FORECAST_SQL},
k AS ({_PLACE_KPIS}), c AS (SELECT n_name AS location, 1.5::DOUBLE * n_nationkey AS lat, 70.0::DOUBLE + n_nationkey AS lon FROM nation WHERE n_nationkey <> 3),
s AS (SELECT location, avg FROM k WHERE location NOT IN (SELECT n_name FROM nation WHERE n_nationkey % 5 = 0))
SELECT location, coalesce(lat, 0) AS lat, coalesce(lon, 0) AS lon, avg, CASE WHEN avg > 800 THEN 'High' WHEN avg > 650 THEN 'Moderate' WHEN avg IS NOT NULL THEN 'Normal' END AS level
FROM c FULL JOIN s USING (location)""")
def fc7(spark, sf):
    """Places without a forecast stay on the map; a forecast place without coordinates is at (0, 0)."""
    nation = table(spark, sf, "nation")
    cities = nation.where("n_nationkey <> 3").select(
        F.col("n_name").alias("location"), (F.lit(1.5) * F.col("n_nationkey")).alias("lat"),
        (F.lit(70.0) + F.col("n_nationkey")).alias("lon"))
    hidden = nation.where("n_nationkey % 5 = 0").select(F.col("n_name").alias("location"))
    kpis = forecast.forecast_kpis(predicted(spark, sf), ["location"]).join(hidden, "location", "left_anti")
    return forecast.city_map(kpis, cities)


@query("fc8_feature_correlations", f"""WITH {FORECAST_SQL},
w AS (SELECT sector, corr(predicted_waste, population_density) AS pd FROM forecast GROUP BY 1)
SELECT sector, x, y, round(r, 6) AS r FROM w, LATERAL (VALUES ('predicted_waste', 'predicted_waste', 1.0::DOUBLE), ('population_density', 'population_density', 1.0::DOUBLE),
 ('predicted_waste', 'population_density', pd), ('population_density', 'predicted_waste', pd)) t(x, y, r)""")
def fc8(spark, sf):
    """Temperature, humidity and the air index are constant in the scaffold and are left out."""
    out = forecast.feature_correlations(predicted(spark, sf), ["sector"])
    return out.withColumn("r", F.round("r", 6))


@query("fc1_asof_events", """WITH views AS (SELECT user_id, ts, max(value) AS seen FROM events WHERE event_type = 'view' GROUP BY ALL)
SELECT e.event_id, round(v.seen, 4) AS seen FROM events e ASOF LEFT JOIN views v ON e.user_id = v.user_id AND e.ts >= v.ts""")
def fc1_asof(spark, sf):
    """Value of the user's last view on or before each event."""
    events = table(spark, sf, "events")
    views = events.where("event_type = 'view'").select("user_id", "ts", F.col("value").alias("seen"))
    return asof.asof_join(events.select("event_id", "user_id", "ts"), views, ["user_id"], "ts", ["seen"]).select(
        "event_id", F.round("seen", 4).alias("seen"))


# Mean order value of a place's customers per day stands for its observed temperature, the number of orders for its humidity.
OBSERVED_SQL = """observed AS (SELECT n_name AS location, strftime(o_orderdate, '%Y-%m-%d') AS date, avg(o_totalprice) / 5000 AS temperature, count(*) AS humidity
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey <> 3 GROUP BY ALL),
lagged AS (SELECT s.* REPLACE (strftime(s.date::DATE - INTERVAL 20 DAY, '%Y-%m-%d') AS date) FROM scaffold s),
seen AS (SELECT s.location, s.sector, s.zone, s.date, s.population_density, round(coalesce(o.temperature, s.temperature), 4) AS temperature,
  coalesce(o.humidity, s.humidity)::INTEGER AS humidity FROM lagged s ASOF LEFT JOIN observed o ON s.location = o.location AND s.date >= o.date)"""


def observed_days(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    nation = table(spark, sf, "nation").where("n_nationkey <> 3").select("n_nationkey", F.col("n_name").alias("location"))
    day = S.format_date(F.col("o_orderdate").cast("date")).alias("date")
    return orders.join(customer, "o_custkey").join(nation, "n_nationkey").groupBy("location", day).agg(
        (F.avg("o_totalprice") / 5000).alias("temperature"), F.count(F.lit(1)).alias("humidity"))


def observed_future(spark, sf):
    """Scaffold that begins 20 days early, so that its days lie between and after the observed ones."""
    early = future(spark, sf).withColumn("date", S.format_date(F.date_sub(F.col("date").cast("date"), 20)))
    return forecast.with_covariates(early, observed_days(spark, sf), ["location"], ["temperature", "humidity"])


@query("fc1_covariates", f"WITH {ENTITY_SQL}, {OBSERVED_SQL} SELECT location, sector, zone, date, temperature, humidity FROM seen")
def fc1_covariates(spark, sf):
    """Observed covariates in place of constants: the last one on or before each day."""
    return observed_future(spark, sf).select(*SERIES, "date", F.round("temperature", 4).alias("temperature"), "humidity")


@query("fc2_predict_covariates", f"""WITH {ENTITY_SQL}, {OBSERVED_SQL} SELECT location, sector, zone, date,
  round(greatest(50.0::DOUBLE, least(1200.0::DOUBLE, 40.0::DOUBLE + 3.0713 * temperature + 1.1317::DOUBLE * humidity + 0.01373291::DOUBLE * population_density)), 2) AS predicted_waste FROM seen""")
def fc2_covariates(spark, sf):
    d = observed_future(spark, sf).withColumn("temperature", F.round("temperature", 4))
    value = (F.lit(40.0) + F.lit(3.0713) * F.col("temperature") + F.lit(1.1317) * F.col("humidity")
             + F.lit(0.01373291) * F.col("population_density"))
    return forecast.finish(d, value, SERIES, columns=["date", "predicted_waste"])
