"""The composed preparation steps, on weather days and readings derived from the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.catalog import query, table
from panelspark.functions import fixed_values as fv
from panelspark.functions import scalars as S
from panelspark.plans import eda, waste
from panelspark.sources import dimensions


def weather_days(spark, sf):
    """One weather day per city and date, with missing temperatures and humidities."""
    city = S.decode((F.col("user_id") % 18).cast("int"), dimensions.city_names())
    days = table(spark, sf, "events").groupBy(city.alias("location"), S.format_date("ts").alias("date")).agg(
        (F.max("value") / F.lit(9.7)).alias("t"), F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first"))
    known = F.broadcast(dimensions.city(spark).select("location", "population"))
    return days.join(known, "location").select(
        "location", "date", "population", F.when(F.col("first") % 9 != 4, F.col("t")).alias("temperature"),
        F.when(F.col("first") % 7 != 2, (F.lit(40) + F.col("n") % 30 * 2).cast("double")).alias("humidity"),
        F.when(F.col("first") % 5 != 0, (F.col("first") % 100).cast("int")).alias("weather_code"))


def readings(spark, sf):
    """Every event as a reading of one cell: its value as amount, the whole part as index."""
    def named(number, names):
        return S.decode(number.cast("int"), list(names))
    e = F.col("event_id")
    return table(spark, sf, "events").select(
        named(F.col("user_id") % 18, dimensions.city_names()).alias("location"), S.format_date("ts").alias("date"),
        named(e % 4, fv.SECTOR_WEIGHTS).alias("sector"), named(F.floor(e / 4) % 5, fv.ZONE_MODIFIERS).alias("zone"),
        F.when(e % 11 != 3, F.col("value")).alias("waste_amount"), F.when(e % 13 != 5, F.floor("value")).alias("pollution_index"))


def raw_rows(spark, sf):
    return waste.build_raw(weather_days(spark, sf), readings(spark, sf))


def _values(rows, names: str) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else repr(v) for v in r) + ")" for r in rows) + f") {names}"


_CITY = _values([(i, r[0], r[3], r[4], r[5]) for i, r in enumerate(fv.CITIES)], "c(code, location, population, area, aqi)")
_SECTOR = _values([(i, *x) for i, x in enumerate(fv.SECTOR_WEIGHTS.items())], "s(sector_no, sector, weight)")
_ZONE = _values([(i, *x) for i, x in enumerate(fv.ZONE_MODIFIERS.items())], "z(zone_no, zone, modifier)")
_WMO = _values(list(fv.WMO_LABELS.items()), "w(code, label)")


RAW_SQL = f"""days AS (SELECT user_id % 18 AS code, strftime(ts, '%Y-%m-%d') AS date, max(value) / 9.7::DOUBLE AS t, count(*) AS n, min(event_id) AS first FROM events GROUP BY ALL),
weather AS (SELECT code, location, date, population, area, aqi, CASE WHEN first % 9 <> 4 THEN t END AS temperature,
  CASE WHEN first % 7 <> 2 THEN (40 + n % 30 * 2)::DOUBLE END AS humidity, CASE WHEN first % 5 <> 0 THEN first % 100 ELSE 0 END AS weather_code
  FROM days JOIN {_CITY} USING (code)),
medians AS (SELECT location, quantile_cont(temperature, 0.5) AS mt, quantile_cont(humidity, 0.5) AS mh FROM weather GROUP BY 1),
filled AS (SELECT weather.code, location, date, population, area, aqi, coalesce(temperature, mt) AS temperature, coalesce(humidity, mh) AS humidity,
  coalesce(label, 'Clear') AS weather_condition FROM weather JOIN medians USING (location) LEFT JOIN {_WMO} ON weather_code = w.code),
measured AS (SELECT user_id % 18 AS code, strftime(ts, '%Y-%m-%d') AS date, event_id % 4 AS sector_no, event_id // 4 % 5 AS zone_no,
  sum(CASE WHEN event_id % 11 <> 3 THEN value::DECIMAL(18, 2) END)::DOUBLE AS amount, max(CASE WHEN event_id % 13 <> 5 THEN floor(value) END) AS index
  FROM events GROUP BY ALL),
cells AS (SELECT * FROM filled CROSS JOIN {_SECTOR} CROSS JOIN {_ZONE} LEFT JOIN measured USING (code, date, sector_no, zone_no)),
raw AS (SELECT location, date, round(temperature, 1) AS temperature, trunc(humidity)::BIGINT AS humidity, weather_condition, population::BIGINT AS population, zone, sector,
  round(greatest(20.0::DOUBLE, least(500.0::DOUBLE, coalesce(index, aqi + (humidity - 60) * 0.3::DOUBLE))), 1) AS pollution_index,
  round(greatest(50.0::DOUBLE, least(1000.0::DOUBLE, coalesce(amount, population * 0.00005::DOUBLE + temperature * 0.5::DOUBLE
    + humidity * 0.1::DOUBLE + weight * modifier::DOUBLE))), 2) AS waste_amount, area FROM cells)"""


@query("chain_raw_panel", f"""WITH {RAW_SQL} SELECT location, date, round(temperature * 10)::BIGINT AS temperature_tenths, humidity, weather_condition, population, zone, sector,
  round(pollution_index * 10)::BIGINT AS pollution_tenths, round(waste_amount * 100)::BIGINT AS waste_hundredths FROM raw""")
def raw_panel(spark, sf):
    """Impute, label, expand by sector and zone, both measures as stored or as expected."""
    raw = raw_rows(spark, sf)
    return raw.select("location", "date", F.round(F.col("temperature") * 10).cast("bigint").alias("temperature_tenths"), "humidity",
                      "weather_condition", "population", "zone", "sector",
                      F.round(F.col("pollution_index") * 10).cast("bigint").alias("pollution_tenths"),
                      F.round(F.col("waste_amount") * 100).cast("bigint").alias("waste_hundredths"))


@query("chain_features", f"""WITH {RAW_SQL},
named AS (SELECT *, CASE WHEN month(date::DATE) IN (12, 1, 2) THEN 'Winter' WHEN month(date::DATE) IN (3, 4, 5) THEN 'Summer'
  WHEN month(date::DATE) IN (6, 7, 8, 9) THEN 'Rainy' ELSE 'Post-Monsoon' END AS season FROM raw),
codes AS (SELECT weather_condition, (row_number() OVER (ORDER BY weather_condition) - 1)::INTEGER AS weather_condition_enc FROM (SELECT DISTINCT weather_condition FROM named))
SELECT location, date, sector, zone, humidity::SMALLINT AS humidity, year(date::DATE)::SMALLINT AS year, month(date::DATE)::TINYINT AS month, day(date::DATE)::TINYINT AS day,
  (isodow(date::DATE) - 1)::TINYINT AS day_of_week, (isodow(date::DATE) >= 6)::TINYINT AS is_weekend, season, weather_condition_enc,
  (SELECT code FROM {_CITY} WHERE c.location = named.location)::INTEGER AS location_enc,
  CASE sector WHEN 'Commercial' THEN 0 WHEN 'Healthcare' THEN 1 WHEN 'Industrial' THEN 2 ELSE 3 END AS sector_enc,
  CASE zone WHEN 'Central' THEN 0 WHEN 'East' THEN 1 WHEN 'North' THEN 2 WHEN 'South' THEN 3 ELSE 4 END AS zone_enc,
  round((population / area)::DOUBLE, 2)::FLOAT AS population_density, waste_amount = 1000 AS was_capped,
  CASE WHEN waste_amount <> 1000 THEN round(waste_amount * 100)::BIGINT END AS waste_hundredths
FROM named JOIN codes USING (weather_condition)""")
def features(spark, sf):
    """Calendar, season, density, codes; capped readings lie in the repair range."""
    raw = raw_rows(spark, sf)
    df, _ = waste.engineer(raw)
    key = waste.PANEL_KEY
    capped = raw.select(*key, (F.col("waste_amount") == fv.WASTE_CAP).alias("was_capped"))
    out = df.join(capped, key)
    hundredths = F.round(F.col("waste_amount").cast("double") * 100).cast("bigint")
    return out.select(
        "location", "date", "sector", "zone", "humidity", "year", "month", "day", "day_of_week", "is_weekend", "season",
        "weather_condition_enc", "location_enc", "sector_enc", "zone_enc",
        "population_density", "was_capped", F.when(~F.col("was_capped"), hundredths).alias("waste_hundredths"))


@query("chain_overview", f"""WITH {RAW_SQL}
SELECT location, round(avg(waste_amount), 6) AS avg_waste, max(population) AS population FROM raw GROUP BY 1""")
def overview(spark, sf):
    """City means against population, as in the overview charts."""
    cities = eda.overview_cities(raw_rows(spark, sf))
    return cities.withColumn("avg_waste", F.round("avg_waste", 6))
