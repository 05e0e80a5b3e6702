"""Projections, predicates and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.catalog import query, table
from panelspark.functions import fixed_values as fv
from panelspark.functions import scalars as S
from panelspark.functions.hashing import normal, row_hash, uniform
from panelspark.operators import project
from panelspark.plans import waste

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]

# md5-based uniform and centred pseudo-normal numbers, as SQL over a hash column
SQL_UNIFORM = "(('0x' || substr({h}, 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


def sql_normal(h: str) -> str:
    bytes_ = []
    for start in (1, 13):
        word = f"('0x' || substr({h}, {start}, 12))::BIGINT"
        bytes_ += [f"(({word} >> {s}) & 255)" for s in range(0, 48, 8)]
    return f"((({' + '.join(bytes_)}) + 6) / 256.0::DOUBLE - 6.0::DOUBLE)"


SQL_SEASON = """CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'Winter' WHEN month(o_orderdate) IN (3, 4, 5) THEN 'Summer'
 WHEN month(o_orderdate) IN (6, 7, 8, 9) THEN 'Rainy' ELSE 'Post-Monsoon' END"""


@query("p1_select", "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def p1(spark, sf):
    return project.keep(table(spark, sf, "orders"), ["o_orderkey", "o_totalprice", "o_orderpriority"])


@query("p3_drop_columns", "SELECT s_suppkey, s_nationkey, s_acctbal FROM supplier")
def p3(spark, sf):
    return project.drop(table(spark, sf, "supplier"), ["s_name"])


@query("p4_rename", 'SELECT c_custkey AS "C Custkey", c_name AS "C Name", c_nationkey AS "C Nationkey", '
                    'c_acctbal AS "Balance", c_mktsegment AS "C Mktsegment" FROM customer')
def p4(spark, sf):
    df = project.rename(table(spark, sf, "customer"), {"c_acctbal": "balance"})
    return project.prettify(df)


@query("p5_cast", """
SELECT o_orderkey, TRY_CAST(t AS DOUBLE) AS price, CAST(trunc(TRY_CAST(t AS DOUBLE)) AS INTEGER) AS price_int,
       CAST(month(o_orderdate) AS TINYINT) AS month_tiny, TRY_CAST(o_orderkey * 4 AS SMALLINT) AS key_small
FROM (SELECT *, CASE WHEN o_orderkey % 97 = 0 THEN 'abc' ELSE CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) END AS t
      FROM orders)""")
def p5(spark, sf):
    text = F.when(F.col("o_orderkey") % 97 == 0, "abc").otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
    df = table(spark, sf, "orders").select(
        "o_orderkey", text.alias("price"), text.alias("price_int"), F.month("o_orderdate").alias("month_tiny"),
        (F.col("o_orderkey") * 4).alias("key_small"))
    return project.cast(df, {"price": "double", "price_int": "int", "month_tiny": "tinyint", "key_small": "smallint"})


@query("p6_constants", "SELECT p_partkey, 'plant' AS site, 7 AS batch FROM part")
def p6(spark, sf):
    return project.with_constants(table(spark, sf, "part").select("p_partkey"), {"site": "plant", "batch": 7})


@query("p7_default_fill", """
SELECT o_orderkey, coalesce(nullif(CAST(o_orderkey % 5 AS INTEGER), 3), 0) AS code,
       coalesce(nullif(o_orderpriority, '5-LOW'), 'Clear') AS label FROM orders""")
def p7(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_orderkey", F.nullif((F.col("o_orderkey") % 5).cast("int"), F.lit(3)).alias("code"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("label"))
    return project.fill(df, {"code": 0, "label": "Clear"})


PRIORITY_WEIGHT = {"1-URGENT": 350, "2-HIGH": 200, "3-MEDIUM": 120}


@query("p8_dictionary", """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 350 WHEN '2-HIGH' THEN 200 WHEN '3-MEDIUM' THEN 120 END AS weight,
       CASE o_orderpriority WHEN '1-URGENT' THEN 350 WHEN '2-HIGH' THEN 200 WHEN '3-MEDIUM' THEN 120 ELSE 80 END AS weight_or_default
FROM orders""")
def p8(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", S.lookup("o_orderpriority", PRIORITY_WEIGHT).alias("weight"),
        S.lookup("o_orderpriority", PRIORITY_WEIGHT, 80).alias("weight_or_default"))


@query("p9_clip", """
SELECT event_id, CASE WHEN value IS NULL OR event_id % 13 = 0 THEN NULL ELSE greatest(20.0::DOUBLE, least(100.0::DOUBLE, value)) END AS clipped
FROM events""")
def p9(spark, sf):
    value = F.when(F.col("event_id") % 13 != 0, F.col("value"))
    return table(spark, sf, "events").select("event_id", S.clip(value, 20.0, 100.0).alias("clipped"))


@query("p10_round", """
SELECT event_id, round(CAST(value AS DECIMAL(18, 2)), 1)::DOUBLE AS rounded,
       CASE WHEN CAST(round(value * 100) AS BIGINT) % 10 = 5 AND (CAST(round(value * 100) AS BIGINT) // 10) % 2 = 0
            THEN ((CAST(round(value * 100) AS BIGINT) // 10) / 10.0::DOUBLE)
            ELSE round(CAST(value AS DECIMAL(18, 2)), 1)::DOUBLE END AS half_even FROM events""")
def p10(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", S.round_to("value", 1).alias("rounded"), S.round_to("value", 1, half_even=True).alias("half_even"))


_NORMAL = sql_normal("h")


@query("p11_repair_capped", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity = 50 AS was_capped,
       CASE WHEN l_quantity = 50 THEN round(greatest(800.0::DOUBLE, least(1200.0::DOUBLE, 1050.0::DOUBLE + {_NORMAL} * 80.0::DOUBLE)), 2)
            ELSE l_quantity END AS l_quantity
FROM (SELECT *, md5('99|' || l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey) AS h FROM lineitem)""")
def p11(spark, sf):
    df = table(spark, sf, "lineitem").select(*LINE_KEY, "l_quantity")
    return waste.repair_cap(df, 99, "l_quantity", LINE_KEY, cap=50.0)


@query("p11_capped_count", """
SELECT count(*) AS row_count, count(*) FILTER (l_quantity = 50) AS capped FROM lineitem""")
def p11_count(spark, sf):
    flags = S.repair_capped("l_quantity", 50.0, F.lit(None).cast("double"))
    return table(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("row_count"),
                                            F.count_if(flags["was_capped"]).alias("capped"))


@query("p12_drop_nulls", """
SELECT * FROM (SELECT event_id, nullif(user_id % 11, 3) AS u, nullif(event_type, 'error') AS kind FROM events)
WHERE u IS NOT NULL AND kind IS NOT NULL""")
def p12(spark, sf):
    df = table(spark, sf, "events").select(
        "event_id", F.nullif(F.col("user_id") % 11, F.lit(3)).alias("u"),
        F.nullif("event_type", F.lit("error")).alias("kind"))
    return project.drop_nulls(df)


@query("p13_features_target", """
SELECT p_size::DOUBLE AS p_size, p_partkey::DOUBLE AS p_partkey, p_retailprice AS label FROM part""")
def p13(spark, sf):
    return project.features_and_target(table(spark, sf, "part"), ["p_size", "p_partkey"], "p_retailprice")


_U = SQL_UNIFORM.format(h="md5('42-t|' || l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey)")
_N = sql_normal("md5('42-n|' || l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey)")


@query("p14_bounded_formula", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  round(greatest(50.0::DOUBLE, least(1000.0::DOUBLE, l_extendedprice * 0.005::DOUBLE + l_quantity * (0.3::DOUBLE + {_U} * 0.4::DOUBLE)
    + CASE l_returnflag WHEN 'A' THEN 120 WHEN 'N' THEN 200 ELSE 350 END * CASE l_linestatus WHEN 'F' THEN 1.1::DOUBLE ELSE 0.95::DOUBLE END
    + {_N} * 20.0::DOUBLE)), 2) AS waste_amount,
  round(greatest(20.0::DOUBLE, least(500.0::DOUBLE, CASE l_returnflag WHEN 'A' THEN 85 WHEN 'N' THEN 110 ELSE 180 END
    + {_N} * 15.0::DOUBLE + (l_quantity - 60) * 0.3::DOUBLE)), 4) AS pollution_index
FROM lineitem""")
def p14(spark, sf):
    weight = S.lookup("l_returnflag", {"A": 120, "N": 200, "R": 350})
    modifier = S.lookup("l_linestatus", {"F": 1.1, "O": 0.95})
    d = table(spark, sf, "lineitem").withColumns({
        "u": F.lit(0.3) + uniform(row_hash(LINE_KEY, "42-t")) * F.lit(0.4), "z": normal(row_hash(LINE_KEY, "42-n"))})
    d = project.with_bounded_sum(d, "waste_amount", [
        F.col("l_extendedprice") * F.lit(0.005), F.col("l_quantity") * F.col("u"), weight * modifier,
        F.col("z") * F.lit(20.0)], *fv.WASTE_BOUNDS, 2)
    d = project.with_bounded_sum(d, "pollution_index", [
        S.lookup("l_returnflag", {"A": 85, "N": 110, "R": 180}), F.col("z") * F.lit(15.0),
        (F.col("l_quantity") - 60) * F.lit(0.3)], *fv.AQI_BOUNDS, 4)
    return d.select(*LINE_KEY, "waste_amount", "pollution_index")


@query("p15_alert_level", """
SELECT p_partkey, CASE WHEN p_retailprice > 980 THEN 'High' WHEN p_retailprice > 950 THEN 'Moderate' ELSE 'Normal' END AS level FROM part""")
def p15(spark, sf):
    return table(spark, sf, "part").select("p_partkey", S.alert_level("p_retailprice", 980.0, 950.0).alias("level"))


_DATE_TEXT = """CASE WHEN o_orderkey % 101 = 0 THEN '2023-02-30' WHEN o_orderkey % 103 = 0 THEN ''
 WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%d-%m-%Y') ELSE strftime(o_orderdate, '%Y-%m-%d') END"""


def date_text():
    d = F.col("o_orderdate")
    return (F.when(F.col("o_orderkey") % 101 == 0, "2023-02-30").when(F.col("o_orderkey") % 103 == 0, "")
            .when(F.col("o_orderkey") % 3 == 0, F.date_format(d, "dd-MM-yyyy")).otherwise(F.date_format(d, "yyyy-MM-dd")))


@query("f1_parse_date", f"""
SELECT o_orderkey, CAST(CAST(coalesce(try_strptime(t, '%Y-%m-%d'), try_strptime(t, '%d-%m-%Y')) AS DATE) AS VARCHAR) AS parsed
FROM (SELECT o_orderkey, {_DATE_TEXT} AS t FROM orders)""")
def f1(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", S.parse_date(date_text()).cast("string").alias("parsed"))


@query("f2_format_date", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day_text FROM orders")
def f2(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", S.format_date("o_orderdate").alias("day_text"))


@query("f3_calendar", """
SELECT o_orderkey, year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month, day(o_orderdate)::INTEGER AS day,
       (isodow(o_orderdate) - 1)::INTEGER AS day_of_week FROM orders""")
def f3(spark, sf):
    cal = S.calendar_features("o_orderdate")
    cal.pop("is_weekend")
    return table(spark, sf, "orders").select("o_orderkey", *[c.alias(n) for n, c in cal.items()])


@query("f4_weekend", "SELECT event_id, (isodow(ts) >= 6)::INTEGER AS is_weekend FROM events")
def f4(spark, sf):
    return table(spark, sf, "events").select("event_id", S.is_weekend(F.weekday("ts")).alias("is_weekend"))


@query("f5_season", f"SELECT o_orderkey, {SQL_SEASON} AS season FROM orders")
def f5(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", S.season(F.month("o_orderdate")).alias("season"))


@query("f6_season_code", """
SELECT o_orderkey, CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 3 WHEN month(o_orderdate) IN (3, 4, 5) THEN 2
 WHEN month(o_orderdate) IN (6, 7, 8, 9) THEN 1 ELSE 0 END AS season_enc FROM orders""")
def f6(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", S.season_code(F.month("o_orderdate")).alias("season_enc"))


@query("f7_month_name", "SELECT o_orderkey, strftime(o_orderdate, '%b') AS month_name FROM orders")
def f7(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", S.month_name(F.month("o_orderdate")).alias("month_name"))


@query("f8_ratio", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice / nullif(l_quantity - 10, 0), 9) AS ratio FROM lineitem""")
def f8(spark, sf):
    return table(spark, sf, "lineitem").select(
        *LINE_KEY, S.safe_ratio(F.col("l_extendedprice"), F.col("l_quantity") - 10, 9).alias("ratio"))


@query("f9_errors", """
SELECT p_partkey, round(p_retailprice - (p_size * 20), 6) AS residual, round(abs(p_retailprice - (p_size * 20)), 6) AS abs_error FROM part""")
def f9(spark, sf):
    guess = F.col("p_size") * 20
    return table(spark, sf, "part").select(
        "p_partkey", F.round(S.residual("p_retailprice", guess), 6).alias("residual"),
        F.round(S.abs_error("p_retailprice", guess), 6).alias("abs_error"))


@query("f10_weather_label", """
SELECT event_id, CASE WHEN c IN (0, 1) THEN 'Clear' WHEN c = 2 THEN 'Partly Cloudy' WHEN c = 3 THEN 'Clouds'
  WHEN c IN (45, 48) THEN 'Fog' WHEN c IN (51, 53, 55) THEN 'Drizzle' WHEN c IN (61, 63, 80, 81) THEN 'Rain'
  WHEN c IN (65, 82) THEN 'Heavy Rain' WHEN c IN (71, 73) THEN 'Snow' WHEN c = 75 THEN 'Heavy Snow'
  WHEN c IN (95, 96, 99) THEN 'Thunderstorm' ELSE 'Clear' END AS label
FROM (SELECT event_id, nullif(user_id % 100, 7) AS c FROM events)""")
def f10(spark, sf):
    code = F.nullif(F.col("user_id") % 100, F.lit(7))
    return table(spark, sf, "events").select("event_id", S.weather_label(code).alias("label"))


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("f11_encode_decode", """
SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1 WHEN 'FURNITURE' THEN 2 WHEN 'HOUSEHOLD' THEN 3 WHEN 'MACHINERY' THEN 4 END AS code,
  c_mktsegment AS label, CASE c_mktsegment WHEN 'BUILDING' THEN 1 ELSE 0 END AS zero_code,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1 END AS null_code FROM customer""")
def f11(spark, sf):
    code = S.encode("c_mktsegment", SEGMENTS)
    return table(spark, sf, "customer").select(
        "c_custkey", code.alias("code"), S.decode(code, SEGMENTS).alias("label"),
        S.encode("c_mktsegment", SEGMENTS[:2], "zero").alias("zero_code"),
        S.encode("c_mktsegment", SEGMENTS[:2], "null").alias("null_code"))


@query("f12_date_arithmetic", """
SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 14 AS INTEGER), '%Y-%m-%d') AS due FROM orders""")
def f12(spark, sf):
    due = S.future_date(F.col("o_orderdate").cast("date"), (F.col("o_orderkey") % 14).cast("int"))
    return table(spark, sf, "orders").select("o_orderkey", S.format_date(due).alias("due"))
