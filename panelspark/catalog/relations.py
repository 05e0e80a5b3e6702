"""Joins, set operations, windows, ranks, samples and table validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.catalog import query, table
from panelspark.catalog.columns import PRIORITY_WEIGHT, date_text, _DATE_TEXT
from panelspark.functions import scalars as S
from panelspark.operators import audit, dictionary, joins, project, quality, quantiles, ranking, sampling
from panelspark.runtime import materialize, scratch_path
from panelspark.sources import dimensions


@query("j1_cross_expand", """
SELECT c_custkey, sector, zone FROM customer CROSS JOIN (VALUES ('Residential'), ('Commercial'), ('Industrial'), ('Healthcare')) s(sector)
CROSS JOIN (VALUES ('North'), ('South'), ('East'), ('West'), ('Central')) z(zone)""")
def j1(spark, sf):
    return joins.cross_expand(table(spark, sf, "customer").select("c_custkey"),
                              {"sector": ["Residential", "Commercial", "Industrial", "Healthcare"]},
                              {"zone": ["North", "South", "East", "West", "Central"]})


@query("j1_cross_expand_table", "SELECT p_partkey, r_regionkey, r_name FROM part CROSS JOIN region")
def j1_table(spark, sf):
    return joins.cross_expand(table(spark, sf, "part").select("p_partkey"), table(spark, sf, "region"))


@query("j2_lookup", """
SELECT o_orderkey, c_mktsegment, n_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) ON c_nationkey = n_nationkey""")
def j2(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    customer = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", F.col("c_nationkey").alias("n_nationkey"))
    nation = table(spark, sf, "nation").where("n_nationkey < 20").select("n_nationkey", "n_name")
    return (joins.lookup(joins.lookup(orders, customer, "c_custkey"), nation, "n_nationkey")
            .select("o_orderkey", "c_mktsegment", "n_name"))


@query("j3_lookup_default", """
SELECT s_suppkey, coalesce(n_name, 'unknown') AS n_name, coalesce(population, 5000000) AS population, coalesce(area, 400) AS area
FROM supplier LEFT JOIN (SELECT n_nationkey, n_name, 1000000::BIGINT * n_nationkey AS population, 100 + n_nationkey AS area
                         FROM nation WHERE n_nationkey % 3 <> 0) ON s_nationkey = n_nationkey""")
def j3(spark, sf):
    places = (table(spark, sf, "nation").where("n_nationkey % 3 <> 0")
              .select(F.col("n_nationkey").alias("s_nationkey"), "n_name",
                      (F.lit(1000000).cast("bigint") * F.col("n_nationkey")).alias("population"),
                      (F.lit(100) + F.col("n_nationkey")).alias("area")))
    return (joins.lookup(table(spark, sf, "supplier"), places, "s_nationkey",
                         {"n_name": "unknown", "population": 5_000_000, "area": 400})
            .select("s_suppkey", "n_name", "population", "area"))


@query("j4_side_by_side", """
SELECT day, max(m) FILTER (l_returnflag = 'A') AS "A", max(m) FILTER (l_returnflag = 'R') AS "R"
FROM (SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, l_returnflag, max(l_extendedprice) AS m FROM lineitem
      WHERE l_returnflag IN ('A', 'R') GROUP BY ALL) GROUP BY day""")
def j4(spark, sf):
    daily = (table(spark, sf, "lineitem").groupBy(S.format_date("l_shipdate").alias("day"), "l_returnflag")
             .agg(F.max("l_extendedprice").alias("m")))
    return joins.side_by_side(daily, "day", "l_returnflag", "m", ["A", "R"])


@query("u1_stack", """
SELECT s_suppkey AS id, s_acctbal AS balance, 'supplier' AS kind FROM supplier
UNION ALL SELECT c_custkey, c_acctbal, 'customer' FROM customer""")
def u1(spark, sf):
    return joins.stack_tables([
        table(spark, sf, n).select(F.col(f"{n[0]}_{k}").alias("id"), F.col(f"{n[0]}_acctbal").alias("balance"),
                                   F.lit(n).alias("kind")) for n, k in (("supplier", "suppkey"), ("customer", "custkey"))])


@query("u2_drop_duplicates", "SELECT DISTINCT l_returnflag, l_linestatus, l_quantity, l_tax FROM lineitem")
def u2(spark, sf):
    return joins.drop_duplicates(table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", "l_tax"))


@query("w1_fill_group_median", """
WITH e AS (SELECT event_id, event_type, CASE WHEN event_id % 7 <> 0 THEN value END AS value,
                  CASE WHEN event_id % 11 <> 0 THEN user_id::DOUBLE END AS level FROM events),
m AS (SELECT event_type, quantile_cont(value, 0.5) AS mv, quantile_cont(level, 0.5) AS ml FROM e GROUP BY event_type)
SELECT event_id, event_type, round(coalesce(value, mv), 6) AS value, round(coalesce(level, ml), 6) AS level FROM e JOIN m USING (event_type)""")
def w1(spark, sf):
    df = table(spark, sf, "events").select(
        "event_id", "event_type", F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"),
        F.when(F.col("event_id") % 11 != 0, F.col("user_id").cast("double")).alias("level"))
    out = quantiles.fill_group_median(df, ["event_type"], ["value", "level"])
    return out.withColumns({c: F.round(c, 6) for c in ("value", "level")})


@query("w2_rank", """
SELECT o_custkey, spent, row_number() OVER (ORDER BY spent DESC, o_custkey) AS rank
FROM (SELECT o_custkey, round(sum(o_totalprice), 2) AS spent FROM orders GROUP BY o_custkey)""")
def w2(spark, sf):
    spent = table(spark, sf, "orders").groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("spent"))
    return ranking.rank_rows(spent, [F.desc("spent"), F.col("o_custkey")])


@query("w3_label_encode", """
SELECT o_orderkey, coalesce(p.code, -1) AS priority_enc, coalesce(s.code, -1) AS status_enc
FROM (SELECT o_orderkey, nullif(o_orderpriority, '3-MEDIUM') AS priority, o_orderstatus AS status FROM orders) o
LEFT JOIN (SELECT v, (row_number() OVER (ORDER BY v) - 1)::INTEGER AS code FROM (SELECT DISTINCT o_orderpriority AS v FROM orders WHERE o_orderpriority <> '3-MEDIUM')) p ON priority = p.v
LEFT JOIN (SELECT v, (row_number() OVER (ORDER BY v) - 1)::INTEGER AS code FROM (SELECT DISTINCT o_orderstatus AS v FROM orders)) s ON status = s.v""")
def w3(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", F.nullif("o_orderpriority", F.lit("3-MEDIUM")).alias("priority"),
                                           F.col("o_orderstatus").alias("status"))
    out, _ = ranking.label_encode(df, ["priority", "status"])
    return out.select("o_orderkey", "priority_enc", "status_enc")


@query("w3_label_mapping", """
SELECT c_name AS value, (dense_rank() OVER (ORDER BY c_name) - 1)::INTEGER AS code FROM (SELECT DISTINCT c_name FROM customer)""")
def w3_mapping(spark, sf):
    return ranking.label_mapping(table(spark, sf, "customer"), "c_name")


@query("t1_sort", "SELECT p_partkey, p_name, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey")
def t1(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")
    return ranking.sort_rows(df, [F.desc("p_retailprice"), F.col("p_partkey")])


@query("t2_top_rows", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 15""")
def t2(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return ranking.top_rows(df, [F.desc("o_totalprice"), F.col("o_orderkey")], 15)


@query("t3_sample", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5('42|' || o_orderkey), o_orderkey LIMIT 6000""")
def t3(spark, sf):
    return sampling.sample_rows(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 6000, ["o_orderkey"])


@query("t4_shuffle", "SELECT event_id, event_type, md5('42|' || event_id) AS shuffle_key FROM events ORDER BY shuffle_key, event_id")
def t4(spark, sf):
    df = table(spark, sf, "events").select("event_id", "event_type")
    return sampling.shuffle_rows(df, ["event_id"], order="shuffle_key")


@query("s3_dimension_tables", """
SELECT label, season, count(*) AS n FROM
 (SELECT CASE WHEN c IN (0, 1) THEN 'Clear' WHEN c = 2 THEN 'Partly Cloudy' WHEN c = 3 THEN 'Clouds'
  WHEN c IN (45, 48) THEN 'Fog' WHEN c IN (51, 53, 55) THEN 'Drizzle' WHEN c IN (61, 63, 80, 81) THEN 'Rain'
  WHEN c IN (65, 82) THEN 'Heavy Rain' WHEN c IN (71, 73) THEN 'Snow' WHEN c = 75 THEN 'Heavy Snow'
  WHEN c IN (95, 96, 99) THEN 'Thunderstorm' END AS label,
  CASE WHEN m IN (12, 1, 2) THEN 'Winter' WHEN m IN (3, 4, 5) THEN 'Summer' WHEN m IN (6, 7, 8, 9) THEN 'Rainy' ELSE 'Post-Monsoon' END AS season
  FROM (SELECT o_orderkey % 100 AS c, month(o_orderdate) AS m FROM orders)) GROUP BY ALL""")
def s3(spark, sf):
    df = table(spark, sf, "orders").select((F.col("o_orderkey") % 100).cast("int").alias("code"),
                                           F.month("o_orderdate").alias("month"))
    df = joins.lookup(df, dimensions.weather_code(spark), "code")
    df = joins.lookup(df, dimensions.season(spark), "month")
    return df.groupBy("label", "season").agg(F.count(F.lit(1)).alias("n"))


# A raw text version of orders: bad numbers, two date formats, bad dates, nulls and repeated rows.
RAW_SQL = f"""raw AS (SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
  CASE WHEN o_orderkey % 97 = 0 THEN 'abc' ELSE CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) END AS price,
  {_DATE_TEXT} AS day, CASE WHEN o_orderkey % 89 <> 0 THEN o_orderpriority END AS priority FROM orders),
twice AS (SELECT * FROM raw UNION ALL SELECT * FROM raw WHERE CAST(order_id AS BIGINT) % 50 = 0),
typed AS (SELECT CAST(order_id AS BIGINT) AS order_id, TRY_CAST(price AS DOUBLE) AS price,
  CAST(CAST(coalesce(try_strptime(day, '%Y-%m-%d'), try_strptime(day, '%d-%m-%Y')) AS DATE) AS VARCHAR) AS day, priority FROM twice)"""
RAW_TYPES = {"order_id": "bigint", "price": "double"}


def raw_orders(spark, sf):
    o = table(spark, sf, "orders")
    raw = o.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.when(F.col("o_orderkey") % 97 == 0, "abc").otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("price"),
        date_text().alias("day"), F.when(F.col("o_orderkey") % 89 != 0, F.col("o_orderpriority")).alias("priority"))
    return raw.unionByName(raw.where(F.col("order_id").cast("bigint") % 50 == 0))


@query("v1_zero_nulls", f"""WITH {RAW_SQL}
SELECT 'no_nulls' AS check_name, coalesce(sum(n), 0) = 0 AS passed, coalesce(sum(n), 0)::BIGINT AS observed FROM
 (SELECT (order_id IS NULL)::INT + (price IS NULL)::INT + (day IS NULL)::INT + (priority IS NULL)::INT AS n FROM typed)""")
def v1(spark, sf):
    return quality.checks(quality.typed(raw_orders(spark, sf), RAW_TYPES, ["day"]), min_rows=None)


@query("v2_min_rows", "SELECT 'min_rows' AS check_name, count(*) >= 50000 AS passed, count(*) AS observed FROM lineitem")
def v2(spark, sf):
    return quality.checks(table(spark, sf, "lineitem"), no_nulls=False)


@query("v3_clean", f"""WITH {RAW_SQL}
SELECT DISTINCT * FROM typed WHERE order_id IS NOT NULL AND price IS NOT NULL AND day IS NOT NULL AND priority IS NOT NULL""")
def v3(spark, sf):
    return quality.clean(raw_orders(spark, sf), RAW_TYPES, ["day"]).withColumn("day", F.col("day").cast("string"))


@query("v3_clean_audit", f"""WITH {RAW_SQL}, d AS (SELECT DISTINCT * FROM typed)
SELECT 0 AS step, 'loaded' AS stage, count(*) AS row_count FROM typed
UNION ALL SELECT 1, 'deduplicated', count(*) FROM d
UNION ALL SELECT 2, 'complete', count(*) FROM d WHERE order_id IS NOT NULL AND price IS NOT NULL AND day IS NOT NULL AND priority IS NOT NULL""")
def v3_audit(spark, sf):
    return quality.clean_audit(raw_orders(spark, sf), RAW_TYPES, ["day"])


@query("a1_stage_counts", f"""WITH {RAW_SQL}
SELECT 0 AS step, 'loaded' AS stage, count(*) AS row_count, 4 AS column_count FROM twice
UNION ALL SELECT 1, 'deduplicated', count(*), 4 FROM (SELECT DISTINCT * FROM typed)
UNION ALL SELECT 2, 'selected', count(*), 2 FROM (SELECT DISTINCT * FROM typed)""")
def a1(spark, sf):
    """Counted by the one job that writes the last stage."""
    trail = audit.Trail()
    raw = trail.watch(raw_orders(spark, sf), "loaded")
    distinct = trail.watch(joins.drop_duplicates(quality.typed(raw, RAW_TYPES, ["day"])), "deduplicated")
    materialize(trail.watch(project.keep(distinct, ["order_id", "price"]), "selected"))
    return trail.table(spark).drop("missing")


@query("v3_clean_observed", f"""WITH {RAW_SQL}, d AS (SELECT DISTINCT * FROM typed)
SELECT 0 AS step, 'loaded' AS stage, count(*) AS row_count, 0::BIGINT AS no_price, 0::BIGINT AS no_day, 0::BIGINT AS no_priority FROM typed
UNION ALL SELECT 1, 'deduplicated', count(*), count(*) FILTER (price IS NULL), count(*) FILTER (day IS NULL), count(*) FILTER (priority IS NULL) FROM d
UNION ALL SELECT 2, 'complete', count(*), 0, 0, 0 FROM d WHERE order_id IS NOT NULL AND price IS NOT NULL AND day IS NOT NULL AND priority IS NOT NULL""")
def v3_observed(spark, sf):
    """Cleaned rows written and audited in one job."""
    out = quality.clean_to(raw_orders(spark, sf), RAW_TYPES, ["day"], scratch_path(spark, "cleaned"))
    return out.select("step", "stage", "row_count", *[F.coalesce(F.col("missing")[c], F.lit(0)).alias(f"no_{c}") for c in ("price", "day", "priority")])


# Labels in two loads: cheap parts first, then all of them; the second load adds names, and types of both loads are encoded.
@query("w3_dictionary", """WITH one AS (SELECT DISTINCT p_type || ' ' || p_brand AS v FROM part WHERE p_retailprice < 905),
two AS (SELECT DISTINCT p_type || ' ' || p_brand AS v FROM part),
known AS (SELECT v, (row_number() OVER (ORDER BY v) - 1)::INTEGER AS code, 1 AS since FROM one),
fresh AS (SELECT v, ((SELECT count(*) FROM one) + row_number() OVER (ORDER BY v) - 1)::INTEGER AS code, 2 AS since FROM two WHERE v NOT IN (SELECT v FROM one)),
latest AS (SELECT * FROM known UNION ALL SELECT * FROM fresh)
SELECT p_partkey, coalesce(k.code, -1) AS first_code, l.code AS last_code, l.since FROM part
 LEFT JOIN known k ON k.v = p_type || ' ' || p_brand JOIN latest l ON l.v = p_type || ' ' || p_brand""")
def w3_dictionary(spark, sf):
    """Codes of the first version stay in the second; a reader may name either."""
    path = scratch_path(spark, "dictionary")
    part = table(spark, sf, "part").select("p_partkey", "p_retailprice", F.concat_ws(" ", "p_type", "p_brand").alias("label"))
    first = dictionary.update(part.where("p_retailprice < 905"), "label", path)
    last = dictionary.update(part, "label", path)
    dictionary.update(part, "label", path)  # nothing new: no version
    old = dictionary.encode(part, "label", path, first, "first_code", on_unknown="minus_one")
    return (dictionary.encode(old, "label", path, name="last_code")
            .join(dictionary.read(spark, path, last).select(F.col("value").alias("label"), "since"), "label")
            .select("p_partkey", "first_code", "last_code", "since"))
