"""Counts, profiles, means, KPIs, quantiles, correlations, lines, histograms and box plots."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.catalog import query, table
from panelspark.catalog.columns import SQL_SEASON
from panelspark.catalog.learning import LINE_FIT_SQL, ML_SPLIT_SQL, fitted_line_rows
from panelspark.functions import scalars as S
from panelspark.operators import correlation, histogram, joins, quantiles, sketches, summary
from panelspark.runtime import scratch_path
from panelspark.sources import writers
from panelspark.plans import eda


def rounded(df, digits: int, columns: list[str]):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("a2_null_counts", """
SELECT 'order_id' AS column_name, 0::BIGINT AS nulls
UNION ALL SELECT 'status', count(*) FILTER (o_orderstatus = 'F') FROM orders
UNION ALL SELECT 'price', count(*) FILTER (o_totalprice > 400000 OR o_totalprice < 5000) FROM orders""")
def a2(spark, sf):
    """Nulls in ``status``; nulls and NaN in ``price``."""
    price = F.when(F.col("o_totalprice") > 400000, F.lit(float("nan"))).when(F.col("o_totalprice") >= 5000, F.col("o_totalprice"))
    df = table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"),
                                           F.nullif("o_orderstatus", F.lit("F")).alias("status"), price.alias("price"))
    return summary.null_counts(df)


@query("a2_total_nulls", "SELECT count(*) FILTER (o_orderstatus = 'F') AS total_nulls FROM orders")
def a2_total(spark, sf):
    df = table(spark, sf, "orders").withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("F")))
    return summary.total_nulls(df)


@query("a3_duplicate_count", """
SELECT count(*) AS row_count, count(*) - (SELECT count(*) FROM orders WHERE o_orderkey % 10 = 0) AS distinct_rows,
  (SELECT count(*) FROM orders WHERE o_orderkey % 10 = 0) AS duplicates
FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 10 = 0)""")
def a3(spark, sf):
    o = table(spark, sf, "orders")
    return summary.duplicate_count(o.unionByName(o.where("o_orderkey % 10 = 0")))


_STATS = """count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, round(min({c}), 4) AS min,
 round(quantile_cont({c}, 0.25), 4) AS p25, round(quantile_cont({c}, 0.5), 4) AS p50, round(quantile_cont({c}, 0.75), 4) AS p75, round(max({c}), 4) AS max"""


@query("a4_describe", " UNION ALL ".join(
    f"SELECT '{c}' AS variable, {_STATS.format(c=c)} FROM lineitem" for c in ("l_quantity", "l_extendedprice", "l_tax")))
def a4(spark, sf):
    return quantiles.describe(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_tax"], digits=4)


@query("a4_describe_by_group", " UNION ALL ".join(
    f"SELECT event_type, '{c}' AS variable, {_STATS.format(c=c)} FROM events GROUP BY event_type" for c in ("value", "user_id")))
def a4_by(spark, sf):
    return quantiles.describe(table(spark, sf, "events"), ["value", "user_id"], ["event_type"], digits=4)


@query("a4_quantiles_by_counting", """
SELECT l_returnflag, 'l_extendedprice' AS variable, count(*) AS n, round(quantile_cont(l_extendedprice, 0.25), 4) AS p25,
 round(quantile_cont(l_extendedprice, 0.5), 4) AS p50, round(quantile_cont(l_extendedprice, 0.9), 4) AS p90 FROM lineitem GROUP BY 1""")
def a4_counting(spark, sf):
    """The way large groups take: ranks located by counting cells."""
    q = quantiles.exact_quantiles(table(spark, sf, "lineitem"), ["l_extendedprice"], [0.25, 0.5, 0.9], ["l_returnflag"],
                                  small_group=0)
    return q.select("l_returnflag", "variable", "n",
                    *[F.round(F.element_at("q", i + 1), 4).alias(p) for i, p in enumerate(("p25", "p50", "p90"))])


@query("a5_group_mean", "SELECT p_type, round(avg(p_retailprice), 4) AS mean_price FROM part GROUP BY 1")
def a5(spark, sf):
    return rounded(summary.group_mean(table(spark, sf, "part"), ["p_type"], "p_retailprice", "mean_price"), 4, ["mean_price"])


@query("a5_sector_season_mean", f"""
SELECT c_mktsegment AS sector, season, round(avg(l_extendedprice), 4) AS mean_value
FROM lineitem JOIN (SELECT o_orderkey, o_custkey, {SQL_SEASON} AS season FROM orders) ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey GROUP BY ALL""")
def a5_season(spark, sf):
    """Lines are summed per order before the joins: one shuffle of the fact table, on the key of
    the join that follows, with hot orders combined on the map side."""
    lines = (table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
             .agg(F.sum("l_extendedprice").alias("total"), F.count("l_extendedprice").alias("lines")))
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("sector"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", S.season(F.month("o_orderdate")).alias("season"))
    panel = orders.join(customer, "o_custkey").join(lines, "o_orderkey")
    return rounded(summary.group_mean_of_sums(panel, ["sector", "season"], "total", "lines"), 4, ["mean_value"])


@query("a6_month_mean", """
SELECT month(o_orderdate)::INTEGER AS month, any_value(strftime(o_orderdate, '%b')) AS month_name, round(avg(o_totalprice), 4) AS mean_value
FROM orders GROUP BY 1""")
def a6(spark, sf):
    return rounded(summary.month_mean(table(spark, sf, "orders"), F.month("o_orderdate"), "o_totalprice"), 4, ["mean_value"])


@query("a7_entity_summary", """
SELECT n_name, round(avg(c_acctbal), 4) AS mean_value, max(n_regionkey) AS n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def a7(spark, sf):
    nation = table(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    df = joins.lookup(table(spark, sf, "customer"), nation, "c_nationkey")
    return rounded(summary.entity_summary(df, ["n_name"], "c_acctbal", ["n_regionkey"]), 4, ["mean_value"])


def kpi_sql(value: str, source: str, by: str = "") -> str:
    def shown(x, d):
        return f"round(CAST(round({x}, 6) AS DECIMAL(28, 6)), {d})::DOUBLE"
    group = f" GROUP BY {by}" if by else ""
    return (f"SELECT {by + ', ' if by else ''}{shown(f'avg({value})', 1)} AS avg, {shown(f'max({value})', 1)} AS peak, "
            f"{shown(f'min({value})', 1)} AS low, {shown(f'sum({value})', 0)} AS total FROM {source}{group}")


@query("a8_kpis", kpi_sql("o_totalprice", "orders"))
def a8(spark, sf):
    return summary.kpis(table(spark, sf, "orders"), "o_totalprice")


@query("a8_kpis_by_series", kpi_sql("l_extendedprice", "lineitem", "l_returnflag"))
def a8_by(spark, sf):
    return summary.kpis(table(spark, sf, "lineitem"), "l_extendedprice", ["l_returnflag"])


@query("a9_range", "SELECT l_linestatus, min(l_extendedprice) AS min_value, max(l_extendedprice) AS max_value FROM lineitem GROUP BY 1")
def a9_range(spark, sf):
    return summary.value_range(table(spark, sf, "lineitem"), "l_extendedprice", ["l_linestatus"])


@query("a9_profile", """
WITH e AS (SELECT event_id, ts, nullif(user_id, 7) AS user_id, event_type, value FROM events)
SELECT count(*) AS row_count, count(*) FILTER (user_id IS NULL) AS missing_values, 0::BIGINT AS duplicate_rows,
 strftime(min(ts), '%Y-%m-%d') AS first_date, strftime(max(ts), '%Y-%m-%d') AS last_date,
 count(DISTINCT event_type) AS distinct_event_type, count(DISTINCT user_id) AS distinct_user_id, min(value) AS min_value, max(value) AS max_value FROM e""")
def a9(spark, sf):
    df = table(spark, sf, "events").drop("props").withColumn("user_id", F.nullif("user_id", F.lit(7)))
    return summary.profile(df, "ts", ["event_type", "user_id"], "value")


@query("a10_pearson", "SELECT round(corr(p_partkey, p_retailprice), 6) AS r FROM part")
def a10(spark, sf):
    return rounded(correlation.pearson(table(spark, sf, "part"), "p_partkey", "p_retailprice"), 6, ["r"])


CORR_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_suppkey", "l_partkey"]


def corr_sql(triangle: bool) -> str:
    pairs = [(a, b) for i, a in enumerate(CORR_COLUMNS) for j, b in enumerate(CORR_COLUMNS) if not triangle or i > j]
    cols = ", ".join(f"round(corr({a}, {b}), 6) AS c{i}" for i, (a, b) in enumerate(pairs))
    rows = " UNION ALL ".join(f"SELECT '{a}' AS x, '{b}' AS y, c{i} AS r FROM w" for i, (a, b) in enumerate(pairs))
    nulls = "CASE WHEN l_linenumber <> 3 THEN l_tax END"
    source = f"(SELECT * REPLACE ({nulls} AS l_tax) FROM lineitem)"
    return f"WITH w AS (SELECT {cols} FROM {source}) {rows}"


def lines_with_gaps(spark, sf):
    return table(spark, sf, "lineitem").withColumn("l_tax", F.when(F.col("l_linenumber") != 3, F.col("l_tax")))


@query("a11_correlation_matrix", corr_sql(False))
def a11(spark, sf):
    """One column has nulls: every pair uses the rows where both values are present."""
    return rounded(correlation.correlation_matrix(lines_with_gaps(spark, sf), CORR_COLUMNS), 6, ["r"])


@query("a12_lower_triangle", corr_sql(True))
def a12(spark, sf):
    return rounded(correlation.correlation_matrix(lines_with_gaps(spark, sf), CORR_COLUMNS, triangle=True), 6, ["r"])


@query("a13_target_correlations", """
WITH w AS (SELECT event_type, corr(value, user_id) AS vu, corr(value, hour(ts)) AS vh, corr(user_id, hour(ts)) AS uh FROM events GROUP BY 1)
SELECT event_type, x, y, round(r, 6) AS r FROM w, LATERAL (VALUES ('value', 'value', 1.0::DOUBLE), ('user_id', 'user_id', 1.0::DOUBLE), ('hour', 'hour', 1.0::DOUBLE),
 ('value', 'user_id', vu), ('user_id', 'value', vu), ('value', 'hour', vh), ('hour', 'value', vh), ('user_id', 'hour', uh), ('hour', 'user_id', uh)) t(x, y, r)""")
def a13(spark, sf):
    """The constant column is left out."""
    df = table(spark, sf, "events").select("event_type", "value", "user_id", F.hour("ts").alias("hour"), F.lit(5.0).alias("constant"))
    return rounded(correlation.target_correlations(df, "value", ["user_id", "constant", "hour"], ["event_type"]), 6, ["r"])


@query("a14_fit_line", """
SELECT round(regr_slope(p_retailprice, p_partkey), 9) AS slope, round(regr_intercept(p_retailprice, p_partkey), 6) AS intercept,
 min(p_partkey)::DOUBLE AS x_min, max(p_partkey)::DOUBLE AS x_max, count(*) AS n FROM part""")
def a14(spark, sf):
    fit = correlation.fit_line(table(spark, sf, "part"), "p_partkey", "p_retailprice")
    return rounded(rounded(fit, 9, ["slope"]), 6, ["intercept"])


@query("a14_fit_entity_means", """
SELECT round(regr_slope(m, x), 6) AS slope, round(regr_intercept(m, x), 4) AS intercept, min(x) AS x_min, max(x) AS x_max, count(*) AS n
FROM (SELECT c_nationkey, avg(c_acctbal) AS m, max(1234567 * (c_nationkey + 1)) / 1e6::DOUBLE AS x FROM customer GROUP BY 1)""")
def a14_means(spark, sf):
    """Line through per-place means, x in millions."""
    df = table(spark, sf, "customer").withColumn("population", F.lit(1234567) * (F.col("c_nationkey") + 1))
    means = summary.entity_summary(df, ["c_nationkey"], "c_acctbal", ["population"])
    fit = correlation.fit_line(means.withColumn("millions", F.col("population") / F.lit(1e6)), "millions", "mean_value")
    return rounded(rounded(fit, 6, ["slope"]), 4, ["intercept"])


@query("a15_line_points", """
WITH f AS (SELECT regr_slope(p_retailprice, p_partkey) AS slope, regr_intercept(p_retailprice, p_partkey) AS intercept, min(p_partkey)::DOUBLE AS lo, max(p_partkey)::DOUBLE AS hi FROM part)
SELECT i::INTEGER AS i, round(x, 6) AS x, round(slope * x + intercept, 6) AS y
FROM (SELECT i, slope, intercept, CASE WHEN i = 199 THEN hi ELSE lo + i * (hi - lo) / 199.0::DOUBLE END AS x FROM f, range(200) r(i))""")
def a15(spark, sf):
    fit = correlation.fit_line(table(spark, sf, "part"), "p_partkey", "p_retailprice")
    return rounded(correlation.line_points(fit, 200), 6, ["x", "y"])


def histogram_sql(source: str, columns: list[str], bins: str, by: str = "") -> str:
    """Histogram of each column of a relation; ``bins`` may use the row count c of the group."""
    g, comma = (by, by + ", ") if by else ("", "")
    parts = []
    for c in columns:
        on = f"USING ({by})" if by else "ON true"
        parts.append(f"""SELECT {comma}'{c}' AS variable, b.bin::INTEGER AS bin, round(e.lo + (b.bin - 1) * ((e.hi - e.lo) / e.n), 6) AS bin_low,
 round(CASE WHEN b.bin = e.n THEN e.hi ELSE e.lo + b.bin * ((e.hi - e.lo) / e.n) END, 6) AS bin_high,
 (SELECT count(*) FROM {source} s WHERE s.{c} IS NOT NULL {f'AND s.{by} = e.{by}' if by else ''}
   AND least(floor(e.n * (s.{c} - e.lo) / (e.hi - e.lo)) + 1, e.n) = b.bin) AS count
FROM (SELECT {comma}min({c})::DOUBLE - CASE WHEN min({c}) = max({c}) THEN 0.5 ELSE 0 END AS lo, max({c})::DOUBLE + CASE WHEN min({c}) = max({c}) THEN 0.5 ELSE 0 END AS hi,
      {bins.format(c=f'count({c})')} AS n FROM {source}{f' GROUP BY {g}' if g else ''}) e, LATERAL (SELECT unnest(range(1, e.n::BIGINT + 1)) AS bin) b""")
    return " UNION ALL ".join(parts)


@query("a16_histogram", histogram_sql("lineitem", ["l_extendedprice", "l_quantity"], "50"))
def a16(spark, sf):
    return rounded(histogram.histogram(table(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"], 50), 6, ["bin_low", "bin_high"])


@query("a16_centre_lines", """
SELECT 'l_extendedprice' AS variable, round(avg(l_extendedprice), 4) AS mean, round(median(l_extendedprice), 4) AS median FROM lineitem
UNION ALL SELECT 'l_quantity', round(avg(l_quantity), 4), round(median(l_quantity), 4) FROM lineitem""")
def a16_lines(spark, sf):
    return rounded(histogram.centre_lines(table(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"]), 4, ["mean", "median"])


@query("a17_actual_predicted", f"WITH {ML_SPLIT_SQL}, {LINE_FIT_SQL} " + histogram_sql("line_scored", ["actual", "predicted"], "60"))
def a17(spark, sf):
    _, scored = fitted_line_rows(spark, sf)
    return rounded(histogram.histogram(scored, ["actual", "predicted"], 60), 6, ["bin_low", "bin_high"])


@query("a17_means", f"""WITH {ML_SPLIT_SQL}, {LINE_FIT_SQL}
SELECT 'actual' AS variable, round(avg(actual), 4) AS mean, round(median(actual), 4) AS median FROM line_scored
UNION ALL SELECT 'predicted', round(avg(predicted), 4), round(median(predicted), 4) FROM line_scored""")
def a17_means(spark, sf):
    return rounded(histogram.centre_lines(fitted_line_rows(spark, sf)[1], ["actual", "predicted"]), 4, ["mean", "median"])


@query("a18_adaptive_histogram", histogram_sql("supplier", ["s_acctbal"], "least(20, greatest(5, {c} // 2))", "s_nationkey"))
def a18(spark, sf):
    return rounded(histogram.histogram(table(spark, sf, "supplier"), ["s_acctbal"], None, ["s_nationkey"]), 6, ["bin_low", "bin_high"])


BOX_SQL = """WITH q AS (SELECT l_returnflag, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3
 FROM (SELECT *, l_extendedprice * l_quantity AS v FROM lineitem) GROUP BY 1)
SELECT l_returnflag, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
 min(v) FILTER (v >= q1 - 1.5::DOUBLE * (q3 - q1) AND v <= q3 + 1.5::DOUBLE * (q3 - q1)) AS whisker_low,
 max(v) FILTER (v >= q1 - 1.5::DOUBLE * (q3 - q1) AND v <= q3 + 1.5::DOUBLE * (q3 - q1)) AS whisker_high,
 count(*) FILTER (v < q1 - 1.5::DOUBLE * (q3 - q1) OR v > q3 + 1.5::DOUBLE * (q3 - q1)) AS outliers, round(avg(v), 4) AS mean, count(*) AS n,
 CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END::BIGINT AS position
FROM (SELECT *, l_extendedprice * l_quantity AS v FROM lineitem) JOIN q USING (l_returnflag) GROUP BY ALL"""


@query("a19_box_stats", BOX_SQL)
def a19(spark, sf):
    df = table(spark, sf, "lineitem").select("l_returnflag", (F.col("l_extendedprice") * F.col("l_quantity")).alias("v"))
    out = eda.ordered_boxes(df, "l_returnflag", "v", ["R", "A", "N"])
    return rounded(out, 4, ["q1", "median", "q3", "mean"])


@query("a20_extreme_rows", """
WITH d AS (SELECT l_returnflag, strftime(l_shipdate, '%Y-%m-%d') AS day, round(sum(l_quantity), 2) AS v FROM lineitem GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY v DESC, day) AS hi, row_number() OVER (PARTITION BY l_returnflag ORDER BY v, day) AS lo FROM d)
SELECT a.l_returnflag, a.day AS peak_day, a.v AS peak_v, b.day AS low_day, b.v AS low_v FROM r a JOIN r b USING (l_returnflag) WHERE a.hi = 1 AND b.lo = 1""")
def a20(spark, sf):
    """Ties on the lowest day are common here; the first day wins."""
    daily = (table(spark, sf, "lineitem").groupBy("l_returnflag", S.format_date("l_shipdate").alias("day"))
             .agg(F.round(F.sum("l_quantity"), 2).alias("v")))
    return summary.extreme_rows(daily, "v", "day", ["day", "v"], ["l_returnflag"])


@query("a21_share", """
SELECT p_type, n, round(n / sum(n) OVER (), 6) AS share, round(100 * n / sum(n) OVER (), 3) AS pct FROM (SELECT p_type, count(*) AS n FROM part GROUP BY 1)""")
def a21(spark, sf):
    counts = table(spark, sf, "part").groupBy("p_type").agg(F.count(F.lit(1)).alias("n"))
    out = summary.share(counts, "n")
    return out.select("p_type", "n", F.round("share", 6).alias("share"), F.round(F.col("share") * 100, 3).alias("pct"))


SKETCH_SHARES = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]


@query("a4_sketch_quantiles", f"""SELECT event_type, (SELECT count(*) FROM events e WHERE e.event_type = t.event_type AND e.value IS NOT NULL) AS n,
  share, true AS within FROM (SELECT DISTINCT event_type FROM events WHERE value IS NOT NULL) t, (SELECT unnest({SKETCH_SHARES!r}::DOUBLE[]) AS share)""")
def a4_sketches(spark, sf):
    """Sketches of every type and day are stored, merged over all days, and their answers ranked among the rows: each rank
    must be within the error of a sketch."""
    path = scratch_path(spark, "sketches")
    events = table(spark, sf, "events").select("event_type", "value", S.format_date("ts").alias("day"))
    writers.write_periods(sketches.sketch(events, ["event_type", "day"], "value"), path, ["day"])
    daily = spark.read.parquet(path)
    told = sketches.quantiles(sketches.merge(daily, ["event_type"]), ["event_type"], SKETCH_SHARES)
    ranked = events.join(F.broadcast(told), "event_type").groupBy("event_type", "n", "share").agg(
        F.avg((F.col("value") < F.col("quantile")).cast("double")).alias("below"),
        F.avg((F.col("value") <= F.col("quantile")).cast("double")).alias("upto"))
    error = sketches.rank_error()
    return ranked.select("event_type", "n", "share", ((F.col("below") <= F.col("share") + error) & (F.col("upto") >= F.col("share") - error)).alias("within"))
