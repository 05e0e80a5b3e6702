"""Splits, scaling, training, scoring, metrics and model comparison."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from panelspark.catalog import query, table
from panelspark.catalog.columns import sql_normal
from panelspark.functions import scalars as S
from panelspark.functions.hashing import normal, row_hash
from panelspark.operators import correlation, joins, leastsquares, sampling
from panelspark.plans import evaluation, models

ML_FEATURES = ["price_k", "balance_k", "month", "day_of_week", "priority_enc", "segment_enc"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

# Orders with customer attributes and a derived target that the features explain in part.
ML_SQL = f"""ml AS (SELECT o_orderkey, o_orderstatus, o_totalprice / 1000.0::DOUBLE AS price_k, c_acctbal / 1000.0::DOUBLE AS balance_k,
  month(o_orderdate)::DOUBLE AS month, (isodow(o_orderdate) - 1)::DOUBLE AS day_of_week,
  (substr(o_orderpriority, 1, 1)::INTEGER - 1)::DOUBLE AS priority_enc,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1 WHEN 'FURNITURE' THEN 2 WHEN 'HOUSEHOLD' THEN 3 ELSE 4 END::DOUBLE AS segment_enc,
  50.0::DOUBLE + 1.2::DOUBLE * (o_totalprice / 1000.0::DOUBLE) + 3.0::DOUBLE * (c_acctbal / 1000.0::DOUBLE)
   + CASE o_orderstatus WHEN 'F' THEN 120 WHEN 'O' THEN 200 ELSE 350 END
     * CASE o_orderpriority WHEN '1-URGENT' THEN 1.1::DOUBLE WHEN '2-HIGH' THEN 1.05::DOUBLE WHEN '3-MEDIUM' THEN 1.0::DOUBLE WHEN '4-NOT SPECIFIED' THEN 0.98::DOUBLE ELSE 0.95::DOUBLE END
   + 14.7310253::DOUBLE * {sql_normal("md5('7|' || o_orderkey)")} AS target
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

ML_SPLIT_SQL = ML_SQL + """, marked AS (SELECT *, row_number() OVER (ORDER BY md5('42|' || o_orderkey), o_orderkey)
  <= ceil(0.2 * (SELECT count(*) FROM ml)) AS is_test FROM ml)"""

METRICS_SQL = """sqrt(avg((actual - predicted) ** 2)) AS rmse, avg(abs(actual - predicted)) AS mae,
  1 - sum((actual - predicted) ** 2) / (count(*) * var_pop(actual)) AS r2, avg(abs((actual - predicted) / actual)) * 100 AS mape, count(*) AS n"""

# One-feature least squares on the train rows, scored on the test rows.
LINE_FIT_SQL = f"""line AS (SELECT regr_slope(target, price_k) AS slope, regr_intercept(target, price_k) AS intercept FROM marked WHERE NOT is_test),
line_scored AS (SELECT o_orderkey, target AS actual, intercept + slope * price_k AS predicted FROM marked, line WHERE is_test),
line_metrics AS (SELECT {METRICS_SQL} FROM line_scored)"""


def ml_orders(spark, sf, orders=None):
    """Features and target per order; extra columns of a given ``orders`` table are kept."""
    plain = table(spark, sf, "orders")
    orders = plain if orders is None else orders
    extra = [c for c in orders.columns if c not in plain.columns]
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_acctbal", "c_mktsegment")
    d = joins.lookup(orders, customer, "o_custkey")
    price, balance = F.col("o_totalprice") / F.lit(1000.0), F.col("c_acctbal") / F.lit(1000.0)
    weight = S.lookup("o_orderstatus", {"F": 120, "O": 200, "P": 350})
    modifier = S.lookup("o_orderpriority", dict(zip(PRIORITIES, [1.1, 1.05, 1.0, 0.98, 0.95], strict=True)))
    noise = F.lit(14.7310253) * normal(row_hash(["o_orderkey"], 7))
    return d.select(
        *extra, "o_orderkey", "o_orderstatus", price.alias("price_k"), balance.alias("balance_k"),
        F.month("o_orderdate").cast("double").alias("month"), F.weekday("o_orderdate").cast("double").alias("day_of_week"),
        S.encode("o_orderpriority", PRIORITIES).cast("double").alias("priority_enc"),
        S.encode("c_mktsegment", SEGMENTS).cast("double").alias("segment_enc"),
        (F.lit(50.0) + F.lit(1.2) * price + F.lit(3.0) * balance + weight * modifier + noise).alias("target"))


def marked_orders(spark, sf):
    """ml_orders with the exact 20 % test flag, set before the join: only order keys are scanned for it."""
    return ml_orders(spark, sf, sampling.exact_split(table(spark, sf, "orders"), 0.2, ["o_orderkey"]))


def halves(spark, sf):
    """Train and test rows of :func:`marked_orders`."""
    train, test = models.split(table(spark, sf, "orders"), ["o_orderkey"])
    return ml_orders(spark, sf, train), ml_orders(spark, sf, test)


def fitted_line_rows(spark, sf):
    """(train and test rows with the flag, scored test rows) of a one-feature line."""
    marked = marked_orders(spark, sf)
    # one row: fetched once, so later passes do not fit again
    line = correlation.fit_line(marked.where("not is_test"), "price_k", "target").first()
    predicted = F.lit(line.intercept) + F.lit(line.slope) * F.col("price_k")
    return marked, marked.where("is_test").select("o_orderkey", F.col("target").alias("actual"), predicted.alias("predicted"))


def evaluated_line(spark, sf):
    marked, scored = fitted_line_rows(spark, sf)
    counts = marked.agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(~F.col("is_test")).alias("train_rows"),
                        F.count_if("is_test").alias("test_rows"))
    return evaluation.metrics(scored), counts


def forest(spark, sf):
    """Published size: 100 trees of depth 10."""
    train, _ = halves(spark, sf)
    return models.fit(models.random_forest(ML_FEATURES, "target"), train)


def small_boosting(spark, sf):
    train, test = halves(spark, sf)
    return models.fit(models.gradient_boosting(ML_FEATURES, "target", rounds=5, max_depth=4), train), test


@query("ml1_assemble", f"""WITH {ML_SQL}
SELECT o_orderkey, price_k AS f0, balance_k AS f1, month AS f2 FROM ml WHERE month <> 2""")
def ml1(spark, sf):
    """Rows with a null feature are skipped: February months are made null here."""
    d = ml_orders(spark, sf).withColumn("month", F.nullif("month", F.lit(2.0)))
    v = models.assembler(["price_k", "balance_k", "month"]).transform(d)
    a = vector_to_array("features")
    return v.select("o_orderkey", *[a[i].alias(f"f{i}") for i in range(3)])


@query("ml2_standardise", f"""WITH {ML_SPLIT_SQL}
SELECT o_orderkey, round((price_k - m1) / s1, 6) AS price_k, round((balance_k - m2) / s2, 6) AS balance_k
FROM marked, (SELECT avg(price_k) m1, stddev_samp(price_k) s1, avg(balance_k) m2, stddev_samp(balance_k) s2 FROM marked WHERE NOT is_test)""")
def ml2(spark, sf):
    marked = marked_orders(spark, sf)
    out = models.standardise(marked, ["price_k", "balance_k"], ~F.col("is_test"))
    return out.select("o_orderkey", F.round("price_k", 6).alias("price_k"), F.round("balance_k", 6).alias("balance_k"))


@query("ml3_hash_split", "SELECT o_orderkey, ('0x' || substr(md5('42|' || o_orderkey), 1, 8))::BIGINT % 100 < 20 AS is_test FROM orders")
def ml3(spark, sf):
    return sampling.hash_split(table(spark, sf, "orders").select("o_orderkey"), 20, ["o_orderkey"])


@query("ml4_exact_split", """
SELECT o_orderkey, row_number() OVER (ORDER BY md5('42|' || o_orderkey), o_orderkey) <= ceil(0.2 * (SELECT count(*) FROM orders)) AS is_test FROM orders""")
def ml4(spark, sf):
    return sampling.exact_split(table(spark, sf, "orders").select("o_orderkey"), 0.2, ["o_orderkey"])


@query("ml5_random_forest")
def ml5(spark, sf):
    return evaluation.metrics(models.score(forest(spark, sf), halves(spark, sf)[1], "target"))


@query("ml6_gradient_boosting")
def ml6(spark, sf):
    model, test = small_boosting(spark, sf)
    return evaluation.metrics(models.score(model, test, "target"))


@query("ml7_round_losses")
def ml7(spark, sf):
    return models.round_losses(*small_boosting(spark, sf))


# Two standardised features: the normal equations in closed form.
OLS_SQL = """z AS (SELECT (price_k - avg(price_k) OVER ()) / stddev_samp(price_k) OVER () AS a,
  (balance_k - avg(balance_k) OVER ()) / stddev_samp(balance_k) OVER () AS b, target AS y FROM ml),
m AS (SELECT var_pop(a) AS vaa, var_pop(b) AS vbb, covar_pop(a, b) AS vab, covar_pop(a, y) AS vay, covar_pop(b, y) AS vby, avg(y) AS ybar FROM z),
ols AS (SELECT ybar AS intercept, (vay * vbb - vby * vab) / (vaa * vbb - vab * vab) AS ca, (vby * vaa - vay * vab) / (vaa * vbb - vab * vab) AS cb FROM m)"""


def two_feature_model(spark, sf):
    d = ml_orders(spark, sf)
    return models.fit(models.linear(["price_k", "balance_k"], "target"), d)


@query("ml8_least_squares", f"""WITH {ML_SQL}, {OLS_SQL}
SELECT feature, round(value, 6) AS value FROM (SELECT 'intercept' AS feature, intercept AS value FROM ols
 UNION ALL SELECT 'price_k', ca FROM ols UNION ALL SELECT 'balance_k', cb FROM ols)""")
def ml8(spark, sf):
    model = two_feature_model(spark, sf)
    lr = model.stages[-1]
    rows = [("intercept", float(lr.intercept)), *zip(["price_k", "balance_k"], map(float, lr.coefficients), strict=True)]
    return spark.createDataFrame(rows, "feature string, value double").withColumn("value", F.round("value", 6))


IMPORTANCE_SQL = f"""WITH {ML_SQL}, {OLS_SQL},
c AS (SELECT 'price_k' AS feature, ca AS coefficient FROM ols UNION ALL SELECT 'balance_k', cb FROM ols)
SELECT row_number() OVER (ORDER BY abs(coefficient) DESC, feature)::INTEGER AS rank, feature, round(coefficient, 6) AS coefficient,
 round(abs(coefficient), 6) AS abs_coef, round(abs(coefficient) / (SELECT sum(abs(coefficient)) FROM c), 6) AS importance,
 round(100 * abs(coefficient) / (SELECT sum(abs(coefficient)) FROM c), 3) AS importance_pct FROM c"""


@query("ml12_linear_importance", IMPORTANCE_SQL)
def ml12(spark, sf):
    model = two_feature_model(spark, sf)
    out = models.linear_importance(models.linear_coefficients(model, ["price_k", "balance_k"], spark))
    return out.withColumns({c: F.round(c, 6) for c in ("coefficient", "abs_coef", "importance")})


def elimination_sql(rows: str, by: str) -> str:
    """Common table expressions that solve least squares of ``target`` on all features of ``rows`` by Gauss-Jordan elimination,
    per value of ``by``: ``fit`` with ``b0`` (intercept), ``b1``..."""
    k = len(ML_FEATURES)
    names = [*ML_FEATURES, "target"]
    out = [f"""e0 AS MATERIALIZED (SELECT {by} AS g, count(*) AS n, {', '.join(f'avg({c}) AS m{i}' for i, c in enumerate(names))},
  {', '.join(f'covar_pop({a}, {b}) AS a{i}_{j}' for i, a in enumerate(ML_FEATURES) for j, b in enumerate(names))} FROM {rows} GROUP BY {by})"""]
    for p in range(k):
        cells = ", ".join(f"a{i}_{j} - a{i}_{p} * a{p}_{j} / a{p}_{p} AS a{i}_{j}" if i != p else f"a{i}_{j}" for i in range(k) for j in range(k + 1))
        out.append(f"e{p + 1} AS MATERIALIZED (SELECT g, n, {', '.join(f'm{i}' for i in range(k + 1))}, {cells} FROM e{p})")
    betas = [f"a{i}_{k} / a{i}_{i}" for i in range(k)]
    out.append(f"fit AS MATERIALIZED (SELECT g, n, m{k} - ({' + '.join(f'{b} * m{i}' for i, b in enumerate(betas))}) AS b0, "
               + ", ".join(f"{b} AS b{i + 1}" for i, b in enumerate(betas)) + f" FROM e{k})")
    return ", ".join(out)


_PREDICTED = "b0 + " + " + ".join(f"b{i + 1} * {f}" for i, f in enumerate(ML_FEATURES))


@query("ml8_linear_regression", f"""WITH {ML_SPLIT_SQL}, train AS (SELECT * FROM marked WHERE NOT is_test), {elimination_sql('train', '1')},
scored AS (SELECT target AS actual, {_PREDICTED} AS predicted FROM marked, fit WHERE is_test), m AS (SELECT {METRICS_SQL} FROM scored)
SELECT round(rmse, 4) AS rmse, round(mae, 4) AS mae, round(r2, 6) AS r2, round(mape, 4) AS mape, n FROM m""")
def ml8_all(spark, sf):
    """All features, metrics on held-out rows."""
    train, test = halves(spark, sf)
    model = models.fit(models.linear(ML_FEATURES, "target"), train)
    out = evaluation.metrics(models.score(model, test, "target"))
    return out.select(F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae"), F.round("r2", 6).alias("r2"),
                      F.round("mape", 4).alias("mape"), "n")


@query("ml8_group_least_squares", f"""WITH {ML_SQL}, {elimination_sql('ml', 'o_orderstatus')}
SELECT g AS o_orderstatus, n, {len(ML_FEATURES)} AS rank, feature, round(value, 4) AS coefficient FROM fit, LATERAL (VALUES ('intercept', b0),
  {', '.join(f"('{f}', b{i + 1})" for i, f in enumerate(ML_FEATURES))}) t(feature, value)""")
def ml8_groups(spark, sf):
    """Six features per group; sums are kept by group and weekday, then added up and solved."""
    kept = leastsquares.gram(ml_orders(spark, sf).withColumn("part", F.col("day_of_week")), ["o_orderstatus", "part"], ML_FEATURES, "target")
    out = leastsquares.solve(leastsquares.merge(kept, ["o_orderstatus"]), ["o_orderstatus"], ML_FEATURES)
    return out.withColumn("coefficient", F.round("coefficient", 4))


@query("ml9_score_groups", f"""WITH {ML_SQL}, {elimination_sql('ml', 'o_orderstatus')}
SELECT o_orderkey, round({_PREDICTED}, 4) AS predicted FROM ml JOIN fit ON g = o_orderstatus""")
def ml9_groups(spark, sf):
    d = ml_orders(spark, sf)
    solved = leastsquares.solve(leastsquares.gram(d, ["o_orderstatus"], ML_FEATURES, "target"), ["o_orderstatus"], ML_FEATURES)
    return leastsquares.predict(d, solved, ["o_orderstatus"], ML_FEATURES).select("o_orderkey", F.round("predicted", 4).alias("predicted"))


@query("ml9_score", f"""WITH {ML_SQL}, {OLS_SQL},
s AS (SELECT avg(price_k) AS ma, stddev_samp(price_k) AS sa, avg(balance_k) AS mb, stddev_samp(balance_k) AS sb FROM ml),
p AS (SELECT o_orderkey, target AS actual, intercept + ca * (price_k - ma) / sa + cb * (balance_k - mb) / sb AS predicted FROM ml, ols, s)
SELECT o_orderkey, round(actual, 5) AS actual, round(predicted, 5) AS predicted, round(abs(actual - predicted), 5) AS abs_error FROM p""")
def ml9(spark, sf):
    out = models.score(two_feature_model(spark, sf), ml_orders(spark, sf), "target", ["o_orderkey"])
    return out.select("o_orderkey", *[F.round(c, 5).alias(c) for c in ("actual", "predicted", "abs_error")])


@query("ml10_metrics", f"""WITH {ML_SPLIT_SQL}, {LINE_FIT_SQL}
SELECT round(rmse, 4) AS rmse, round(mae, 4) AS mae, round(r2, 6) AS r2, round(mape, 4) AS mape, n FROM line_metrics""")
def ml10(spark, sf):
    out, _ = evaluated_line(spark, sf)
    return out.select(F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae"), F.round("r2", 6).alias("r2"),
                      F.round("mape", 4).alias("mape"), "n")


@query("ml11_tree_importance")
def ml11(spark, sf):
    return models.tree_importance(forest(spark, sf), ML_FEATURES, spark)


@query("ml13_compare_models", f"""WITH {ML_SPLIT_SQL}, {LINE_FIT_SQL},
g AS (SELECT o_orderstatus, avg(target) AS p FROM marked WHERE NOT is_test GROUP BY 1),
group_scored AS (SELECT target AS actual, p AS predicted FROM marked JOIN g USING (o_orderstatus) WHERE is_test),
mean_scored AS (SELECT target AS actual, (SELECT avg(target) FROM marked WHERE NOT is_test) AS predicted FROM marked WHERE is_test),
all_metrics AS (SELECT 'mean' AS model, * FROM (SELECT {METRICS_SQL} FROM mean_scored)
 UNION ALL SELECT 'group', * FROM (SELECT {METRICS_SQL} FROM group_scored) UNION ALL SELECT 'line', * FROM line_metrics),
long AS (SELECT model, metric, round(value, 4) AS value, CASE metric WHEN 'r2' THEN -value ELSE value END AS cost FROM
 (SELECT model, 'rmse' AS metric, rmse AS value FROM all_metrics UNION ALL SELECT model, 'mae', mae FROM all_metrics
  UNION ALL SELECT model, 'r2', r2 FROM all_metrics UNION ALL SELECT model, 'mape', mape FROM all_metrics))
SELECT metric, max(value) FILTER (model = 'mean') AS mean, max(value) FILTER (model = 'group') AS "group", max(value) FILTER (model = 'line') AS line,
  arg_min(model, cost) AS best FROM long GROUP BY metric""")
def ml13(spark, sf):
    marked, line = fitted_line_rows(spark, sf)
    train = marked.where("not is_test")
    test = marked.where("is_test")
    means = train.groupBy("o_orderstatus").agg(F.avg("target").alias("predicted"))
    group = test.join(means, "o_orderstatus").select(F.col("target").alias("actual"), "predicted")
    mean = test.select(F.col("target").alias("actual"), train.agg(F.avg("target")).scalar().alias("predicted"))
    rows = None
    for name, scored in (("mean", mean), ("group", group), ("line", line.select("actual", "predicted"))):
        one = evaluation.metrics(scored).withColumn("model", F.lit(name))
        rows = one if rows is None else rows.unionByName(one)
    out = evaluation.compare_models(rows, ["mean", "group", "line"])
    return out.select("metric", *[F.round(c, 4).alias(c) for c in ("mean", "group", "line")], "best")


def residual_sql(n: int) -> str:
    return f"""WITH {ML_SPLIT_SQL}, {LINE_FIT_SQL}
SELECT o_orderkey, round(actual, 5) AS actual, round(predicted, 5) AS predicted, round(actual - predicted, 5) AS residual,
  round(abs(actual - predicted), 5) AS abs_residual, abs(actual - predicted) <= (SELECT rmse FROM line_metrics) AS in_band
FROM line_scored ORDER BY md5('42|' || o_orderkey), o_orderkey LIMIT {n}"""


def residuals(spark, sf, n):
    _, scored = fitted_line_rows(spark, sf)
    out = evaluation.residual_sample(scored, ["o_orderkey"], n)
    return out.withColumns({c: F.round(c, 5) for c in ("actual", "predicted", "residual", "abs_residual")})


@query("ml14_residual_sample", residual_sql(8000))
def ml14(spark, sf):
    return residuals(spark, sf, 8000)


@query("ml14_residual_sample_below_size", residual_sql(100))
def ml14_below(spark, sf):
    """A sample smaller than the test part at every size of the tables."""
    return residuals(spark, sf, 100)


@query("ml5_forest_of_group_means", f"""WITH {ML_SPLIT_SQL},
g AS (SELECT priority_enc, avg(target) AS p FROM marked WHERE NOT is_test GROUP BY 1)
SELECT o_orderkey, round(target, 5) AS actual, round(p, 5) AS predicted, round(abs(target - p), 5) AS abs_error
FROM marked JOIN g USING (priority_enc) WHERE is_test""")
def ml5_group_means(spark, sf):
    """Default size (100 trees, depth 10) without sampling: on one feature of few values a tree gives group means."""
    train, test = halves(spark, sf)
    forest = models.random_forest(["priority_enc"], "target", subsample=1.0, bootstrap=False)
    out = models.score(models.fit(forest, train), test, "target", ["o_orderkey"])
    return out.withColumns({c: F.round(c, 5) for c in ("actual", "predicted", "abs_error")})
