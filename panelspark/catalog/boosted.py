"""Tree ensembles: regularised boosting against SQL that grows the same trees, full-size models, trees as tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.catalog import query
from panelspark.catalog.learning import ML_FEATURES, ML_SPLIT_SQL, halves, marked_orders
from panelspark.operators import trees
from panelspark.plans import boosting, evaluation, models
from panelspark.plans.models import split

# Features of few values, so that every value is a bin of its own and SQL can list all splits.
FEW = ["month", "day_of_week", "priority_enc", "segment_enc"]
ROUNDS, DEPTH = 3, 2
UNIT = 2.0 ** -16


def boosted_sql(rounds: int = ROUNDS, depth: int = DEPTH) -> str:
    """Common table expressions that grow ``rounds`` trees: ``nodes`` as in ``panelspark.operators.trees`` and, after round t,
    ``p<t>`` with the prediction of every row."""
    u, x = f"({UNIT!r}::DOUBLE)", ", ".join(f"{f}" for f in FEW)
    value = "CASE s.k " + " ".join(f"WHEN {i} THEN r.{f}" for i, f in enumerate(FEW)) + " END"
    out = [f"""d AS MATERIALIZED (SELECT o_orderkey, is_test, target AS y, {x} FROM marked)""",
           f"""top AS MATERIALIZED (SELECT {', '.join(f'max({f}) AS m{i}' for i, f in enumerate(FEW))} FROM d WHERE NOT is_test)""",
           f"""base AS MATERIALIZED (SELECT (sum(floor(y / {u} + 0.5::DOUBLE)::HUGEINT) // count(*))::DOUBLE * {u} AS b FROM d WHERE NOT is_test)""",
           "p0 AS MATERIALIZED (SELECT d.*, b AS p FROM d, base)"]
    nodes = []
    for t in range(1, rounds + 1):
        out.append(f"r{t}_0 AS MATERIALIZED (SELECT *, floor((y - p) / {u} + 0.5::DOUBLE)::BIGINT AS r, 1 AS node FROM p{t - 1})")
        for deep in range(depth):
            a = f"r{t}_{deep}"
            longer = " UNION ALL ".join(f"SELECT node, {i} AS k, {f} AS x, {f} < (SELECT m{i} FROM top) AS able, r FROM {a} WHERE NOT is_test"
                                        for i, f in enumerate(FEW))
            out += [f"""w{t}_{deep} AS MATERIALIZED (SELECT node, sum(r)::DOUBLE AS g, count(*)::DOUBLE AS h FROM {a}
  WHERE NOT is_test AND node >= {1 << deep} GROUP BY node)""",
                    f"""c{t}_{deep} AS (SELECT node, k, x, able, sum(g) OVER o AS gl, sum(h) OVER o AS hl FROM
  (SELECT node, k, x, able, sum(r)::DOUBLE AS g, count(*)::DOUBLE AS h FROM ({longer}) GROUP BY ALL) WINDOW o AS (PARTITION BY node, k ORDER BY x))""",
                    f"""s{t}_{deep} AS MATERIALIZED (SELECT * FROM (SELECT node, k, x, 0.5::DOUBLE * ((gl * {u}) * (gl * {u}) / (hl + 1.0::DOUBLE)
    + ((g - gl) * {u}) * ((g - gl) * {u}) / (h - hl + 1.0::DOUBLE) - (g * {u}) * (g * {u}) / (h + 1.0::DOUBLE)) AS gain, g, h
  FROM c{t}_{deep} JOIN w{t}_{deep} USING (node) WHERE able AND hl >= 1 AND h - hl >= 1)
  WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, k, x) = 1)""",
                    f"""r{t}_{deep + 1} AS MATERIALIZED (SELECT r.* EXCLUDE (node), CASE WHEN s.node IS NULL THEN r.node
  ELSE 2 * r.node + ({value} > s.x)::INTEGER END AS node FROM {a} r LEFT JOIN s{t}_{deep} s USING (node))"""]
            nodes.append(f"""SELECT {t} AS tree, node, {"CASE k " + " ".join(f"WHEN {i} THEN '{f}'" for i, f in enumerate(FEW)) + " END"} AS feature,
  x AS threshold, 0.1::DOUBLE * ((w.g * {u}) / (w.h + 1.0::DOUBLE)) AS value, coalesce(gain, 0) AS gain, w.h AS cover
  FROM w{t}_{deep} w LEFT JOIN s{t}_{deep} USING (node)""")
        last = f"r{t}_{depth}"
        out += [f"v{t} AS MATERIALIZED (SELECT node, sum(r)::DOUBLE AS g, count(*)::DOUBLE AS h FROM {last} WHERE NOT is_test GROUP BY node)",
                f"""p{t} AS MATERIALIZED (SELECT r.* EXCLUDE (p, r, node), p + 0.1::DOUBLE * ((g * {u}) / (h + 1.0::DOUBLE)) AS p
  FROM {last} r JOIN v{t} USING (node))"""]
        nodes.append(f"""SELECT {t}, node, NULL, NULL, 0.1::DOUBLE * ((g * {u}) / (h + 1.0::DOUBLE)), 0, h FROM v{t} WHERE node >= {1 << depth}""")
    return ", ".join([ML_SPLIT_SQL, *out, "nodes AS MATERIALIZED (" + " UNION ALL ".join(nodes) + ")"])


def small_model(spark, sf, valid=False):
    d = marked_orders(spark, sf)
    return d, boosting.boost(d if valid else d.where("not is_test"), ["o_orderkey"], FEW, "target", rounds=ROUNDS, depth=DEPTH, rows=1.0,
                             columns=1.0, unit=UNIT, valid="is_test" if valid else None)


def full_model(spark, sf, **more):
    """Published size: 500 rounds of depth 6, rows and columns sampled at 0.8."""
    train, test = halves(spark, sf)
    return boosting.boost(train, ["o_orderkey"], ML_FEATURES, "target", **more), test


@query("ml6_regularised_boosting", f"""WITH {boosted_sql()}
SELECT o_orderkey, round(y, 5) AS actual, round(p, 5) AS predicted FROM p{ROUNDS} WHERE is_test""")
def ml6_small(spark, sf):
    d, model = small_model(spark, sf)
    out = boosting.predict(model, d.where("is_test"), "predicted")
    return out.select("o_orderkey", F.round("target", 5).alias("actual"), F.round("predicted", 5).alias("predicted"))


@query("ml6_tree_nodes", f"""WITH {boosted_sql()}
SELECT tree, node, feature, threshold, CASE WHEN feature IS NOT NULL THEN 2 * node END AS "left",
  CASE WHEN feature IS NOT NULL THEN 2 * node + 1 END AS "right", round(value, 6) AS value, round(gain, 2) AS gain, cover FROM nodes""")
def ml6_nodes(spark, sf):
    """The fitted trees as a table."""
    return small_model(spark, sf)[1].nodes.withColumns({"value": F.round("value", 6), "gain": F.round("gain", 2)})


@query("ml6_boosting_500x6")
def ml6_full(spark, sf):
    model, test = full_model(spark, sf)
    return evaluation.metrics(boosting.predict(model, test, "predicted").select(F.col("target").alias("actual"), "predicted"))


_ROUNDS_SQL = " UNION ALL ".join(f"SELECT o_orderkey, {t} AS round, y, p FROM p{t} WHERE is_test" for t in range(1, ROUNDS + 1))


@query("ml7_round_metrics", f"""WITH {boosted_sql()}
SELECT round, round(sqrt(avg((y - p) ** 2)), 3) AS rmse, round(avg(abs(y - p)), 3) AS mae,
  round(1 - sum((y - p) ** 2) / (count(*) * var_pop(y)), 5) AS r2, round(avg(abs((y - p) / y)) * 100, 3) AS mape
FROM ({_ROUNDS_SQL}) GROUP BY round""")
def ml7_metrics(spark, sf):
    """All four metrics of held-out rows after each round, counted while fitting."""
    _, model = small_model(spark, sf, valid=True)
    return model.rounds.select("round", *[F.round(c, 5 if c == "r2" else 3).alias(c) for c in boosting.METRICS])


@query("ml7_round_scores", f"""WITH {boosted_sql()}
SELECT o_orderkey, round, round(y, 5) AS actual, round(p, 5) AS predicted FROM ({_ROUNDS_SQL})""")
def ml7_scores(spark, sf):
    """Predictions after each round as prefix sums of the trees' outputs."""
    d, model = small_model(spark, sf)
    out = trees.round_scores(model.nodes, d.where("is_test"), FEW, ["o_orderkey"], "target", model.base)
    return out.withColumns({c: F.round(c, 5) for c in ("actual", "predicted")})


@query("ml7_early_stopping")
def ml7_stopping(spark, sf):
    """Rounds until the error of a validation part has not fallen for 10 rounds; full depth."""
    train, _ = halves(spark, sf)
    fitted, kept_out = split(train, ["o_orderkey"], 0.25, 7)
    both = fitted.withColumn("late", F.lit(False)).unionByName(kept_out.withColumn("late", F.lit(True)))
    return boosting.boost(both, ["o_orderkey"], ML_FEATURES, "target", valid="late", patience=10).rounds


@query("ml11_importance_types", f"""WITH {boosted_sql()},
i AS (SELECT feature, count(*) AS weight, sum(gain) AS total_gain, sum(cover) AS total_cover FROM nodes WHERE feature IS NOT NULL GROUP BY feature),
f AS (SELECT unnest({FEW!r}) AS feature)
SELECT f.feature, coalesce(weight, 0) AS weight, round(coalesce(total_gain, 0), 2) AS total_gain, round(coalesce(total_gain / weight, 0), 2) AS gain,
  coalesce(total_cover, 0) AS total_cover, round(coalesce(total_cover / weight, 0), 4) AS cover,
  round(coalesce(total_gain / (SELECT sum(total_gain) FROM i), 0), 6) AS share FROM f LEFT JOIN i USING (feature)""")
def ml11_types(spark, sf):
    """Importance as gain, weight and cover, from the table of nodes."""
    out = trees.importance(small_model(spark, sf)[1].nodes, FEW)
    return out.withColumns({c: F.round(c, n) for c, n in (("total_gain", 2), ("gain", 2), ("cover", 4), ("share", 6))})


@query("ml11_importance_500x6")
def ml11_full(spark, sf):
    return trees.importance(full_model(spark, sf)[0].nodes, ML_FEATURES)


FOREST_ROWS_SQL = f"""WITH {ML_SPLIT_SQL}
SELECT o_orderkey, true AS equal FROM marked WHERE is_test"""


@query("ml9_forest_by_joins", FOREST_ROWS_SQL)
def ml9_forest(spark, sf):
    """A forest of the published size (100 trees, depth 10): its node table, joined level by level, must give what the
    model gives for every held-out row."""
    train, test = halves(spark, sf)
    model = models.fit(models.random_forest(ML_FEATURES, "target"), train)
    by_joins = trees.scores(trees.of_model(model, ML_FEATURES), test, ML_FEATURES, ["o_orderkey"])
    whole = models.score(model, test, "target", ["o_orderkey"])
    return whole.join(by_joins, "o_orderkey").select(
        "o_orderkey", (F.abs(F.col("predicted") - F.col("prediction")) <= 1e-9 * F.abs("predicted")).alias("equal"))
