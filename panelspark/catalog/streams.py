"""Streaming runs on files made of the tables, against SQL over the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.catalog import query, table
from panelspark.functions import scalars as S
from panelspark.runtime import scratch_path
from panelspark.streaming import clean_score

SCHEMA = "event_id string, ts string, user_id string, event_type string, value string"
TYPES = {"event_id": "bigint", "user_id": "bigint", "value": "double", "ts": "timestamp"}
_RAW_SQL = """raw AS (SELECT event_id, ts, user_id, event_type, CASE WHEN event_type = 'error' AND value < 5 THEN NULL ELSE value END AS value FROM events)"""


def raw_events(spark, sf):
    """Events as text; cheap errors have no number."""
    value = F.when((F.col("event_type") == "error") & (F.col("value") < 5), "none").otherwise(F.col("value").cast("string"))
    return table(spark, sf, "events").select(F.col("event_id").cast("string"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
                                             F.col("user_id").cast("string"), "event_type", value.alias("value"))


def score(d):
    return d.withColumn("predicted", F.round(S.clip(F.lit(20.0) + F.lit(2.5071371) * F.col("value") + F.when(F.col("event_type") == "purchase", 30.0).otherwise(0.0),
                                                    30.0, 300.0), 2))


@query("st1_clean_score", f"""WITH {_RAW_SQL} SELECT event_id, user_id, event_type, value,
  round(greatest(30.0::DOUBLE, least(300.0::DOUBLE, 20.0::DOUBLE + 2.5071371::DOUBLE * value + CASE WHEN event_type = 'purchase' THEN 30.0::DOUBLE ELSE 0.0::DOUBLE END)), 2) AS predicted
FROM raw WHERE value IS NOT NULL""")
def st1(spark, sf):
    """Files arrive in two parts, the second repeating all views of the first; the stream is stopped between them."""
    folder, sink, progress = (scratch_path(spark, n) for n in ("arriving", "scored", "progress"))
    raw = raw_events(spark, sf)
    half = table(spark, sf, "events").agg(F.expr("percentile_approx(event_id, 0.5)")).first()[0]
    first, second = raw.where(F.col("event_id").cast("bigint") <= half), raw.where(F.col("event_id").cast("bigint") > half)
    for part in (first, second.unionByName(first.where("event_type = 'view'"))):
        part.write.mode("append").option("header", True).csv(folder)
        rows = clean_score.clean(clean_score.arriving(spark, folder, SCHEMA, files_per_batch=4), TYPES, [], "ts", "3650 days")
        clean_score.run(clean_score.scored(rows, score), clean_score.write_batches(sink), progress)
    return clean_score.read_sink(spark, sink).select("event_id", "user_id", "event_type", "value", "predicted")
