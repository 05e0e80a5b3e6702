from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from panelspark.operators import quality
from panelspark.plans import models
from panelspark.streaming import clean_score

SCHEMA = "id string, ts string, v string"
TYPES = {"id": "bigint", "ts": "timestamp", "v": "double"}


def drop(path, name, rows):
    (path / name).write_text("id,ts,v\n" + "".join(f"{i},{t},{v}\n" for i, t, v in rows))


def rows(a, b, day="2024-01-01"):
    return [(i, f"{day} 00:{i % 60:02d}:00", i * 1.5 if i % 7 else "bad") for i in range(a, b)]


def flow(spark, folder, delay="30 days", per_batch=1):
    return clean_score.clean(clean_score.arriving(spark, str(folder), SCHEMA, files_per_batch=per_batch), TYPES, [], "ts", delay)


def found(frame):
    return sorted((r.id, str(r.ts), r.v) for r in frame.collect())


def test_stream_equals_batch_after_restart(spark, tmp_path):
    source, sink, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    source.mkdir()
    drop(source, "a.csv", rows(0, 40))
    drop(source, "b.csv", rows(30, 60))
    first = clean_score.run(flow(spark, source), clean_score.write_batches(sink), progress)
    drop(source, "c.csv", rows(0, 80))
    second = clean_score.run(flow(spark, source), clean_score.write_batches(sink), progress)
    assert (first["rows"], second["rows"]) == (70, 80)
    batch = quality.clean(spark.read.option("header", True).schema(SCHEMA).csv(str(source)), TYPES, [])
    assert found(clean_score.read_sink(spark, sink)) == found(batch)
    assert clean_score.run(flow(spark, source), clean_score.write_batches(sink), progress)["rows"] == 0
    assert found(clean_score.read_sink(spark, sink)) == found(batch)


def test_a_batch_that_fails_after_writing_is_replaced(spark, tmp_path):
    source, sink, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    source.mkdir()
    drop(source, "a.csv", rows(0, 20))
    write = clean_score.write_batches(sink)

    def failing(batch, number):
        write(batch, number)
        raise RuntimeError("lost")
    with pytest.raises(Exception, match="lost"):
        clean_score.run(flow(spark, source), failing, progress)
    drop(source, "b.csv", rows(10, 30))
    clean_score.run(flow(spark, source), write, progress)
    batch = quality.clean(spark.read.option("header", True).schema(SCHEMA).csv(str(source)), TYPES, [])
    assert found(clean_score.read_sink(spark, sink)) == found(batch)


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    source, sink, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    source.mkdir()
    for name, part in (("a.csv", rows(1, 3, "2024-01-10")), ("b.csv", rows(3, 5, "2024-01-20")), ("c.csv", rows(5, 7, "2024-01-01"))):
        drop(source, name, part)
        clean_score.run(flow(spark, source, "2 days"), clean_score.write_batches(sink), progress)
    assert [r[0] for r in found(clean_score.read_sink(spark, sink))] == [1, 2, 3, 4]


def test_a_fitted_pipeline_scores_the_stream(spark, tmp_path):
    source, sink = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    drop(source, "a.csv", rows(1, 30))
    known = spark.range(20).select(F.col("id").cast("double").alias("v"), (F.col("id") * 2.0 + 1).alias("y"))
    model = models.fit(models.linear(["v"], "y"), known)
    clean_score.run(clean_score.scored(flow(spark, source), model).select("id", "ts", "v", "prediction"), clean_score.write_batches(sink), str(tmp_path / "state"))
    got = clean_score.read_sink(spark, sink).collect()
    assert len(got) == 25 and all(r.prediction == pytest.approx(2 * r.v + 1) for r in got)
