"""Clean and score arriving files as the batch chain does: typed, without repeated rows, complete, scored.

A run handles all files that have arrived since the last one and stops; its progress is in the checkpoint folder. Repeated
rows are found within the watermark's delay, so the state holds the keys of that span alone. The sink writes each
micro-batch to a folder of its own that a repeated attempt replaces, so a failure at any point leaves every row once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from panelspark.operators.quality import typed

Step = Callable[[DataFrame], DataFrame]


def arriving(spark: SparkSession, path: str, schema: str, form: str = "csv", files_per_batch: int = 1000, **options: str) -> DataFrame:
    """Files of a folder as a stream, the oldest first."""
    reader = spark.readStream.format(form).schema(schema).option("maxFilesPerTrigger", files_per_batch)
    for name, value in ({"header": "true"} if form == "csv" else {} | options).items():
        reader = reader.option(name, value)
    return reader.load(path)


def clean(rows: DataFrame, types: dict[str, str], dates: list[str], time: str, delay: str) -> DataFrame:
    """Cast, parse dates, drop rows with a null and rows that were seen before.

    ``time`` (a timestamp once cast) drives the watermark: a row that arrives more than ``delay`` behind the latest time is
    dropped, and its equals within that span are one. On a table that is not a stream the watermark has no effect, and the
    result is the batch chain's.
    """
    whole = typed(rows, types, dates).dropna()
    return whole.withWatermark(time, delay).dropDuplicates(whole.columns)


def scored(rows: DataFrame, model: PipelineModel | Step) -> DataFrame:
    """Rows with a prediction, by a fitted pipeline or by any function of a DataFrame."""
    return model.transform(rows) if isinstance(model, PipelineModel) else model(rows)


def write_batches(path: str) -> Callable[[DataFrame, int], None]:
    """Sink for ``foreachBatch``: batch n is the folder ``batch=n``, replaced as a whole when the batch is repeated."""
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")
    return write


def run(rows: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> dict[str, int]:
    """Handle what has arrived, then stop; returns the batches and rows read in this run.

    A failed run raises; the next run repeats its last batch. One checkpoint folder serves one stream.
    """
    query = (rows.writeStream.foreachBatch(sink).outputMode("append").option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    try:
        query.awaitTermination()
    finally:
        query.stop()
    return {"batches": len(query.recentProgress), "rows": sum(p.numInputRows for p in query.recentProgress)}


def read_sink(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """All rows that the sink holds."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path).drop("batch")
