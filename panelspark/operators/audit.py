"""Counts of the stages of a plan, observed while its result is written: no stage is scanned again."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from panelspark.operators.summary import _is_missing


class Trail:
    """Stages watched on the way to one write.

    ``watch`` marks a stage of the plan; after the plan has run, once and in whole, ``table`` gives the counts. Asking before
    that is an error. A stage may be watched with the missing values of some columns.
    """

    def __init__(self) -> None:
        self._stages: list[tuple[str, int, list[str], Observation]] = []

    def watch(self, df: DataFrame, stage: str, missing: list[str] | None = None) -> DataFrame:
        seen, missing = Observation(), missing or []
        self._stages.append((stage, len(df.columns), missing, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(_is_missing(df, c)).alias(f"missing_{i}") for i, c in enumerate(missing)])

    @staticmethod
    def _counts(seen: Observation) -> dict[str, int]:
        try:
            return seen.get
        except Py4JJavaError as e:  # the planner saw an empty input and left the stage out
            if "assertion failed" not in str(e.java_exception):
                raise
            return {}

    def rows(self) -> list[tuple[int, str, int, int, dict[str, int]]]:
        out = []
        for i, (stage, width, missing, seen) in enumerate(self._stages):
            n = self._counts(seen)
            out.append((i, stage, int(n.get("rows", 0)), width, {c: int(n.get(f"missing_{k}", 0)) for k, c in enumerate(missing)}))
        return out

    def table(self, spark: SparkSession) -> DataFrame:
        """step, stage, row_count, column_count, missing (values by column; empty where none were asked for)."""
        return spark.createDataFrame(self.rows(), "step int, stage string, row_count long, column_count int, missing map<string,long>")
