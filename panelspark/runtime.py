"""Session-level helpers: shared folders, materialised side tables and joins to them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rsplit("/", 1)[0]
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.mkdtemp(prefix="panelspark-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/panelspark/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "side") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage, survives executor loss, computes ``df`` once (a reliable checkpoint runs its
    lineage twice) and gives the planner true sizes.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def attach(df: DataFrame, side: DataFrame, on: list[str], how: str = "left", stored: bool = False) -> DataFrame:
    """Join a fact table to a derived side table with few rows per key.

    ``side`` is materialised, unless it is ``stored`` already, so that the planner knows its bytes and
    broadcasts it or not; where both sides shuffle, adaptive execution splits hot keys.
    """
    return df.join(side if stored else materialize(side), on, how)
