from __future__ import annotations

import pytest
from pyspark.sql import SparkSession


def build_session() -> SparkSession:
    spark = (SparkSession.builder.master("local[8]").appName("panelspark-tests")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "8g")
             .config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    return build_session()
