"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from tests.check import differences, oracle_connection

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    if name in ORACLES:
        assert differences(df, con, ORACLES[name]) == []
    else:
        assert len(df.collect()) > 0


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["sector", "season", "mean_value"] and df.count() == 20
