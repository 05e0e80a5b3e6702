"""Partitioned and bucketed sinks, quarantine, observed audits and the lasting dictionary."""

from __future__ import annotations

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from panelspark.catalog import storage
from panelspark.operators import audit, dictionary, quality
from panelspark.sources import readers, writers


def test_periods_are_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "p")
    one = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("b", 1, 30)], "k string, day int, v int")
    writers.write_periods(one, path, ["day"])
    again = spark.createDataFrame([("c", 2, 5)], "k string, day int, v int")
    for _ in range(2):
        writers.write_periods(again, path, ["day"])
    back = spark.read.parquet(path)
    assert sorted(map(tuple, back.select("k", "day", "v").collect())) == [("a", 1, 10), ("b", 1, 30), ("c", 2, 5)]
    assert "PartitionFilters: [isnotnull(day" in back.where("day = 2")._jdf.queryExecution().toString()


def test_a_bucketed_join_moves_nothing(spark):
    joined = storage.bucketed_join(spark, "/root/testdata/sf0.001")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    with pytest.raises(AnalysisException):
        writers.write_bucketed(spark.range(1), joined.sparkSession.catalog.listTables()[0].name, ["id"], 2, "/tmp/unused")


LINES = ['id,day,price,name', '1,2024-01-01,1.5,"a, ""b"""', '2,2024-02-30,1.5,x', 'x,2024-01-01,1.5,x', '4,2024-01-01,1.5', '5,2024-01-01,1.5,x,y',
         '6,,,', '7,2024-01-01,abc,x', '8,2024-01-01,2.5,', '9,2024-01-01,3.5,"p,q",z', '1,2024-01-01,1.5,"a, ""b"""']


def test_quarantine(spark, tmp_path):
    (tmp_path / "in.csv").write_text("\n".join(LINES) + "\n")
    got = readers.read_csv_checked(spark, str(tmp_path / "in.csv"), "id long, day date, price double, name string", str(tmp_path / "bad"))
    assert sorted(r.id for r in got.good.collect()) == [1, 1, 6, 8]
    assert {r.line.split(",")[0]: r.reason for r in got.bad.collect()} == {
        "2": "day", "x": "id", "4": "columns", "5": "columns", "7": "price", "9": "columns"}
    assert sum(r.row_count for r in got.counts.collect()) == len(LINES) - 1
    assert spark.read.json(str(tmp_path / "bad")).count() == 6


def test_quarantine_of_an_empty_file(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id,day\n")
    got = readers.read_csv_checked(spark, str(tmp_path / "in.csv"), "id long, day date")
    assert got.good.collect() == [] and [tuple(r) for r in got.counts.collect()] == [("good", 0)]


def test_audit_counts_in_one_job(spark, tmp_path):
    d = spark.createDataFrame([("1", "2024-01-01"), ("1", "2024-01-01"), ("x", "2024-01-02"), ("2", None)], "a string, day string")
    out = quality.clean_to(d, {"a": "int"}, ["day"], str(tmp_path / "c"))
    assert [(r.stage, r.row_count, r.missing) for r in out.orderBy("step").collect()] == [
        ("loaded", 4, {}), ("deduplicated", 3, {"a": 1, "day": 1}), ("complete", 1, {})]
    assert spark.read.parquet(str(tmp_path / "c")).count() == 1
    trail, tracker = audit.Trail(), spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("audit", "")
    trail.watch(trail.watch(d, "all").where("a = '1'"), "ones", ["day"]).write.format("noop").mode("overwrite").save()
    assert [r[2] for r in trail.rows()] == [4, 2] and len(tracker.getJobIdsForGroup("audit")) == 1
    spark.sparkContext.setJobGroup("default", "")


def test_audit_of_an_empty_table(spark, tmp_path):
    d = spark.createDataFrame([], "a string, day string")
    out = quality.clean_to(d, {"a": "int"}, ["day"], str(tmp_path / "c"))
    assert [r.row_count for r in out.collect()] == [0, 0, 0]


def test_dictionary(spark, tmp_path):
    path = str(tmp_path / "d")

    def labels(*values):
        return spark.createDataFrame([(v,) for v in values], "v string")
    assert dictionary.versions(spark, path) == []
    assert dictionary.update(labels("m", "b", None, "m"), "v", path) == 1
    assert dictionary.update(labels("b"), "v", path) == 1
    assert dictionary.update(labels("a", "z", "b", "ä"), "v", path) == 2
    assert {r.value: (r.code, r.since) for r in dictionary.read(spark, path).collect()} == {
        "b": (0, 1), "m": (1, 1), "a": (2, 2), "z": (3, 2), "ä": (4, 2)}
    d = labels("a", "b", None)
    assert [r.v_enc for r in dictionary.encode(d, "v", path).orderBy(F.col("v").asc_nulls_last()).collect()] == [2, 0, -1]
    for policy, code in (("minus_one", -1), ("zero", 0), ("null", None)):
        got = {r.v: r.v_enc for r in dictionary.encode(d, "v", path, 1, on_unknown=policy).collect()}
        assert got == {"a": code, "b": 0, None: -1}
    with pytest.raises(Exception, match="label not in the dictionary: a"):
        dictionary.encode(d, "v", path, 1).collect()
    with pytest.raises(ValueError):
        dictionary.encode(d, "v", path, 7)
    with pytest.raises(ValueError):
        dictionary.encode(d, "v", path, on_unknown="guess")
    os.makedirs(f"{path}/version=3")  # another writer was faster
    with pytest.raises(AnalysisException):
        dictionary.update(labels("new"), "v", path)


def test_dictionary_without_labels(spark, tmp_path):
    path = str(tmp_path / "d")
    none = spark.createDataFrame([(None,)], "v string")
    assert dictionary.update(none, "v", path) == 1
    assert [r.v_enc for r in dictionary.encode(none, "v", path).collect()] == [-1]
    assert dictionary.update(spark.createDataFrame([("x",)], "v string"), "v", path) == 2
