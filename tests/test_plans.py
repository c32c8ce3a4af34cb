"""The physical plans that make the reports scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from trackspark.operators import HotLimits, attach_labels, step_measures
from trackspark.plans import analyses
from trackspark.sources import read_tracks


def plan(df, final: bool = False) -> str:
    if final:
        df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0] if final else text


def exchanges(text: str) -> list[str]:
    return re.findall(r"Exchange \w+\(?[^\n]*", text)


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "geo_table.parquet")
    (spark.range(2000).select(
        F.current_timestamp().alias("IngestionTime"), (F.col("id") % 5).cast("string").alias("UserId"),
        (F.col("id") % 50).cast("string").alias("TrajectoryID"), (F.col("id") / 100).alias("Latitude"),
        F.lit(116.0).alias("Longitude"), F.lit(1.0).alias("Altitude"),
        F.timestamp_seconds(F.col("id") * 60).alias("StepTimestamp"), F.lit(0).alias("Label"))
     .write.parquet(path))
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def intervals(spark, table):
    return table.select("UserId", F.col("StepTimestamp").alias("StartTime"),
                        (F.col("StepTimestamp") + F.expr("interval 5 minutes")).alias("EndTime"), F.lit(3).alias("Label"))


REPORTS = {
    "length": analyses.trajectory_length,
    "net": analyses.trajectory_net_hours,
    "summary": analyses.trajectory_summary,
}


@pytest.mark.parametrize("name", REPORTS)
def test_one_shuffle_one_sort_per_trajectory_report(table, name):
    text = plan(REPORTS[name](table))
    assert len(exchanges(text)) == 1 and "hashpartitioning(UserId" in text
    assert len(re.findall(r"\bSort \[", text)) == 1
    assert len(re.findall(r"\bWindow \[", text)) == 1
    assert "Python" not in text and "Altitude" not in text and "IngestionTime" not in text


def test_gross_report_combines_before_its_only_shuffle(table):
    text = plan(analyses.trajectory_gross_hours(table))
    assert len(exchanges(text)) == 1
    assert "partial_max" in text and "partial_min" in text
    assert "ReadSchema: struct<UserId:string,TrajectoryID:string,StepTimestamp:timestamp>" in text


@pytest.mark.parametrize("name", REPORTS)
def test_large_input_without_hot_trajectory_gets_the_plain_plan(table, name):
    text = plan(REPORTS[name](table, limits=HotLimits(rows=1000)), final=True)
    assert "_slice" not in text
    assert len(re.findall(r"\bWindow \[", text)) == 1


def test_hot_trajectories_shuffle_by_slice_and_broadcast_only_bounded_tables(table):
    limits = HotLimits(rows=10)
    text = plan(step_measures(table, limits=limits))
    assert "_slice" in text
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert any("_slice" in e for e in exchanges(text))


def test_key_filter_reaches_the_scan_and_time_filter_does_not(table):
    measured = step_measures(table)
    assert "EqualTo(UserId,3)" in plan(measured.where("UserId = '3'"))
    late = plan(measured.where("StepTimestamp > timestamp'1970-01-02 00:00:00'"))
    assert "GreaterThan(StepTimestamp" not in late


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_label_join_is_an_equi_join(spark, table, intervals, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        text = plan(attach_labels(table, intervals))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "NestedLoop" not in text and "Cartesian" not in text and "Python" not in text
    if threshold == "-1":
        assert re.search(r"hashpartitioning\(UserId#\d+, _bin#\d+L", text)


def test_track_scan_prunes_files_by_size(spark, tree):
    df = read_tracks(spark, str(tree), whole_file_bytes=1 << 20)
    assert df.rdd.getNumPartitions() <= 2  # the two small files; the scan by lines has none
    assert "file_size" in plan(df)
