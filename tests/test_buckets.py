from __future__ import annotations

import pytest
from pyspark.errors import PySparkException

from trackspark.operators import bucketize, distribution
from trackspark.plans.analyses import chart_table
from trackspark.schemas import LENGTH_BINS, LENGTH_NAMES, TIME_BINS, TIME_NAMES


def test_length_bucket_edges(spark):
    cases = [(0.0, "<5"), (4.999, "<5"), (5.0, "5-20"), (20.0, "20-100"), (100.0, ">=100"), (float("inf"), ">=100"),
             (None, None), (float("nan"), None), (-1.0, None)]
    df = spark.createDataFrame([c[:1] for c in cases], "v double")
    got = bucketize(df, LENGTH_BINS, LENGTH_NAMES, "v", "b").collect()
    assert [r.b for r in got] == [c[1] for c in cases]


def test_last_bucket_is_closed(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.1,)], "v double")
    assert [r.b for r in bucketize(df, [0, 1, 2], ["a", "b"], "v", "b").collect()] == ["b", "b", None]


def test_time_buckets_take_negative_values(spark):
    df = spark.createDataFrame([(float("-inf"),), (-3.0,), (1.0,), (6.0,), (12.0,)], "v double")
    got = [r.b for r in bucketize(df, TIME_BINS, TIME_NAMES, "v", "b").collect()]
    assert got == ["<1", "<1", "1-6", "6-12", ">=12"]


@pytest.mark.parametrize("value", [None, float("nan"), -1.0])
def test_strict_refuses_values_without_bucket(spark, value):
    df = spark.createDataFrame([(value,)], "v double")
    with pytest.raises(PySparkException, match="v has no bucket"):
        bucketize(df, LENGTH_BINS, LENGTH_NAMES, "v", "b", strict=True).collect()


def test_bad_bins_are_refused(spark):
    df = spark.range(1)
    for bins, names in (([0, 1], ["a", "b"]), ([1, 0], ["a"]), ([0, 0], ["a"])):
        with pytest.raises(ValueError):
            bucketize(df, bins, names, "id", "b")


def test_distribution_and_chart(spark):
    df = spark.createDataFrame([("x",)] * 3 + [("y",)], "c string")
    dist = distribution(df, "c", "n")
    assert dist.schema.simpleString() == "struct<c:string,n:bigint,percentage:double>"
    assert {tuple(r) for r in dist.collect()} == {("x", 3, 75.0), ("y", 1, 25.0)}
    chart = chart_table(dist, "c", "n").collect()
    assert {tuple(r) for r in chart} == {("x", 0.75, "75.0%"), ("y", 0.25, "25.0%")}
