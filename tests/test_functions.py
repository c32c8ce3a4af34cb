from __future__ import annotations

import math
from datetime import datetime

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trackspark.functions import haversine_km, hours, micros, percent_label, whole_seconds


def km(lat0, lon0, lat1, lon1):
    p0, p1 = math.radians(lat0), math.radians(lat1)
    h = (math.sin(math.radians(lat1 - lat0) / 2) ** 2
         + math.cos(p0) * math.cos(p1) * math.sin(math.radians(lon1 - lon0) / 2) ** 2)
    return 12742 * math.asin(math.sqrt(min(1.0, h)))


points = st.tuples(st.floats(-89, 89), st.floats(-180, 180), st.floats(-89, 89), st.floats(-180, 180))


@settings(max_examples=3, deadline=None)
@given(st.lists(points, min_size=20, max_size=60))
def test_haversine_against_another_formula(spark, rows):
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = df.select("*", haversine_km(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("km")).collect()
    for r in got:
        assert math.isclose(r.km, km(r.a, r.b, r.c, r.d), rel_tol=1e-6, abs_tol=1e-3)


def test_haversine_same_point_is_zero(spark):
    df = spark.range(1).select(haversine_km(*[F.lit(x) for x in (39.9, 116.3, 39.9, 116.3)]).alias("km"))
    assert df.first().km == 0.0


def test_times_of_both_timestamp_types(spark):
    df = spark.createDataFrame([(datetime(1970, 1, 1, 1, 0, 0, 999999),)], "t timestamp").select(
        "t", F.col("t").cast("timestamp_ntz").alias("n"))
    for c in ("t", "n"):
        r = df.select(micros(F.col(c)).alias("us"), whole_seconds(F.col(c)).alias("s")).first()
        assert (r.us, r.s) == (3_600_999_999, 3600)
    assert spark.range(1).select(hours(F.lit(5400)).alias("h")).first().h == 1.5


def test_whole_seconds_floor_before_the_epoch(spark):
    df = spark.sql("select timestamp'1969-12-31 23:59:59.5' t").select(whole_seconds(F.col("t")).alias("s"))
    assert df.first().s == -1


def test_percent_label_rounds_half_up_in_integers(spark):
    cases = [(1, 3, "33.3%"), (2, 3, "66.7%"), (953, 2000, "47.7%"), (0, 7, "0.0%"), (7, 7, "100.0%"),
             (10**12, 3 * 10**12, "33.3%")]
    df = spark.createDataFrame([c[:2] for c in cases], "n bigint, t bigint")
    got = df.select(percent_label(F.col("n"), F.col("t")).alias("p")).collect()
    assert [r.p for r in got] == [c[2] for c in cases]
