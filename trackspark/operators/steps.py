from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackspark.functions.geo import haversine_km
from trackspark.functions.timing import hours, micros
from trackspark.operators.buckets import bucketize
from trackspark.operators.previous import PREVIOUS, HotLimits, with_previous
from trackspark.schemas import STOP_BINS, STOP_NAMES, TRAJECTORY

POSITION = ("Latitude", "Longitude")
SPEED_MODES = ("hours_per_km", "km_per_hour")


def calculate_distance(df: DataFrame, group_columns: Sequence[str] = TRAJECTORY,
                       order_by: str = "StepTimestamp", tiebreak: Sequence[str] = POSITION,
                       limits: HotLimits | None = None) -> DataFrame:
    """Add ``PrevLongitude``, ``PrevLatitude`` and ``Distance`` in km to every step.

    The first step of a group has no predecessor and distance 0.
    """
    return _add_distance(with_previous(df, group_columns, order_by, POSITION, tiebreak, limits)).drop(PREVIOUS)


def step_measures(df: DataFrame, keys: Sequence[str] = TRAJECTORY, order_by: str = "StepTimestamp",
                  tiebreak: Sequence[str] = POSITION, limits: HotLimits | None = None) -> DataFrame:
    """``calculate_distance`` and the hours since the previous step, NULL on the first step."""
    carry = (*POSITION, order_by)
    return add_measures(with_previous(df, keys, order_by, carry, tiebreak, limits), order_by)


def _add_distance(df: DataFrame) -> DataFrame:
    lat, lon = F.col(PREVIOUS)["Latitude"], F.col(PREVIOUS)["Longitude"]
    km = haversine_km(lat, lon, F.col("Latitude"), F.col("Longitude"))
    return df.withColumns({"PrevLongitude": lon, "PrevLatitude": lat, "Distance": _zero_if_undefined(km)})


def _zero_if_undefined(x: Column) -> Column:
    # NULL, and NaN too: rounding near antipodes makes a distance NaN
    zero = F.lit(0.0)
    return F.coalesce(F.nanvl(x, zero), zero)


def add_measures(df: DataFrame, order_by: str) -> DataFrame:
    elapsed = micros(F.col(order_by)) - micros(F.col(PREVIOUS)[order_by])
    return _add_distance(df).withColumn("StepTimestampDiff", hours(elapsed / 1e6)).drop(PREVIOUS)


def classify_stops(df: DataFrame, speed_mode: str = "hours_per_km") -> DataFrame:
    """Add ``Speed`` and ``SpeedCat`` (``stop`` below 0.05, else ``not-stop``) to measured steps.

    ``hours_per_km`` is the ratio the original reports were computed with; ``km_per_hour`` is
    the rule they were documented with. Either is 0, a stop, where it is undefined.
    """
    if speed_mode not in SPEED_MODES:
        raise ValueError(f"speed_mode must be one of {SPEED_MODES}")
    elapsed, distance = F.col("StepTimestampDiff"), F.col("Distance")
    ratio = F.try_divide(elapsed, distance) if speed_mode == "hours_per_km" else F.try_divide(distance, elapsed)
    rated = df.withColumns({"Speed": _zero_if_undefined(ratio),
                            "StepTimestampDiff": F.coalesce("StepTimestampDiff", F.lit(0.0))})
    return bucketize(rated, STOP_BINS, STOP_NAMES, "Speed", "SpeedCat")
