"""The reports over trajectories, DataFrame to DataFrame.

Reports are lazy: they merge segments of trajectories, see ``operators.segments``. Measures with a row for each step,
and reports called with ``limits``, count the steps per trajectory when they are called, see ``operators.previous``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackspark.functions.text import percent_label
from trackspark.functions.timing import hours, whole_seconds
from trackspark.operators.buckets import bucketize, distribution
from trackspark.operators.previous import HotLimits
from trackspark.operators.segments import merge_segments, segment_measures, trajectory_segments
from trackspark.operators.steps import classify_stops, step_measures
from trackspark.schemas import LENGTH_BINS, LENGTH_NAMES, TIME_BINS, TIME_NAMES, TRAJECTORY

_MEASURED = (*TRAJECTORY, "Latitude", "Longitude", "StepTimestamp")


def trajectory_length(steps: DataFrame, limits: HotLimits | None = None) -> DataFrame:
    """Kilometres per trajectory as ``TotalDistance``."""
    measured = step_measures(steps.select(*_MEASURED), limits=limits)
    return measured.groupBy(*TRAJECTORY).agg(F.sum("Distance").alias("TotalDistance"))


def trajectory_gross_hours(steps: DataFrame) -> DataFrame:
    """Hours from first to last step per trajectory as ``TimeDiffHours``.

    Minimum and maximum combine before the shuffle, so trajectories of any size are fine.
    """
    return steps.groupBy(*TRAJECTORY).agg(_gross_hours().alias("TimeDiffHours"))


def _gross_hours() -> Column:
    return hours(whole_seconds(F.max("StepTimestamp")) - whole_seconds(F.min("StepTimestamp")))


def trajectory_net_hours(steps: DataFrame, speed_mode: str = "hours_per_km",
                         limits: HotLimits | None = None) -> DataFrame:
    """Hours spent on steps that are not stops, per trajectory that has such steps."""
    measured = step_measures(steps.select(*_MEASURED), limits=limits)
    return (classify_stops(measured, speed_mode).where(F.col("SpeedCat") == "not-stop")
            .groupBy(*TRAJECTORY).agg(F.sum("StepTimestampDiff").alias("StepTimestampDiff")))


def trajectory_summary(steps: DataFrame, speed_mode: str = "hours_per_km",
                       limits: HotLimits | None = None) -> DataFrame:
    """All three measures per trajectory from one pass over the steps.

    ``StepTimestampDiff`` is NULL for a trajectory that only has stops.
    """
    moving = F.when(F.col("SpeedCat") == "not-stop", F.col("StepTimestampDiff"))
    measured = step_measures(steps.select(*_MEASURED), limits=limits)
    return classify_stops(measured, speed_mode).groupBy(*TRAJECTORY).agg(
        F.sum("Distance").alias("TotalDistance"),
        _gross_hours().alias("TimeDiffHours"),
        F.sum(moving).alias("StepTimestampDiff"))


def stop_share(steps: DataFrame, speed_mode: str = "hours_per_km", limits: HotLimits | None = None) -> DataFrame:
    """Steps per stop category."""
    measured = step_measures(steps.select(*_MEASURED), limits=limits)
    return distribution(classify_stops(measured, speed_mode), "SpeedCat", "StepDistribution")


def trajectory_totals(steps: DataFrame, speed_mode: str = "hours_per_km") -> DataFrame:
    """``trajectory_summary`` from merged segments: one scan, and no task holds a whole trajectory's steps."""
    return segment_measures(merge_segments(trajectory_segments(steps, speed_mode), speed_mode))


def length_distribution(steps: DataFrame, limits: HotLimits | None = None) -> DataFrame:
    return length_report(trajectory_length(steps, limits) if limits else trajectory_totals(steps))


def gross_time_distribution(steps: DataFrame) -> DataFrame:
    return gross_time_report(trajectory_gross_hours(steps))


def net_time_distribution(steps: DataFrame, speed_mode: str = "hours_per_km",
                          limits: HotLimits | None = None) -> DataFrame:
    if limits:
        return net_time_report(trajectory_net_hours(steps, speed_mode, limits))
    return net_time_report(trajectory_totals(steps, speed_mode).where(F.col("StepTimestampDiff").isNotNull()))


def length_report(lengths: DataFrame) -> DataFrame:
    named = bucketize(lengths, LENGTH_BINS, LENGTH_NAMES, "TotalDistance", "DistCat")
    return distribution(named, "DistCat", "TotalDistanceDistribution")


def gross_time_report(durations: DataFrame) -> DataFrame:
    named = bucketize(durations, TIME_BINS, TIME_NAMES, "TimeDiffHours", "TimeCat")
    return distribution(named, "TimeCat", "TimeGrossDistribution")


def net_time_report(durations: DataFrame) -> DataFrame:
    named = bucketize(durations, TIME_BINS, TIME_NAMES, "StepTimestampDiff", "TimeCat")
    return distribution(named, "TimeCat", "TimeNetDistribution")


def joint_counts(summary: DataFrame) -> DataFrame:
    """Trajectories per combination of the three buckets: a table of at most 125 rows."""
    named = bucketize(summary, LENGTH_BINS, LENGTH_NAMES, "TotalDistance", "DistCat")
    named = bucketize(named, TIME_BINS, TIME_NAMES, "TimeDiffHours", "GrossCat")
    named = bucketize(named, TIME_BINS, TIME_NAMES, "StepTimestampDiff", "NetCat")
    return named.groupBy("DistCat", "GrossCat", "NetCat").agg(F.count("*").alias("Trajectories"))


def reports_from_joint_counts(counts: DataFrame) -> dict[str, DataFrame]:
    gross = counts.withColumnRenamed("GrossCat", "TimeCat")
    # trajectories without a moving step have no net time and are not part of that report
    net = counts.withColumnRenamed("NetCat", "TimeCat").where(F.col("TimeCat").isNotNull())
    return {
        "length": distribution(counts, "DistCat", "TotalDistanceDistribution", "Trajectories"),
        "time_gross": distribution(gross, "TimeCat", "TimeGrossDistribution", "Trajectories"),
        "time_net": distribution(net, "TimeCat", "TimeNetDistribution", "Trajectories"),
    }


def chart_table(dist: DataFrame, cat_col: str, count_col: str) -> DataFrame:
    """What a pie chart of a distribution shows: slice name, share of the circle, percent text."""
    total = F.sum(count_col).over(Window.partitionBy())
    return dist.select(
        F.col(cat_col).alias("Slice"),
        (F.col(count_col) / total).alias("Share"),
        percent_label(F.col(count_col), total).alias("PercentLabel"),
    )
