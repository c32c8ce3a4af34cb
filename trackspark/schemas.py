"""Fixed schemas and names of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Transport modes in order; the label of a mode is its position, from 1.
MODES = [
    "walk", "bike", "bus", "car", "subway", "train", "airplane", "boat", "run", "motorcycle", "taxi",
]
UNKNOWN_LABEL = 0

# Lines before the first fix in a track file, and the text formats of times.
TRACK_HEADER_LINES = 6
TRACK_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
LABEL_TIME_FORMAT = "yyyy/MM/dd HH:mm:ss"

TRAJECTORY = ("UserId", "TrajectoryID")
#: Time slice of a step, a column of bucketed tables
SLICE = "Slice"

STEP_SCHEMA = T.StructType([
    T.StructField("IngestionTime", T.TimestampType(), False),
    T.StructField("UserId", T.StringType(), False),
    T.StructField("TrajectoryID", T.StringType(), False),
    T.StructField("Latitude", T.DoubleType()),
    T.StructField("Longitude", T.DoubleType()),
    T.StructField("Altitude", T.DoubleType()),
    T.StructField("StepTimestamp", T.TimestampType()),
])

LABEL_FILE_SCHEMA = T.StructType([
    T.StructField("StartTime", T.TimestampType()),
    T.StructField("EndTime", T.TimestampType()),
    T.StructField("Mode", T.StringType()),
])

# Bucket limits and names of the reports.
LENGTH_BINS = [0.0, 5.0, 20.0, 100.0, float("inf")]
LENGTH_NAMES = ["<5", "5-20", "20-100", ">=100"]
TIME_BINS = [float("-inf"), 1.0, 6.0, 12.0, float("inf")]
TIME_NAMES = ["<1", "1-6", "6-12", ">=12"]
STOP_BINS = [float("-inf"), 0.05, float("inf")]
STOP_NAMES = ["stop", "not-stop"]
