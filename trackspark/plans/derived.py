"""Steps, labels and raw files derived from a table of user events.

The test tables hold no tracks; these views turn ``events`` into them row by row, so that every
report has input that grows with the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackspark.schemas import LABEL_TIME_FORMAT, MODES, TRACK_HEADER_LINES, TRACK_TIME_FORMAT
from trackspark.sources.paths import under

HEADER = "\r\n".join(f"header line {i}" for i in range(1, TRACK_HEADER_LINES + 1))
LABEL_HEADER = "Start Time\tEnd Time\tTransportation Mode"


def steps_from_events(events: DataFrame) -> DataFrame:
    """A step per event; the events of a user on one day are a trajectory."""
    return events.selectExpr(
        "cast(user_id as string) as UserId",
        "date_format(ts, 'yyyyMMdd') as TrajectoryID",
        "39 + value / 1000 as Latitude",
        "116 + (event_id % 100) / 100 as Longitude",
        "value as Altitude",
        "cast(ts as timestamp) as StepTimestamp",
        "event_id",
    )


def raw_labels_from_events(events: DataFrame) -> DataFrame:
    """A six-hour interval per event, its mode text being one of all known, one unknown and a number."""
    modes = F.array(*[F.lit(m) for m in [*MODES, "hover", "7"]])
    start = F.col("ts").cast("timestamp")
    return events.select(
        F.col("user_id").cast("string").alias("UserId"),
        start.alias("StartTime"),
        (start + F.expr("interval 6 hours")).alias("EndTime"),
        F.get(modes, (F.col("event_id") % 13).cast("int")).alias("Mode"),
    )


def track_texts(steps: DataFrame, root: str = "/tracks") -> DataFrame:
    """A small file per step, as ``value, path``: header and one line."""
    path = F.concat_ws("/", F.lit(root), F.lit("Data"), "UserId", F.lit("Trajectory"),
                       F.concat("TrajectoryID", F.lit(".plt")))
    return steps.select(F.concat_ws("\r\n", F.lit(HEADER), _track_line(), F.lit("")).alias("value"), path.alias("path"))


def _track_line():
    number = [F.col(c).cast("string") for c in ("Latitude", "Longitude", "Altitude")]
    ts = F.col("StepTimestamp")
    date_format, time_format = TRACK_TIME_FORMAT.split(" ")
    return F.concat_ws(",", number[0], number[1], F.lit("0"), number[2], F.lit("0"),
                       F.date_format(ts, date_format), F.date_format(ts, time_format))


def write_raw_files(steps: DataFrame, raw_labels: DataFrame, root: str) -> None:
    """Write the directory tree the readers expect: a file per trajectory and one per labelled user.

    ``root`` has to be a folder that all executors reach. Tasks stream the lines of a file in
    order; a task that is tried again writes the same file again.
    """
    track = F.concat_ws("/", F.lit("Data"), "UserId", F.lit("Trajectory"), F.concat("TrajectoryID", F.lit(".plt")))
    tracks = steps.select(track.alias("file"), F.col("StepTimestamp").alias("at"), _track_line().alias("line"))
    label = F.concat_ws("\t", F.date_format("StartTime", LABEL_TIME_FORMAT),
                        F.date_format("EndTime", LABEL_TIME_FORMAT), "Mode")
    labels = raw_labels.select(F.concat_ws("/", F.lit("Data"), "UserId", F.lit("labels.txt")).alias("file"),
                               F.col("StartTime").alias("at"), label.alias("line"))
    for lines, header in ((tracks, HEADER), (labels, LABEL_HEADER)):
        _write_files(lines, header, root)


def _write_files(lines: DataFrame, header: str, root: str) -> None:
    uri = _qualified(lines.sparkSession, root)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = fs.FileSystem.from_uri(uri)
        current, folder, out = None, None, None
        for batch in batches:
            for name, rows in groupby(zip(batch.column("file").to_pylist(), batch.column("line").to_pylist()), itemgetter(0)):
                text = "".join([f"{line}\r\n" for _, line in rows])
                if name != current:
                    if out:
                        out.close()
                    current, path = name, under(base, name)
                    if folder != (folder := path.rsplit("/", 1)[0]):
                        filesystem.create_dir(folder, recursive=True)
                    out = filesystem.open_output_stream(path)
                    text = f"{header}\r\n{text}"
                out.write(text.encode())
        if out:
            out.close()
        yield pa.RecordBatch.from_pydict({"done": [1]})

    # by range, so that a folder's files are one task's or a few tasks' and follow one another there
    placed = lines.repartitionByRange("file").sortWithinPartitions("file", "at").select("file", "line")
    placed.mapInArrow(write, "done bigint").agg(F.count("*")).collect()


def _qualified(spark: SparkSession, path: str) -> str:
    """A path as Spark understands it, in the form the file systems of Arrow take."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop).toString()
    return "/" + full.removeprefix("file:").lstrip("/") if full.startswith("file:") else full
