from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: What opening a file costs, as bytes that are read in the same time
SMALL_FILE_COST = 16 << 10
_LISTING_CACHE = "spark.sql.hive.filesourcePartitionFileCacheSize"
_OPEN_COST, _SPARKS_OPEN_COST = "spark.sql.files.openCostInBytes", "4194304b"


def build_session(app_name: str = "trackspark", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the one setting results depend on (UTC) and adaptive execution on.

    Cluster sizes, shuffle partitions and memory are left to the cluster or to ``conf``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, str(value))
    spark = builder.getOrCreate()
    size_file_listing(spark)
    return spark


def size_file_listing(spark: SparkSession) -> None:
    """List many paths in a few tasks per core, and read many small files in one task.

    Spark's defaults are a task per path, up to 10 000, and 4 MB as the cost of opening a file, which makes a task of
    every 32 small files. A cost that was set by others is left alone.
    """
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", 4 * spark.sparkContext.defaultParallelism)
    if spark.conf.get(_OPEN_COST) == _SPARKS_OPEN_COST:
        spark.conf.set(_OPEN_COST, SMALL_FILE_COST)


@contextmanager
def listing_not_cached(spark: SparkSession) -> Iterator[None]:
    """Keep what is listed now with the source alone: Spark's cache of listings holds up to 250 MB of the driver's memory."""
    before = spark.conf.get(_LISTING_CACHE)
    spark.conf.set(_LISTING_CACHE, "0")
    try:
        yield
    finally:
        spark.conf.set(_LISTING_CACHE, before)


def _in_one_process(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master, where driver and executors are one process, may fall back to a
    temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not _in_one_process(spark):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="trackspark-"))
    return spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
