"""What the operators share: tables written down, numbers from the session, running totals."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackspark.session import fresh_path

#: Rows of an Arrow batch are worked on in runs of at most so many bytes of text (or one row).
RUN_BYTES = 1 << 20
#: Arrow batches between the JVM and Python hold at most so many bytes (or one row).
BATCH_BYTES = 8 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's limit of Arrow batches to ``BATCH_BYTES``; a lower one stays."""
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)i?b?", spark.conf.get(_BATCH_SETTING).strip().lower()).groups()
    if int(number) << 10 * " kmgtp".index(unit or " ") > BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Let shuffle files go with the query that made them; else they stay until the driver happens to collect its garbage."""
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(_DROP_SHUFFLES) if before is None else spark.conf.set(_DROP_SHUFFLES, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, whatever uses it."""
    bound_batches(df.sparkSession)
    path = fresh_path(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def give_back() -> None:
    """Return what a Python worker has freed: it outlives its tasks, and its heap else stays as large as it ever was."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc; arrays and tokenizers are on its heap
    if trim:
        trim(0)


def runs(batch: pa.RecordBatch, column: str, limit: int = RUN_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch holding at most ``limit`` bytes in ``column``, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if total + size > limit and i > start:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield batch.slice(start)
    give_back()


def running_total(df: DataFrame, order: Sequence[str], value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all rows up to this one in the order of ``order``.

    Range partitions are summed where they are; the driver sees one sum per partition. ``order``
    has to be total for the result to be fixed.
    """
    spark = df.sparkSession
    placed = stored(df.repartitionByRange(tasks(spark), *order).withColumn("_part", F.spark_partition_id()), "ranges")
    sums = placed.groupBy("_part").agg(F.sum(value).alias("s")).orderBy("_part").collect()
    before, total = [], 0
    for row in sums:
        before.append((row["_part"], total))
        total += row["s"] or 0
    if not before:
        return placed.drop("_part").withColumn(out, F.lit(0).cast("long"))
    starts = spark.createDataFrame(before, "_part int, _before long")
    within = F.sum(value).over(Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return (placed.withColumn("_within", within)
            .join(F.broadcast(starts), "_part")  # one row per partition
            .withColumn(out, F.col("_before") + F.col("_within"))
            .drop("_part", "_within", "_before"))
