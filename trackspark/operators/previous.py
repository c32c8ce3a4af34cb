"""The previous row of a group, also when one group holds a large part of all rows.

``lag`` over a window partitioned by the group keys puts a whole group into one task. That is
the best plan while every group fits a task. Groups of more rows than that are found by a
map-side combined count, whatever the size of the input, and are taken apart:

* their rows are range-partitioned on (group, order), so a group of any size becomes slices of
  about equal row counts. The order ends with a number of its own for every row, so rows at one
  time, without a time or equal in everything are cut like any others;
* the slices are written down, because the bounds come from a sample and rows must be cut the
  same way wherever they are used;
* the window runs per (group, slice), and the first row of a slice takes its predecessor from
  the last row of the slice before, through a table with one row per slice.

All other groups keep the plain window. Nothing is dropped or approximated: the sample only
decides where to cut.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackspark.session import fresh_path

PREVIOUS = "_previous"
_SLICE = "_slice"
_TIE = "_tie"


@dataclass(frozen=True)
class HotLimits:
    """When a group is taken apart: ``rows`` is the most rows that stay together."""

    rows: int = 4_000_000


def with_previous(df: DataFrame, keys: Sequence[str], order_by: str, carry: Sequence[str],
                  tiebreak: Sequence[str] = (), limits: HotLimits | None = None) -> DataFrame:
    """Attach to every row the ``carry`` columns of its predecessor in its group as ``PREVIOUS``.

    The first row of a group has NULL. Rows without ``order_by`` come first, equal ones are
    ordered by ``tiebreak``. The count that finds hot groups runs when this is called, and if
    there are any their slices are written to the shared folder; the rest is lazy.
    """
    limits = limits or HotLimits()
    spelled = {c.lower(): c for c in df.columns}
    keys = [k if k in df.columns else spelled.get(k.lower(), k) for k in keys]
    ordering = [order_by, *tiebreak]
    hot = hot_groups(df, keys, limits)
    hot_rows = hot.agg(F.sum("_n")).first()[0]
    if hot_rows is None:
        return lag_in_group(df, keys, ordering, carry)
    hot = hot.drop("_n")
    cold = lag_in_group(_match(df, hot, keys, "left_anti"), keys, ordering, carry)
    # slices of half the limit, as the bounds are estimates
    sliced = cut(_match(df, hot, keys, "left_semi"), keys, ordering, math.ceil(2 * hot_rows / limits.rows))
    return cold.unionByName(_lag_over_slices(sliced, keys, [*ordering, _TIE], carry))


def hot_groups(df: DataFrame, keys: Sequence[str], limits: HotLimits) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > limits.rows)


def cut(rows: DataFrame, keys: Sequence[str], ordering: Sequence[str], slices: int) -> DataFrame:
    """Write the rows in ``slices`` ranges of (keys, ordering) and read them with the number of the range."""
    path = fresh_path(rows.sparkSession, "slices")
    (rows.withColumn(_TIE, F.monotonically_increasing_id())
     .repartitionByRange(slices, *keys, *ordering, _TIE)
     .withColumn(_SLICE, F.spark_partition_id())
     .write.parquet(path))
    return rows.sparkSession.read.parquet(path)


def lag_in_group(df: DataFrame, keys: Sequence[str], ordering: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """The plain window: each row's predecessor in its group as one struct."""
    # one struct, because the previous row may well have NULL in a single carried column
    window = Window.partitionBy(*keys).orderBy(*ordering)
    return df.withColumn(PREVIOUS, F.lag(F.struct(*carry)).over(window))


def _lag_over_slices(sliced: DataFrame, keys: Sequence[str], ordering: Sequence[str],
                     carry: Sequence[str]) -> DataFrame:
    part = [*keys, _SLICE]
    ends = sliced.groupBy(*part).agg(F.max_by(F.struct(*carry), F.struct(*ordering)).alias("_end"))
    before = F.lag("_end").over(Window.partitionBy(*keys).orderBy(_SLICE))
    within = lag_in_group(sliced, part, ordering, carry)
    return (_match(within, ends.select(*part, before.alias("_before")), part, "left")
            .withColumn(PREVIOUS, F.coalesce(PREVIOUS, "_before"))
            .drop("_before", _SLICE, _TIE))


def _match(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys of which NULLs match each other; Spark chooses how by the size it finds."""
    renamed = other.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                           *[c for c in other.columns if c not in keys])
    condition = reduce(Column.__and__, [df[k].eqNullSafe(renamed[f"_k{i}"]) for i, k in enumerate(keys)])
    return df.join(renamed, condition, how).drop(*[f"_k{i}" for i in range(len(keys))])
