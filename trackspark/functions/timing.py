from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def micros(ts: Column) -> Column:
    """Epoch microseconds of a ``timestamp`` or ``timestamp_ntz`` column."""
    return F.unix_micros(ts.cast("timestamp"))


def whole_seconds(ts: Column) -> Column:
    """Epoch seconds, the fraction of a second floored away."""
    return F.unix_seconds(ts.cast("timestamp"))


def hours(seconds: Column) -> Column:
    # two divisions, so that the doubles equal a seconds / 60 / 60 computed elsewhere
    return seconds / 60 / 60
