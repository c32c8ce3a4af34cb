from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_label(part: Column, total: Column) -> Column:
    """Text such as ``12.5%`` with one decimal, rounded half up.

    Integer arithmetic only: formatting a double would round its binary value,
    and engines disagree on that at exact ties.
    """
    tenths = _div(2000 * part + total, 2 * total)
    whole = _div(tenths, F.lit(10)).cast("string")
    return F.concat(whole, F.lit("."), (tenths % 10).cast("string"), F.lit("%"))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)
