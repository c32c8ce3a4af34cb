from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def bucketize(df: DataFrame, bins: list[float], names: list[str], in_col: str, out_col: str,
              strict: bool = False) -> DataFrame:
    """Name the half-open interval ``[bins[i], bins[i+1])`` a value falls in; the last one is closed.

    NULL, NaN and values outside the bins get a NULL name, or an error when ``strict``.
    """
    if len(bins) != len(names) + 1 or any(a >= b for a, b in zip(bins, bins[1:])):
        raise ValueError("bins must rise strictly and be one more than names")
    value = F.col(in_col).cast("double")
    missing = F.raise_error(F.concat(F.lit(f"{in_col} has no bucket: "), F.coalesce(value.cast("string"), F.lit("NULL"))))
    nothing = missing.cast("string") if strict else F.lit(None).cast("string")
    # NaN compares greater than every number, so it has to be tested first
    chain = F.when(value.isNull() | F.isnan(value) | (value < bins[0]) | (value > bins[-1]), nothing)
    for upper, name in zip(bins[1:-1], names[:-1]):
        chain = chain.when(value < upper, F.lit(name))
    return df.withColumn(out_col, chain.otherwise(F.lit(names[-1])))


def distribution(df: DataFrame, cat_col: str, count_col: str, weight: str | None = None) -> DataFrame:
    """Rows per bucket and their share in percent; only buckets that occur are listed.

    With ``weight`` a row counts as often as that column says. The shuffle carries one partial
    count per task and bucket, however the rows are spread. The total runs over those few bucket
    rows, so its single partition is of fixed size.
    """
    counted = F.sum(weight) if weight else F.count("*")
    counts = df.groupBy(cat_col).agg(counted.alias(count_col))
    total = F.sum(count_col).over(Window.partitionBy())
    return counts.withColumn("percentage", F.lit(100) * F.col(count_col) / total)
