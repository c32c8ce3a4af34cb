"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a shuffled order, repeated up to ``most`` times. A
document's virtual finish time is its source's words up to and including it, divided by the
source's target. All queues are merged by one global range sort on that time, and the mix ends
where the total budget is reached. Two running totals do it, each over range partitions, so a
source of any size is spread over many tasks.

Sizes are words ``[^\\x20\\x09-\\x0D]+``. NULL and empty texts have size 0; NULL is a source like
any other, after all named ones. Equal rows are queued one by one. A table without words takes
nothing; an empty table gives an empty mix. Only the id, text and source columns are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackspark.llm.common import running_total, same, stored

WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3) -> DataFrame:
    """Per source its size, the size of all sources before it, and its target.

    A target above ``most`` times the size is cut to that, and what is over goes to the others by
    weight. The cut sources come first in the order of ``most * size / weight``; the level of the
    rest follows from running sums over that order. One row per source passes the window.
    """
    by_source = Window.orderBy(F.col("source").asc_nulls_last())
    by_room = Window.orderBy("room", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    named = F.array(*[F.lit(int(w)) for w in weights])
    return (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
            .withColumn("weight", F.get(named, (F.row_number().over(by_source) - 1) % len(weights)))
            .withColumn("source_before", F.coalesce(F.sum("source_size").over(
                by_source.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .withColumn("room", most * F.col("source_size") / F.col("weight"))
            .withColumn("left", F.sum("source_size").over(everything)
                        - most * F.coalesce(F.sum("source_size").over(by_room), F.lit(0)))
            .withColumn("weight_left", F.sum("weight").over(everything)
                        - F.coalesce(F.sum("weight").over(by_room), F.lit(0)))
            .withColumn("level", F.col("left") / F.col("weight_left"))
            # the first source with room enough ends the cut ones; later ones share its level
            .withColumn("level", F.first(F.when(F.col("room") >= F.col("level"), F.col("level")), ignorenulls=True)
                        .over(everything))
            .select("source", "source_size", "source_before",
                    F.when(F.col("room") <= F.col("level"), (most * F.col("source_size")).cast("double"))
                    .otherwise(F.col("level") * F.col("weight")).alias("target")))


def mix_sources(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3, seed: str = "mix") -> DataFrame:
    """One row per document: doc_id, size, source, source_size, target, copies, taken (words)."""
    sized = stored(docs.select(
        "doc_id", "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))).alias("shuffle"),
        F.xxhash64("text").alias("text_hash")), "sizes")
    targets = stored(source_targets(sized, weights, most), "targets")
    queued = (running_total(sized.withColumn("no_source", F.col("source").isNull().cast("int")),
                            ["no_source", "source", "shuffle", "text_hash"], "size", "upto")
              .withColumnRenamed("source", "queue"))
    # one row per source: Spark broadcasts it where it is small
    timed = stored(queued.join(targets, same(queued["queue"], targets["source"])).select(
        "doc_id", "source", "size", "source_size", "target", "shuffle", "text_hash", "no_source",
        (F.col("upto") - F.col("source_before")).alias("upto")), "queued")
    budget = targets.agg(F.sum("source_size").alias("b")).first()["b"] or 0
    arrivals = (timed.select("doc_id", "source", "no_source", "shuffle", "text_hash", "size", "source_size", "target", "upto",
                             F.explode(F.array(*[F.lit(e) for e in range(most)])).alias("epoch"))
                .withColumn("finish", F.when(F.col("target") > 0, (F.col("epoch") * F.col("source_size") + F.col("upto")) / F.col("target"))
                            .otherwise(F.lit(0.0)))
                .drop("upto"))
    merged = running_total(arrivals, ["finish", "no_source", "source", "epoch", "shuffle", "text_hash"], "size", "total")
    taken = (merged.groupBy("doc_id", "source", "shuffle", "text_hash", "size", "source_size", "target")
             .agg(F.count(F.when(F.col("total") <= budget, 1)).alias("taken_copies"),
                  F.count(F.when(F.col("epoch") == 0, 1)).alias("rows")))
    # equal rows were queued one by one: deal their copies out again
    return (taken.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)))
            .withColumn("copies", F.floor((F.col("taken_copies") + F.col("rows") - 1 - F.col("_i")) / F.col("rows")))
            .select("doc_id", "size", "source", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")))
