"""Connected components of an edge table, by alternating large-star and small-star steps.

Each task first joins what its own edges connect, so that few rounds remain. A node's smallest
neighbour comes from a map-side combined minimum, so a node with very many edges is no hot group.
Every round is written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackspark.llm.common import stored


def join_sets(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of some edges and the smallest node each is connected with through them."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        while (new != new[new]).any():
            new = new[new]
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes, roots = join_sets(batch.column(0).to_numpy(), batch.column(1).to_numpy())
        far = nodes != roots
        yield pa.RecordBatch.from_arrays([pa.array(nodes[far]), pa.array(roots[far])], ["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """Of ``edges`` (a, b; longs) every node that is not the smallest of its component: node, component."""
    now = stored(edges.mapInArrow(_local, "a long, b long").distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b") % 1_000_003).alias("h")).first()
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = state
        # large star: larger neighbours of a node move to its smallest
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        moved = stored(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "edges")
        # small star: a node and its smaller neighbours move to the smallest of them
        least = moved.groupBy("a").agg(F.min("b").alias("m"))
        pulled = moved.join(least, "a")
        now = stored(pulled.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                     .unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
