"""Exact top-k inner products by the threshold algorithm.

Vectors are integers: each component x becomes floor(scale * x). Candidates are packed into blocks;
a block keeps, for every dimension, its rows sorted by that component, stored with the block. A
query reads each list from the end its sign favours, a step of rows of all lists at a time, scores every row it
meets for the first time, and stops when the threshold (the score of a row as good as the last read
entry of every list) is below the k-th score it has. Equality does not stop it, as an unread row
might tie with a smaller id.

Queries go to the candidates in passes of at most ``QUERY_BYTES``, broadcast, and candidates are not shuffled for them. A task
carries the best k of each query of the pass from one of its blocks to the next, so the k-th score of earlier blocks
stops the search of later ones, and hands on k rows per query at its end. The number of tasks follows the session, so what is
shuffled grows with the queries only.

Vectors that are NULL or hold NULL, NaN or infinity take no part, and vectors meet only those of their
own length. Ids may repeat: every row is a candidate, save those with the query's own id; NULL ids take
no part. Sums below 2^53 are exact in doubles and others are Python's integers; rows are ranked by the exact sum
and only the reported score is cut to the range of long. No queries or no candidates: no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackspark.llm.common import stored, tasks
from trackspark.session import fresh_path

BLOCK_ROWS = 8192
QUERY_ROWS = 256
#: bytes of queries that are sent to all tasks at once
QUERY_BYTES = 16 << 20
STEP = 16
#: integers are kept in doubles as so many parts of one, so that none of them overflows
UNIT = 2.0 ** -12
LONG = 1 << 63


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id and the integer components (doubles, times ``UNIT``), without vectors that take no part."""
    x = F.col("embedding").cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return (vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine)
            .select(F.col("vec_id").cast("long").alias("vec_id"),
                    F.transform(x, lambda v: F.when(F.abs(v) < 1e15, F.floor(v * scale).cast("double") * UNIT).otherwise(v * UNIT * scale)).alias("x")))


def _packed(vectors: DataFrame, rows: int, sort: bool) -> DataFrame:
    """Blocks of about ``rows`` vectors of one length, by hash of the id, with their sorted lists (as row numbers) on demand."""
    counts = {r["dim"]: r["count"] for r in vectors.groupBy(F.size("x").alias("dim")).count().collect()}  # one row per length
    if not counts:
        counts = {0: 0}
    blocks = F.create_map(*[F.lit(v) for dim, n in counts.items() for v in (dim, max(1, round(n / rows)))])
    placed = (vectors.withColumn("dim", F.size("x"))
              # repeated ids are dealt out by a number of their own, so a block has no more than its share
              .withColumn("block", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.element_at(blocks, F.col("dim"))).cast("int")))

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        values = np.stack(rows["x"].to_numpy()).astype("<f8") if key[0] else np.zeros((len(rows), 0))
        order = np.argsort(rows["vec_id"].to_numpy(), kind="stable")
        values = values[order]
        lists = np.argsort(values, axis=0, kind="stable").astype("<i4") if sort else values[:0]
        return pd.DataFrame({"dim": [key[0]], "block": [key[1]], "ids": [rows["vec_id"].to_numpy()[order].astype("<i8").tobytes()],
                             "values": [values.tobytes()], "lists": [lists.tobytes()]})
    return placed.groupBy("dim", "block").applyInPandas(pack, "dim int, block int, ids binary, values binary, lists binary")


class Best:
    """The best k rows that a query has met: ids and exact scores, best first."""

    def __init__(self) -> None:
        self.ids, self.scores = np.zeros(0, np.int64), np.zeros(0)

    def add(self, ids: np.ndarray, scores: np.ndarray, k: int) -> None:
        ids, scores = np.concatenate([self.ids, ids]), np.concatenate([self.scores, scores])
        if scores.dtype == object:
            order = np.asarray(sorted(range(len(ids)), key=lambda j: (-scores[j], ids[j]))[:k], np.int64)
        else:
            order = np.lexsort((ids, -scores))[:k]
        self.ids, self.scores = ids[order], scores[order]


def threshold_search(ids: np.ndarray, values: np.ndarray, lists: np.ndarray, own: np.ndarray, queries: np.ndarray, k: int,
                     best: list[Best] | None = None, step: int = STEP) -> list[Best]:
    """Merge the best ``k`` rows of a block into those that each query has. ``ids`` rise."""
    n, dims = values.shape
    best = [Best() for _ in queries] if best is None else best
    most = [float(np.abs(x).max(initial=0)) / UNIT for x in (values, queries)]
    exact = most[0] * most[1] * max(1, dims) < 2 ** 53
    for i, q in enumerate(queries):
        used = np.flatnonzero(q)
        seen = np.zeros(n, bool)
        down = q[used] > 0
        depth, ahead = 0, step
        while depth < n:
            upto = min(n, depth + ahead) if len(used) else n
            at = np.where(down, n - 1 - np.arange(depth, upto)[:, None], np.arange(depth, upto)[:, None])
            rows = lists[at, used].ravel() if len(used) else np.arange(n)
            fresh = np.zeros(n, bool)
            fresh[rows] = True
            fresh &= ~seen
            seen |= fresh
            rows = np.flatnonzero(fresh & (ids != own[i]))
            best[i].add(ids[rows], values[rows] @ q / UNIT ** 2 if exact else np.asarray([_whole(values[r], q) for r in rows], object), k)
            depth = upto
            if depth >= n:
                break
            last = np.where(down, n - depth, depth - 1)
            edge = values[lists[last, used], used]
            bound = edge @ q[used] / UNIT ** 2 if exact else _whole(edge, q[used])
            if len(best[i].ids) == k and bound < best[i].scores[-1]:
                break
            ahead = min(2 * ahead, n) if depth >= 8 * ahead else ahead
    return best


def _integer(x: float) -> int:
    n, d = x.as_integer_ratio()
    return n * int(1 / UNIT) // d


def _whole(a: np.ndarray, b: np.ndarray) -> int:
    return sum(_integer(x) * _integer(y) for x, y in zip(a.tolist(), b.tolist()))


def _order_key(score: int) -> bytes | None:
    """Bytes that sort as the score does, where the range of long may not hold it."""
    return (score + (1 << 2300)).to_bytes(290, "big") if abs(score) >= LONG // 2 else None


def _matrix(data: bytes, rows: int, dim: int, kind: str) -> np.ndarray:
    return np.frombuffer(data, kind).reshape(rows, dim)


def _pass(blocks: DataFrame, dim: int, asked: list, k: int) -> DataFrame:
    """The best ``k`` rows of ``blocks`` for the queries of a pass."""
    spark = blocks.sparkSession
    own = np.concatenate([np.frombuffer(r["ids"], "<i8") for r in asked])
    queries = np.concatenate([_matrix(r["values"], len(r["ids"]) // 8, dim, "<f8") for r in asked])
    sent = spark.sparkContext.broadcast((own, queries))  # QUERY_BYTES at most, or one pack

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, queries = sent.value
        best: list[Best] | None = None
        for batch in batches:
            for ids, values, lists in zip(*(batch.column(c) for c in ("ids", "values", "lists"))):
                ids = np.frombuffer(ids.as_buffer(), "<i8")
                best = threshold_search(ids, _matrix(values.as_buffer(), len(ids), dim, "<f8"), _matrix(lists.as_buffer(), len(ids), dim, "<i4"),
                                        own, queries, k, best)
        for first in range(0, len(best or []), 4096):
            part = best[first:first + 4096]
            number = np.repeat(np.arange(first, first + len(part)), [len(b.ids) for b in part])
            scores = [int(s) for b in part for s in b.scores]
            yield pa.RecordBatch.from_arrays(
                [pa.array(number), pa.array(own[number]), pa.array(np.concatenate([b.ids for b in part])),
                 pa.array([min(max(s, -LONG), LONG - 1) for s in scores], pa.int64()), pa.array([_order_key(s) for s in scores], pa.binary())],
                ["asked", "query_id", "vec_id", "score", "key"])
    here = blocks.where(F.col("dim") == dim).select("ids", "values", "lists")
    found = here.coalesce(tasks(spark)).mapInArrow(run, "asked long, query_id long, vec_id long, score long, key binary")
    # rows of one id that asks twice are told apart by their number
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("asked").orderBy(F.desc("score"), F.desc("key"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS,
          query_bytes: int = QUERY_BYTES) -> DataFrame:
    """For each query row the ``k`` best rows of ``vectors``: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    blocks = stored(_packed(quantised(vectors), block_rows, True), "blocks")
    asked = stored(_packed(quantised(queries), query_rows, False), "asked")
    out = fresh_path(spark, "top_k")
    schema = "query_id long, rank int, vec_id long, score long"
    spark.createDataFrame([], schema).write.parquet(out)
    packs = {r["dim"]: r["n"] for r in asked.groupBy("dim").agg((F.max("block") + 1).alias("n")).collect()}  # one row per length
    for dim, n in sorted(packs.items()):
        at_once = max(1, query_bytes // (8 * query_rows * (dim + 1)))
        for first in range(0, n, at_once):
            rows = asked.where((F.col("dim") == dim) & F.col("block").between(first, first + at_once - 1)).orderBy("block").collect()
            if rows:
                _pass(blocks, dim, rows, k).write.mode("append").parquet(out)
    return spark.read.schema(schema).parquet(out)
