"""SimHash near-duplicates by pivot distance tables.

A text's A-Z are lower-cased, its words are what stands between blanks, and every run of ``k`` words
joined by one space (repeats included; fewer words: all of them) is hashed to 64 bits. A bit of the
fingerprint is 1 if over half the hashes have it. Fingerprints link at ``distance`` or fewer
differing bits; a document's component is the smallest doc_id that links reach.

* **Copies first.** Equal fingerprints are one row from here on, so a group of copies of any size is one point.
* **Which pairs are looked at.** Distances to references crowd around 32, so a table of them cannot
  deal out pairs to tasks. The 64 bits are cut into ``blocks`` parts instead: two linked fingerprints
  differ in at most ``distance`` parts and so agree on the others. Each choice of that many parts is
  a key, and rows with a common key meet. This loses no link.
* **Pivot tables.** In a task each fingerprint gets its Hamming distances to ``PIVOTS`` references.
  By the triangle inequality these differ by at most ``distance`` between linked fingerprints, in
  every coordinate. Pairs with a larger coordinate difference are discarded, coordinate by
  coordinate, and the survivors are verified on the fingerprints themselves.
* **Crowded keys** (more than ``limit`` fingerprints). Fingerprints that only differ inside one group of
  ``distance`` neighbouring bits are linked whatever these are, so grouping by the other bits gives links
  without any pair. What this connects needs no comparison with itself; the rest of a crowded
  key meets in pairs of blocks of at most about ``limit`` rows.

A task hands on only the links that its own links do not imply. No pair within a group is written.

Defined cases: NULL, empty and blank texts have fingerprint zero, which links like any other. Rows
that repeat a doc_id are one document with several texts: each row is returned with its own
fingerprint, and they share a component. Rows without doc_id link by text only, and their
component is the smallest doc_id reached, NULL if there is none. Very long texts are hashed in pieces of
``PIECE`` bytes. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackspark.llm.common import runs, same, stored, tasks
from trackspark.llm.components import components, join_sets
from trackspark.llm.words import mix

SHINGLE = 4
DISTANCE = 4
SEED = 42
#: References of the distance table.
PIVOTS = 32
#: Parts of the bits: with 6, four differ at most and two agree, which are 21 bits or more.
BLOCKS = 6
#: Fingerprints with a common key that one task compares.
LIMIT = 4096
PIECE = 1 << 20
#: Links held before they are reduced to those that connect.
_EDGES = 1 << 20
_VOTES = 1 << 15


def _pieces(data: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(data):
        end = at + PIECE
        while end < len(data) and not data[end:end + 1].isspace():
            end += 1
        yield data[at:end]
        at = end


def shingle_hashes(data: bytes, k: int = SHINGLE) -> Iterator[np.ndarray]:
    """XXH64 of every run of ``k`` words of a UTF-8 text, in pieces."""
    import xxhash

    hashed, held, any_full = xxhash.xxh64_intdigest, [], False
    for piece in _pieces(data):
        words = held + piece.lower().split()
        if len(words) >= k:
            any_full = True
            text = b" ".join(words)
            at = np.zeros(len(words) + 1, np.int64)
            np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=at[1:])
            at = at.tolist()
            yield np.fromiter((hashed(text[a:b - 1], SEED) for a, b in zip(at, at[k:])), np.uint64, len(words) - k + 1)
        held = words[-(k - 1):] if k > 1 else []
    if held and not any_full:
        yield np.array([hashed(b" ".join(held), SEED)], np.uint64)


def fingerprint(data: bytes, k: int = SHINGLE) -> int:
    """The fingerprint of one text as a signed 64-bit number."""
    votes, n = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(data, k):
        n += len(hashes)
        for i in range(0, len(hashes), _VOTES):
            part = hashes[i:i + _VOTES]
            votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """doc_id and ``print`` (long) of every row of ``docs``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in runs(batch, "text"):
                prints = [fingerprint((t or "").encode(), k) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(prints, pa.int64())], ["doc_id", "print"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        work, "doc_id long, print long")


def references(n: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints: spread numbers, whose bits are half set and differ in half from each other."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def distance_table(prints: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Hamming distances, a row for each reference."""
    return np.stack([np.bitwise_count(prints ^ p) for p in pivots]).astype(np.int8)


def near_pairs(group: np.ndarray, prints: np.ndarray, pivots: np.ndarray, distance: int,
               apart: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of positions in a common run of ``group`` whose fingerprints link.

    The k-th step compares every row with the k-th after it. Rows with equal ``apart`` are not compared.
    """
    table = distance_table(prints, pivots)
    left, step = np.arange(len(group)), 1
    while True:
        left = left[left + step < len(group)]
        left = left[group[left] == group[left + step]]
        if not len(left):
            return
        a = left if apart is None else left[apart[left] != apart[left + step]]
        for coordinate in table:
            a = a[np.abs(coordinate[a] - coordinate[a + step]) <= distance]
        a = a[np.bitwise_count(prints[a] ^ prints[a + step]) <= distance]
        if len(a):
            yield a, a + step
        step += 1


def _link(distance: int, pivots: np.ndarray):
    """Tasks over rows sorted by ``key``; a run of equal keys may go on in the next batch."""

    def reduced(pairs: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        nodes, roots = join_sets(*(np.concatenate(side) for side in zip(*pairs)))
        far = nodes != roots
        return pa.RecordBatch.from_arrays([pa.array(nodes[far]), pa.array(roots[far])], ["a", "b"])

    def linked(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        key, prints, *apart = columns
        pairs, n = [], 0
        for a, b in near_pairs(key, prints.view(np.uint64), pivots, distance, *apart):
            pairs.append((prints[a], prints[b]))
            n += len(a)
            if n >= _EDGES:
                yield reduced(pairs)
                pairs, n = [], 0
        if pairs:
            yield reduced(pairs)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            now = [c.to_numpy() for c in batch.columns]
            if held is not None:
                now = [np.concatenate(x) for x in zip(held, now)]
            last = int(np.searchsorted(now[0], now[0][-1])) if len(now[0]) else 0
            held = [c[last:] for c in now]
            yield from linked([c[:last] for c in now])
        if held is not None:
            yield from linked(held)

    return work


def _parts(blocks: int) -> list[int]:
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]


def _signed(mask: int) -> Column:
    return F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long")


def keyed(prints: DataFrame, distance: int, blocks: int) -> DataFrame:
    """A row for every choice of ``blocks - distance`` parts: two that link have a key in common."""
    masks = [sum(chosen) for chosen in combinations(_parts(blocks), blocks - distance)]
    keys = F.array(*[F.xxhash64(F.lit(i), F.col("print").bitwiseAND(_signed(m))) for i, m in enumerate(masks)])
    return prints.select(F.explode(keys).alias("key"), "print")


def _star_links(prints: DataFrame, distance: int) -> DataFrame:
    """Links that no comparison is needed for: fingerprints equal outside ``distance`` neighbouring bits."""
    full = (1 << 64) - 1
    holes = [full ^ ((((1 << distance) - 1) << at) & full) for at in range(0, 64, distance)] if distance else []
    if not holes:
        return prints.select(F.col("print").alias("a"), F.col("print").alias("b")).limit(0)
    rows = prints.select("print", F.posexplode(F.array(*[F.col("print").bitwiseAND(_signed(m)) for m in holes])).alias("hole", "rest"))
    least = rows.groupBy("hole", "rest").agg(F.min("print").alias("b"), F.max("print").alias("top")).where("top > b").drop("top")
    return rows.join(least, ["hole", "rest"]).where("print > b").select(F.col("print").alias("a"), "b")


def _crowded_links(rows: DataFrame, counts: DataFrame, distance: int, pivots: np.ndarray, limit: int) -> DataFrame:
    """Links among rows (key, print) of keys with more than ``limit`` rows."""
    spark = rows.sparkSession
    prints = stored(rows.select("print").distinct(), "crowded")
    star = stored(_star_links(prints, distance), "star")
    of = components(star)
    home = rows.join(of, rows["print"] == of["node"], "left").select(
        "key", "print", F.coalesce("component", "print").alias("home"))
    home = stored(home, "homes")
    # a large home of a key gets blocks of its own; small ones share blocks
    sizes = home.groupBy("key", "home").agg(F.count("*").alias("n")).where(F.col("n") > limit // 2)
    placed = home.join(sizes, ["key", "home"], "left").join(counts, "key")
    deal = lambda n: F.pmod(F.xxhash64("print"), F.greatest(F.lit(1), F.ceil(n / F.lit(limit / 2)).cast("long")))
    placed = stored(placed.select("key", "print", "home", F.when(F.col("n").isNotNull(), F.col("home")).alias("own"),
                                  F.when(F.col("n").isNotNull(), deal(F.col("n"))).otherwise(deal(F.col("total"))).alias("block")), "blocks")
    blocks = placed.select("key", "own", "block").distinct()
    x, y = blocks.alias("x"), blocks.alias("y")
    first, second = F.struct(F.col("x.own"), F.col("x.block")), F.struct(F.col("y.own"), F.col("y.block"))
    pairs = x.join(y, F.col("x.key") == F.col("y.key")).where(
        (first <= second) & (F.col("x.own").isNull() | F.col("y.own").isNull() | (F.col("x.own") != F.col("y.own"))))
    named = pairs.select(F.col("x.key").alias("k"), F.xxhash64("x.key", "x.own", "x.block", "y.own", "y.block").alias("pair"),
                         F.explode(F.array_distinct(F.array(first, second))).alias("block_of"))
    dealt = placed.join(named, (placed["key"] == named["k"]) & same(placed["own"], named["block_of"]["own"])
                        & (placed["block"] == named["block_of"]["block"]))
    dealt = dealt.select(F.col("pair").alias("key"), "print", "home").repartition(tasks(spark), "key").sortWithinPartitions("key", "print")
    return dealt.mapInArrow(_link(distance, pivots), "a long, b long").unionByName(star)


def links(prints: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, limit: int = LIMIT, pivots: int = PIVOTS) -> DataFrame:
    """Links (a, b) between the distinct fingerprints ``prints``: enough of them to connect all that link."""
    if not 0 <= distance < blocks <= 64:
        raise ValueError("blocks must be more than distance")
    spark, table = prints.sparkSession, references(pivots)
    rows = keyed(prints, distance, blocks)
    counts = stored(rows.groupBy("key").agg(F.count("*").alias("total")).where(F.col("total") > limit), "counts")
    crowded = not counts.isEmpty()
    calm = rows.join(counts, "key", "left_anti") if crowded else rows
    near = (calm.repartition(tasks(spark), "key").sortWithinPartitions("key", "print")
            .mapInArrow(_link(distance, table), "a long, b long"))
    return near.unionByName(_crowded_links(stored(rows.join(counts, "key", "left_semi"), "crowd"), counts, distance, table, limit)) if crowded else near


def simhash_groups(docs: DataFrame, k: int = SHINGLE, distance: int = DISTANCE, blocks: int = BLOCKS,
                   limit: int = LIMIT, pivots: int = PIVOTS) -> DataFrame:
    """One row per document: doc_id, fingerprint (hex), component_id."""
    prints = stored(fingerprints(docs, k), "prints")
    points = stored(prints.groupBy("print").agg(F.min("doc_id").alias("first")), "points")
    near = links(points.select("print"), distance, blocks, limit, pivots)
    # rows of one doc_id belong together
    ids = prints.where("doc_id is not null").groupBy("doc_id").agg(F.min("print").alias("b"), F.max("print").alias("top")).where("top > b")
    again = prints.join(ids, "doc_id").where("print > b").select(F.col("print").alias("a"), "b")
    of = components(near.unionByName(again))
    placed = points.join(of, points["print"] == of["node"], "left").select("print", "first", F.coalesce("component", "print").alias("home"))
    placed = stored(placed, "homes")
    least = placed.groupBy("home").agg(F.min("first").alias("component_id"))
    named = placed.join(least, "home").select(F.col("print").alias("p"), "component_id")
    return (prints.join(named, prints["print"] == named["p"])
            .select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"))
