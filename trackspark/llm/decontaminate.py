"""Benchmark decontamination by winnowing.

Texts are lower-cased (A-Z) and cut into words of digits, letters and all longer UTF-8 characters.
A window of ``L`` words (10; a shorter item is one window of its own length) has ``w = L - k + 1``
grams of ``k = ceil(L / 2)`` words. Of every window of a text the rightmost gram of least hash is
kept as a fingerprint, so two texts that share a window share a fingerprint in it. The
fingerprints of documents and benchmark are joined, and every hit is extended word by word over
at most ``L - k`` words on both sides: all words of a run of ``L`` or more are hit. Fingerprints
only propose; what counts is the comparison of the words themselves.

Before the join, documents drop fingerprints that are not in a bitmap of the benchmark's. It has a
fixed size, whatever the benchmark's; false positives cost a row and are removed by the join.
Hits of equal surroundings are one row on the benchmark's side, with the list of their items.

A NULL or empty text has no words. Items without words, or with NULL as id, match nothing. Rows
that repeat an id are scored each for its own text; equal rows each get the same result. Empty
tables on either side give no hits. Only the id and text columns are read, whatever others there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackspark.llm.common import runs, same, stored
from trackspark.llm.words import ALNUM, Words, find_words, grams

#: bits of the bitmap of benchmark fingerprints
BITMAP_BITS = 1 << 23

_HIT = "array<struct<length:int,print:long,at:int,left:string,mid:string,right:string>>"
_DOC_SCHEMA = f"doc_id long, text_hash long, n_words long, prints {_HIT}"
_ITEM_SCHEMA = "item_id string, length int, print long, left string, mid string, right string"


def window_shape(length: int) -> tuple[int, int]:
    """Words of a gram and grams of a window for windows of ``length`` words."""
    k = (length + 1) // 2
    return k, length - k + 1


def winnow(words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First words and hashes of the kept grams of all windows that lie within one text."""
    k, w = window_shape(length)
    hashes = grams(words.hash, k)
    n = len(hashes) - w + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least = hashes[:n].copy()
    at = np.arange(n)
    for j in range(1, w):
        other = hashes[j:j + n]
        better = other <= least
        at[better] = np.flatnonzero(better) + j
        np.minimum(least, other, out=least)
    whole = words.doc[:n] == words.doc[length - 1:length - 1 + n]
    at = np.unique(at[whole])
    return at, hashes[at]


def _around(words: Words, raw: bytes, at: int, k: int, reach: int) -> tuple[str, str, str]:
    """The words before, in and after a gram, with single blanks between them."""
    def joined(a: int, b: int) -> str:
        return b" ".join(raw[words.start[i]:words.end[i]].lower() for i in range(a, b)).decode()
    doc = words.doc[at]
    a, b = at, at + k
    while a > 0 and at - a < reach and words.doc[a - 1] == doc:
        a -= 1
    while b < len(words.doc) and b - at - k < reach and words.doc[b] == doc:
        b += 1
    return joined(a, at), joined(at, at + k), joined(at + k, b)


def _signed(hashes: np.ndarray) -> list[int]:
    return hashes.view(np.int64).tolist()


def _items(length: int):
    """Fingerprints of items, with their surroundings, for windows of ``length`` words or for shorter items."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in runs(batch, "text"):
                ids = part.column("item_id").to_pylist()
                words = find_words(part.column("text"), ALNUM)
                raw, counts = words.data.tobytes(), words.counts()
                rows = []
                for size in sorted(set(np.minimum(counts, length).tolist()) - {0}):
                    k, w = window_shape(size)
                    fits = counts >= length if size == length else counts == size
                    at, hashes = winnow(words, size)
                    keep = fits[words.doc[at]]
                    for i, h in zip(at[keep].tolist(), _signed(hashes[keep])):
                        rows.append((ids[words.doc[i]], size, h, *_around(words, raw, i, k, size - k)))
                yield _batch(rows, ["item_id", "length", "print", "left", "mid", "right"],
                             [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string()])
    return run


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _documents(sizes: list[int], bitmap: bytes):
    """Per document its word count and those fingerprints that the bitmap may hold."""
    entry = pa.struct([("length", pa.int32()), ("print", pa.int64()), ("at", pa.int32()),
                       ("left", pa.string()), ("mid", pa.string()), ("right", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap, np.uint8)
        for batch in batches:
            for part in runs(batch, "text"):
                words = find_words(part.column("text"), ALNUM)
                raw, counts = words.data.tobytes(), words.counts()
                first = np.concatenate([[0], np.cumsum(counts)])
                found: list[list[dict]] = [[] for _ in range(part.num_rows)]
                for size in sizes:
                    k, _ = window_shape(size)
                    at, hashes = winnow(words, size)
                    slot = hashes % np.uint64(BITMAP_BITS)
                    maybe = bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8) & 1 > 0
                    for i, h in zip(at[maybe].tolist(), _signed(hashes[maybe])):
                        left, mid, right = _around(words, raw, i, k, size - k)
                        d = words.doc[i]
                        found[d].append({"length": size, "print": h, "at": int(i - first[d]), "left": left, "mid": mid, "right": right})
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_hash"), pa.array(counts.astype(np.int64)), pa.array(found, pa.list_(entry))],
                    ["doc_id", "text_hash", "n_words", "prints"])
    return run


def _common(a: str, b: str, from_end: bool) -> int:
    x, y = a.split(" ") if a else [], b.split(" ") if b else []
    if from_end:
        x, y = x[::-1], y[::-1]
    n = 0
    while n < len(x) and n < len(y) and x[n] == y[n]:
        n += 1
    return n


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joined fingerprints that grow to a whole window: which words of the document, and the items."""
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            if r["mid"] != r["item_mid"]:
                continue
            k = window_shape(r["length"])[0]
            left, right = _common(r["left"], r["item_left"], True), _common(r["right"], r["item_right"], False)
            if left + k + right >= r["length"]:
                rows.append((r["doc_id"], r["text_hash"], r["at"] - left, r["at"] + k + right, r["items"]))
        yield _batch(rows, ["doc_id", "text_hash", "first", "end", "items"],
                     [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.string())])


def benchmark_prints(benchmark: DataFrame, length: int = 10) -> DataFrame:
    """Distinct fingerprints with surroundings and the items that hold them."""
    found = (benchmark.where(F.col("item_id").isNotNull())
             .select(F.col("item_id").cast("string").alias("item_id"), "text").mapInArrow(_items(length), _ITEM_SCHEMA))
    return stored(found.groupBy("length", "print", "left", "mid", "right")
                  .agg(F.collect_set("item_id").alias("items")), "items")


def _bitmap(prints: DataFrame) -> bytes:
    """One bit per fingerprint, by hash; 2^23 bits whatever the size of the benchmark."""
    slots = (prints.select(F.pmod(F.col("print"), F.lit(BITMAP_BITS)).alias("slot")).distinct()
             .groupBy((F.col("slot") / 4096).cast("int").alias("page"))
             .agg(F.collect_list((F.col("slot") % 4096).cast("int")).alias("bits")))
    out = np.zeros(BITMAP_BITS, bool)
    for page in slots.toLocalIterator():
        out[page["page"] * 4096 + np.asarray(page["bits"], np.int64)] = True
    return np.packbits(out, bitorder="little").tobytes()


def decontaminate(docs: DataFrame, benchmark: DataFrame, length: int = 10) -> DataFrame:
    """One row per document: doc_id, n_words, spans (first word, end) that are hit, items (sorted)."""
    prints = benchmark_prints(benchmark, length)
    sizes = sorted(r["length"] for r in prints.select("length").distinct().collect())  # at most ``length`` rows
    scanned = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
                     .mapInArrow(_documents(sizes, _bitmap(prints)), _DOC_SCHEMA), "scanned")
    hits = (scanned.where(F.size("prints") > 0).dropDuplicates(["doc_id", "text_hash"])
            .select("doc_id", "text_hash", F.explode("prints").alias("p"))
            .select("doc_id", "text_hash", "p.*"))
    other = prints.select("length", "print", F.col("left").alias("item_left"), F.col("mid").alias("item_mid"),
                          F.col("right").alias("item_right"), "items")
    # no hint: Spark broadcasts the benchmark's side only below its own limit and splits hot fingerprints above
    extended = (hits.join(other, ["length", "print"])
                .mapInArrow(_extend, "doc_id long, text_hash long, first int, end int, items array<string>"))
    found = (extended.groupBy("doc_id", "text_hash")
             .agg(F.array_sort(F.collect_set(F.struct("first", "end"))).alias("spans"),
                  F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")))
    found = found.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), "spans", "items")
    base = scanned.select("doc_id", "text_hash", "n_words")
    return (base.join(found, same(base["doc_id"], found["d"]) & (base["text_hash"] == found["h"]), "left")
            .select("doc_id", "n_words", F.coalesce("spans", F.array().cast("array<struct<first:int,end:int>>")).alias("spans"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def hit_words(spans):
    """Number of words that rising spans cover."""
    start = F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("n"))
    grown = F.aggregate(spans, start, lambda a, s: F.struct(
        F.greatest(a["upto"], s["end"]).alias("upto"),
        (a["n"] + F.greatest(s["end"] - F.greatest(a["upto"], s["first"]), F.lit(0))).alias("n")))
    return grown["n"]
