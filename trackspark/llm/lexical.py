"""Ranked lexical search by scanning texts with an Aho-Corasick automaton; no index over the documents.

Terms are the maximal runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased. The terms of
all items form one automaton, each guarded by a boundary on both sides, so that it matches whole
terms only. A text with every run of other characters put as one boundary is scanned once, and
the automaton's outputs are its counts of item terms. Outputs map to items by a sparse matrix of how often
each item holds each term.

* **Two scans.** The first counts what scores depend on: documents with a term, all terms, and for each item
  term the documents that hold it. The second scores every document with its own counts at once, so nothing is
  stored for a document. Statistics are sums, combined in the tasks before any shuffle.
* **Best documents.** A task keeps the ``top`` best documents of each item. They are ranked in two steps, first by
  item and a salt and then by item, so no task gets all candidates of an item.
* **Bounds.** What is broadcast are the items. ``BROADCAST_BYTES`` of item text make one automaton; more items
  are dealt to several, of which each takes two scans of the documents. One item larger than that is still one item.

Integers are of 64 bits throughout; sums that could leave the exact range of doubles are kept as integers.

Defined cases: NULL, empty and symbol-only texts hold no term: such documents are not counted, such items have no rows.
Rows of documents are documents of their own even where they repeat an id or a whole row. Rows of one item_id
(NULL is one too) are one item with the terms of its distinct texts. Equal scores rank by doc_id, NULL first. Very long
texts are scanned in pieces of ``PIECE`` characters, cut at boundaries. Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackspark.llm.common import runs

TOP = 10
BROADCAST_BYTES = 16 << 20
PIECE = 1 << 20
SALTS = 64
_EXACT = 1 << 53
#: [^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]: what a term is made of
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_GAP = re.compile(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
_EDGE = " "


def terms(text: str | None) -> list[str]:
    return TERM.findall((text or "").translate(_LOWER))


def automaton(words: list[str]):
    """Words between boundaries; the output of a match is the word's number."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for i, word in enumerate(words):
        found.add_word(f"{_EDGE}{word}{_EDGE}", i)
    found.make_automaton()
    return found


def _guarded(text: str) -> Iterator[str]:
    """The text in pieces, lower-cased, with one boundary before, between and after its terms."""
    at = 0
    while at < len(text):
        cut = at + PIECE
        if cut < len(text):
            gap = _GAP.search(text, cut)
            cut = gap.end() if gap else len(text)
        yield f"{_EDGE}{_GAP.sub(_EDGE, text[at:cut].translate(_LOWER)).strip(_EDGE)}{_EDGE}"
        at = cut


def scan(found, text: str | None) -> tuple[int, np.ndarray, np.ndarray]:
    """Terms of a text, and the numbers and counts of the item terms among them."""
    n, hits = 0, []
    for piece in _guarded(text or ""):
        n += piece.count(_EDGE) - 1 if len(piece) > 2 else 0
        hits += [i for _, i in found.iter(piece)] if len(found) else []
    return n, *np.unique(np.array(hits, np.int64), return_counts=True)


def weight(total: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * total + 2) / (2 * holding + 1)))


def _items(items: DataFrame) -> list[tuple[object, list[str]]]:
    """Item ids with their terms, in the order of the id; bounded by the caller's groups."""
    rows = items.select("item_id", F.col("text").cast("string").alias("text")).distinct().orderBy("item_id", "text").collect()
    out = []
    for key, group in groupby(rows, key=lambda r: r["item_id"]):
        words = [w for r in group for w in terms(r["text"])]
        if words:
            out.append((key, words))
    return out


def _groups(items: DataFrame) -> Iterator[DataFrame]:
    """Items in groups of about ``BROADCAST_BYTES``; usually that is all of them."""
    size = items.agg(F.sum(F.octet_length(F.col("text").cast("string")) + 16)).first()[0] or 0
    n = math.ceil(size / BROADCAST_BYTES)
    for i in range(n):
        yield items.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == i) if n > 1 else items


def _statistics(docs: DataFrame, words) -> tuple[int, int, dict[int, int]]:
    """Documents with a term, all their terms, and documents for each item term."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton(words.value)
        held, documents, total = np.zeros(len(words.value), np.int64), 0, 0
        for batch in batches:
            for part in runs(batch, "text"):
                for text in part.column("text").to_pylist():
                    n, numbers, _ = scan(found, text)
                    documents, total = documents + (n > 0), total + n
                    held[numbers] += 1
        some = np.flatnonzero(held)
        # two numbers that are no terms stand for the sums
        yield pa.RecordBatch.from_arrays([pa.array([-2, -1, *some.tolist()], pa.int64()),
                                          pa.array([documents, total, *held[some].tolist()], pa.int64())], ["word", "n"])

    sums = docs.select("text").mapInArrow(work, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    counts = {r["word"]: r["n"] for r in sums}
    return counts.pop(-2, 0), counts.pop(-1, 0), counts


def _best(docs: DataFrame, words, matrix, documents: int, total: int, weights: np.ndarray, names: int, top: int) -> DataFrame:
    """The best documents of each task for every item: item (number), doc_id, score."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, (first, items, times, exact) = automaton(words.value), matrix.value
        least = np.zeros(names, np.int64)  # a score has to exceed this to matter
        kept: list[list[tuple]] = [[] for _ in range(names)]

        def trim(item: int) -> None:
            kept[item].sort(key=lambda x: (-x[0], x[1] is not None, x[1] or 0))
            del kept[item][top:]
            if len(kept[item]) == top:
                least[item] = kept[item][-1][0]

        for batch in batches:
            for part in runs(batch, "text"):
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    n, numbers, counts = scan(found, text)
                    if not len(numbers):
                        continue
                    m = 25 + (75 * n * documents) // total
                    value = weights[numbers] * ((1_000_000_000 * counts) // (1000 * counts + 8 * m))
                    held = first[numbers + 1] - first[numbers]
                    # the cells of all matched words, end to end
                    cells = np.arange(held.sum()) + np.repeat(first[numbers] - np.cumsum(held) + held, held)
                    shares = times[cells] * np.repeat(value, held)
                    if exact:
                        scores = np.bincount(items[cells], shares, names).astype(np.int64)
                    else:
                        scores = np.zeros(names, np.int64)
                        np.add.at(scores, items[cells], shares)
                    for item in np.flatnonzero((scores >= least) & (scores > 0)):
                        kept[item].append((int(scores[item]), doc))
                        if len(kept[item]) >= 4 * top:
                            trim(item)
        rows = []
        for item in range(names):
            trim(item)
            rows += [(item, doc, score) for score, doc in kept[item]]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["item", "doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(work, "item long, doc_id long, score long")


def lexical_search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` best documents of each item: item_id, rank (from 1), doc_id, score."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kind = items.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for group in _groups(items):
        named = _items(group)
        if not named:
            continue
        numbers: dict[str, int] = {}
        cells: dict[tuple[int, int], int] = {}
        for i, (_, found) in enumerate(named):
            for word in found:
                cell = numbers.setdefault(word, len(numbers)), i
                cells[cell] = cells.get(cell, 0) + 1
        words = spark.sparkContext.broadcast(list(numbers))
        documents, total, holding = _statistics(texts, words)
        if not documents:
            continue
        weights = np.array([weight(documents, holding.get(i, 0)) for i in range(len(numbers))], np.int64)
        longest = max(len(found) for _, found in named)
        exact = longest * max(1, int(weights.max())) * 1_000_000 < _EXACT
        # cells in the order of their words, and where each word's begin
        ordered = sorted(cells)
        first = np.searchsorted(np.array([w for w, _ in ordered], np.int64), np.arange(len(numbers) + 1))
        matrix = spark.sparkContext.broadcast((first, np.array([i for _, i in ordered], np.int64),
                                               np.array([cells[c] for c in ordered], np.int64), exact))
        best = _best(texts, words, matrix, documents, total, weights, len(named), top)
        order = [F.desc("score"), F.asc_nulls_first("doc_id")]
        some = F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))
        ranked = F.row_number().over(Window.partitionBy("item").orderBy(*order))
        # which rows share a salt makes no difference to what is left at the end
        salted = best.withColumn("salt", F.spark_partition_id() % SALTS)
        ranks = (salted.withColumn("r", some).where(F.col("r") <= top).withColumn("rank", ranked).where(F.col("rank") <= top)
                 .select("item", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
        ids = spark.createDataFrame([(i, key) for i, (key, _) in enumerate(named)], f"item long, item_id {kind}")
        out = out.unionByName(ranks.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score"))
    return out
