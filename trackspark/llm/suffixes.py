"""Exact substring dedup by merging Burrows-Wheeler transforms.

A byte goes if it is in a string of ``length`` bytes that starts earlier as well: in a smaller doc_id, or before in the same
document. Four steps narrow down what has to be sorted, without losing a match:

1. Of documents with equal texts the first stands for all.
2. Every window of ``length`` bytes has an anchor: of its runs of ``GRAM`` bytes the one with the least hash, the rightmost
   of equals. Equal windows have equal anchors at equal distance. Anchors that occur once in the corpus are left out.
3. An anchor's context is the bytes of all windows it is the anchor of. Of equal contexts the first stands for all, and the
   windows of the others are repeats.
4. Contexts that differ but have an anchor in common are collected, shuffled by anchor, as texts of small shards. A
   shard's Burrows-Wheeler transform is built once. The shards' transforms are then merged by refining their interleave,
   ``k`` (4) symbols each round: the order by ``h`` symbols, stably sorted by the ``k`` symbols before, is the order by ``h + k``. A
   boundary that appears in a round is where a common prefix ends in it; suffixes alone between boundaries are done. After
   ``length`` symbols the intervals left are the repeated strings; no suffixes are sorted again.

An anchor with more than ``HOT_CONTEXTS`` different contexts (the edges of a passage that is everywhere) is too much for one task;
its contexts are cut into their single windows, and step 3 is done again with those.

Texts are UTF-8 bytes; NULL is empty. Texts shorter than ``length`` stay. Rows with equal id and text are one document and
have equal results; rows with equal id and other text rank by hash of the text; NULL as id ranks first. An empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackspark.llm.bitmap import key_bitmap, may_hold
from trackspark.llm.common import runs, same, stored
from trackspark.llm.words import BASE, mix, powers, utf8

LENGTH = 100
GRAM = 48
HOT_CONTEXTS = 20_000
#: bytes of contexts that are merged at once, and of a shard of them
MERGE_BYTES = 1 << 20
SHARD_BYTES = 1 << 18
#: broadcast the table of repeated texts up to so many rows
BROADCAST_ROWS = 1_000_000
_PIECE_BITS = 20
_CONTEXT = "print long, doc_id long, text_hash long, at long, first long, n int, c1 long, c2 long"


def pieces(texts: pa.Array, length: int, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes end to end, where texts begin in them, which texts they are and at which byte of it they begin.

    A text above ``limit`` comes in pieces that overlap, so that each of its windows is in one piece.
    """
    data, offsets = utf8(texts)
    sizes = np.diff(offsets)
    small = np.flatnonzero((sizes >= length) & (sizes <= limit))
    i = 0
    while i < len(small):
        j = max(i + 1, int(np.searchsorted(np.cumsum(sizes[small[i:]]), limit, "right")) + i)
        part = small[i:j]
        yield (np.concatenate([data[offsets[d]:offsets[d + 1]] for d in part]), np.concatenate([[0], np.cumsum(sizes[part])]),
               part, np.zeros(len(part), np.int64))
        i = j
    for d in np.flatnonzero(sizes > limit):
        step = limit - length + 1
        for a in range(0, int(sizes[d]) - length + 1, step):
            b = min(int(sizes[d]), a + limit)
            yield data[offsets[d] + a:offsets[d] + b], np.asarray([0, b - a]), np.asarray([d]), np.asarray([a])


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per anchor: first window it serves, how many, where it is, its hash."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, 1 << _PIECE_BITS)[:n], out=sums[1:])
    hashes = mix((sums[gram:] - sums[:-gram]) * powers(pow(BASE, -1, 1 << 64), 1 << _PIECE_BITS)[:n - gram + 1])
    low = np.uint64((1 << _PIECE_BITS) - 1)
    least = (hashes & ~low) | (low - np.arange(len(hashes), dtype=np.uint64))
    width, have = length - gram + 1, 1
    while 2 * have <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < width:
        least = np.minimum(least[:len(least) - (width - have)], least[width - have:])
    inside = np.zeros(n + 1, np.int64)
    np.add.at(inside, offsets[:-1], 1)
    np.add.at(inside, offsets[1:] - length + 1, -1)
    start = np.flatnonzero(np.cumsum(inside)[:len(least)] > 0)
    at = (low - (least[start] & low)).astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    return start[first], np.diff(np.append(first, len(start))), at[first], hashes[at[first]]


def _prints(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in runs(batch, "text")):
            for data, offsets, _, _ in pieces(part.column("text"), length, 1 << (_PIECE_BITS - 1)):
                yield pa.RecordBatch.from_arrays([pa.array(anchors(data, offsets, length)[3].view(np.int64))], ["print"])
    return run


def _double_hash(data: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each run of bytes, by two polynomials."""
    out = []
    for base in (BASE, 0xC2B2AE3D27D4EB4F):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(0x9E3779B1)) * powers(base, 1 << _PIECE_BITS)[:len(data)], out=sums[1:])
        out.append(mix((sums[b] - sums[a]) * powers(pow(base, -1, 1 << 64), 1 << _PIECE_BITS)[a] + (b - a).astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def _contexts(length: int, bitmap, wanted=None):
    """Contexts of the anchors that the bitmap may hold; with their bytes only those that ``wanted`` may hold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in runs(batch, "text")):
            ids, hashes = part.column("doc_id"), part.column("text_hash")
            for data, offsets, docs, base in pieces(part.column("text"), length, 1 << (_PIECE_BITS - 1)):
                first, n, at, prints = anchors(data, offsets, length)
                keep = may_hold(bitmap.value, prints.view(np.int64))
                first, n, at, prints = first[keep], n[keep], at[keep], prints[keep]
                which = np.searchsorted(offsets, first, "right") - 1
                shift = base[which] - offsets[which]
                c1, c2 = _double_hash(data, first, first + n + length - 1)
                row = pa.array(docs[which])
                columns = [pa.array(prints.view(np.int64)), ids.take(row), hashes.take(row), pa.array(at + shift), pa.array(first + shift),
                           pa.array(n.astype(np.int32)), pa.array(c1), pa.array(c2)]
                names = ["print", "doc_id", "text_hash", "at", "first", "n", "c1", "c2"]
                if wanted is not None:
                    some = np.flatnonzero(may_hold(wanted.value, c1))
                    raw = data.tobytes()
                    bytes_ = [raw[a:b] for a, b in zip(first[some].tolist(), (first + n + length - 1)[some].tolist())]
                    columns = [*(c.take(pa.array(some)) for c in columns), pa.array(bytes_, pa.binary())]
                    names = [*names, "context"]
                yield pa.RecordBatch.from_arrays(columns, names)
    return run


def suffix_array(text: np.ndarray, to_end: np.ndarray) -> np.ndarray:
    """Order of the suffixes of strings laid end to end, each ending in 0 (symbols are 1 to 256).

    ``to_end`` is how far each position is from its string's end; equal suffixes are ordered by string. Prefix
    doubling from 7 symbols, each round only over what is not yet alone.
    """
    n, h = len(text), 7
    padded = np.concatenate([text, np.zeros(h, np.int64)])
    key = np.zeros(n, np.int64)
    for i in range(h):
        key = key << 9 | np.where(i < to_end, padded[i:i + n], 0)
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    edge = np.ones(n + 1, bool)
    edge[1:-1] = (sorted_key[1:] != sorted_key[:-1]) | (to_end[order][1:] < h)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(edge[:-1], np.arange(n), 0))
    while True:
        open_ = np.flatnonzero(~(edge[:-1] & edge[1:]))
        if not len(open_):
            return order
        at = order[open_]
        key = rank[at] * np.int64(n + 1) + rank[at + h]
        by = np.argsort(key, kind="stable")
        order[open_] = at[by]
        key = key[by]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        edge[open_] = new
        rank[order[open_]] = np.maximum.accumulate(np.where(new, open_, 0))
        h *= 2


def transform(strings: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A shard's Burrows-Wheeler transform by ``k`` symbols: per suffix, in order, the symbols before it (-1 where the string has
    fewer), the place of the suffix they begin, its string and its offset."""
    sizes = np.asarray([len(s) + 1 for s in strings])
    ends = np.cumsum(sizes) - 1
    text = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8).astype(np.int64) + 1
    text[ends] = 0
    string_of = np.repeat(np.arange(len(strings)), sizes)
    order = suffix_array(text, ends[string_of] - np.arange(len(text)))
    place = np.empty(len(text), np.int64)
    place[order] = np.arange(len(text))
    string = string_of[order]
    offset = order - (ends - sizes + 1)[string]
    symbols = np.zeros(len(text), np.int64)
    for i in range(k, 0, -1):
        symbols = symbols << 9 | text[order - i]
    return np.where(offset >= k, symbols, -1), place[order - k], string, offset


def repeated(strings: list[bytes], length: int = LENGTH, shard: int = SHARD_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All places where a string of ``length`` bytes begins that is in ``strings`` more than once: string, offset, number of its interval."""
    k = next(k for k in (4, 2, 1) if length % k == 0)
    cut = (np.cumsum([len(s) for s in strings]) - 1) // shard
    parts = []
    done = 0
    for part in np.unique(cut):
        members = np.flatnonzero(cut == part)
        s, b, t, o = transform([strings[i] for i in members], k)
        parts.append((s, b + done, t + members[0], o))
        done += len(s)
    symbols, back, string, offset = (np.concatenate(x) for x in zip(*parts))
    known, symbols = np.unique(symbols, return_inverse=True)
    symbols = symbols.astype(np.uint16 if len(known) < 1 << 16 else np.int32)
    none = int(known[0] == -1)  # the number of "fewer symbols", if there is one, is 0
    # the interleave starts as the shards one after the other, all in one interval
    now, interval = np.arange(done), np.zeros(done, np.int64)
    for _ in range(length // k):
        symbol = symbols[now]
        if none:
            inner = np.flatnonzero(symbol)
            now, interval, symbol = now[inner], interval[inner], symbol[inner]
        order = np.argsort(symbol, kind="stable")
        symbol, old = symbol[order], interval[order]
        edge = np.ones(len(order) + 1, bool)
        edge[1:-1] = (symbol[1:] != symbol[:-1]) | (old[1:] != old[:-1])
        shared = ~(edge[:-1] & edge[1:])
        now, interval = back[now[order[shared]]], np.cumsum(edge[:-1])[shared]
        if not len(now):
            break
    return string[now], offset[now], interval


def _spans(which: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive window starts of a row, as row, first byte and end."""
    order = np.lexsort((at, which))
    which, at = which[order], at[order]
    new = np.ones(len(at), bool)
    new[1:] = (which[1:] != which[:-1]) | (at[1:] > at[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return which[first], at[first], at[last] + length


def _merge(length: int):
    """Contexts sorted by anchor in, repeats of windows out; whole anchors are gathered up to ``MERGE_BYTES``."""
    def repeats(rows: list[tuple]) -> pa.RecordBatch:
        # earlier documents first; the windows of equal anchors compare as the anchors do
        rows.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        string, offset, interval = repeated([r[5] for r in rows], length)
        earliest = np.full(int(interval.max(initial=0)) + 1, len(rows))
        np.minimum.at(earliest, interval, string)
        late = string != earliest[interval]
        which, a, b = _spans(string[late], offset[late], length)
        ids = [rows[i] for i in which.tolist()]
        base = np.asarray([r[4] for r in ids], np.int64)
        return pa.RecordBatch.from_arrays([pa.array([r[1] for r in ids], pa.int64()), pa.array([r[2] for r in ids], pa.int64()),
                                           pa.array(base + a), pa.array(base + b)], ["doc_id", "text_hash", "begin", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held, now = 0, None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("print", "doc_id", "text_hash", "at", "first", "context"))):
                if row[0] != now and held >= MERGE_BYTES:
                    yield repeats(rows)
                    rows, held = [], 0
                now = row[0]
                rows.append(row)
                held += len(row[5])
        if rows:
            yield repeats(rows)
    return run


def _windows(length: int):
    """Contexts cut into their single windows, by hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in runs(batch, "context", 1 << (_PIECE_BITS - 1)):
                data, offsets = utf8(part.column("context"))
                n = np.asarray(part.column("n").to_pylist(), np.int64)
                row = np.repeat(np.arange(len(n)), n)
                inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                a = offsets[:-1][row] + inner
                c1, c2 = _double_hash(data, a, a + length)
                take = pa.array(row)
                first = part.column("first").take(take).to_numpy() + inner
                yield pa.RecordBatch.from_arrays([part.column("doc_id").take(take), part.column("text_hash").take(take), pa.array(first), pa.array(c1), pa.array(c2)],
                                                 ["doc_id", "text_hash", "first", "c1", "c2"])
    return run


def _place(at: str) -> Column:
    return F.struct("doc_id", "text_hash", F.col(at).alias("at"))


def find_repeats(docs: DataFrame, length: int = LENGTH, hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """Spans of bytes that go: doc_id, text_hash, begin, end. ``docs``: doc_id, text_hash, text, no equal texts twice."""
    spark = docs.sparkSession
    counted = docs.select("text").mapInArrow(_prints(length), "print long").groupBy("print").count()
    often = stored(counted.where("count > 1").select("print"), "prints")
    bitmap = spark.sparkContext.broadcast(key_bitmap(often))  # 16 MB at any size of the corpus
    found = stored(docs.mapInArrow(_contexts(length, bitmap), _CONTEXT), "contexts")
    # what stands for all equal contexts; combined in each task first
    classes = found.groupBy("c1", "c2").agg(F.min(_place("at")).alias("leader"), F.first("print").alias("print"))
    chosen = stored(classes, "classes")
    late = (found.select("c1", "c2", "doc_id", "text_hash", "at", "first", "n").join(chosen.select("c1", "c2", "leader"), ["c1", "c2"])
            .where(~same(_place("at"), F.col("leader")))
            .select("doc_id", "text_hash", F.col("first").alias("begin"), (F.col("first") + F.col("n") + (length - 1)).alias("end")))
    several = stored(chosen.groupBy("print").count().where("count > 1").select("print", F.col("count").alias("different")), "several")
    leaders = stored(chosen.join(several, "print").select("c1", "c2", "leader", "different"), "leaders")
    wanted = spark.sparkContext.broadcast(key_bitmap(leaders.select("c1")))
    mixed = stored(docs.mapInArrow(_contexts(length, bitmap, wanted), _CONTEXT + ", context binary").join(leaders, ["c1", "c2"])
                   .where(same(_place("at"), F.col("leader"))).drop("leader", "c1", "c2"), "mixed")
    columns = ["print", "doc_id", "text_hash", "at", "first", "context"]
    merged = (mixed.where(F.col("different") <= hot_contexts).select(*columns).repartition("print").sortWithinPartitions("print")
              .mapInArrow(_merge(length), "doc_id long, text_hash long, begin long, end long"))
    out = late.unionByName(merged)
    if several.where(F.col("different") > hot_contexts).isEmpty():
        return out
    windows = stored(mixed.where(F.col("different") > hot_contexts).select("doc_id", "text_hash", "first", "n", "context")
                     .mapInArrow(_windows(length), "doc_id long, text_hash long, first long, c1 long, c2 long"), "windows")
    first = windows.groupBy("c1", "c2").agg(F.min(_place("first")).alias("leader"), F.count("*").alias("k")).where("k > 1").drop("k")
    again = (windows.join(first, ["c1", "c2"]).where(~same(_place("first"), F.col("leader")))
             .select("doc_id", "text_hash", F.col("first").alias("begin"), (F.col("first") + length).alias("end")))
    return out.unionByName(again)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in runs(whole, "text")):
        rows = []
        for data, whole, spans in zip(*(batch.column(c).to_pylist() for c in ("text", "whole", "spans"))):
            data = (data or "").encode()
            spans = [{"begin": 0, "end": len(data)}] if whole else spans or []
            runs_, upto, kept, at = 0, -1, [], 0
            for s in sorted((s["begin"], s["end"]) for s in spans):
                if s[0] > upto:
                    runs_ += 1
                    kept.append(data[at:s[0]])
                upto = max(upto, s[1])
                at = upto
            kept.append(data[at:])
            left = b"".join(kept)
            rows.append((len(data), len(data) - len(left), runs_, hashlib.sha256(left).hexdigest(), left))
        columns = list(zip(*rows)) if rows else [()] * 5
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())))],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def dedup_substrings(docs: DataFrame, length: int = LENGTH, hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (bytes)."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    base = base.withColumns({"text_hash": F.xxhash64("text"), "sha": F.when(F.octet_length("text") >= length, F.unhex(F.sha2("text", 256)))})
    copies = stored(base.where("sha is not null").groupBy("sha").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"),
                                                                    F.count(F.when(F.col("doc_id").isNull(), 1)).alias("unnamed")).where("n > 1")
                    .select(F.col("sha").alias("copied"), F.when(F.col("unnamed") == 0, F.col("first")).alias("first")), "copies")
    small = copies.count() <= BROADCAST_ROWS
    marked = base.join(F.broadcast(copies) if small else copies, base["sha"] == copies["copied"], "left")
    whole = F.col("copied").isNotNull() & ~same(F.col("doc_id"), F.col("first"))
    # of a row that is there several times one stands for all; only texts that have copies are looked through for that
    apart = marked.where(F.col("sha").isNotNull() & ~whole)
    once = apart.where("copied is null").unionByName(apart.where("copied is not null").dropDuplicates(["doc_id", "text_hash"]))
    spans = find_repeats(once.select("doc_id", "text_hash", "text"), length, hot_contexts)
    by_doc = (spans.groupBy(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"))
              .agg(F.collect_set(F.struct("begin", "end")).alias("spans")))  # a document's own spans
    return (marked.withColumn("whole", whole).join(by_doc, same(F.col("doc_id"), F.col("d")) & (F.col("text_hash") == F.col("h")), "left")
            .select("doc_id", "text", "whole", "spans")
            .mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"))
