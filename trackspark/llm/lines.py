"""Substring dedup by hashing lines, with long lines cut at sentence ends.

A unit is what stands between line ends and sentence ends (. ! ?), with the marks and blanks after
it, so that the units of a text put together are the text. It is normalised (A-Z lower-cased,
everything but letters and digits is one blank) and digested to 128 bits. Digests of units of at least
``min_words`` words are grouped globally; the earliest occurrence, by doc_id, then text, then
position, stays and all others go. The result retains where in the original text the removed units were.

Units are found and digested in tasks, over runs of texts of bounded size, in time linear in the text. What is shuffled
are digests and unit numbers; the texts meet only the numbers of their own units that go.

NULL and empty texts have no units. Shorter units always stay: the least length of a unit is part of what the operator
compares, ``min_words=1`` compares all with a word. NULL as doc_id ranks before all others. Equal
rows rank as one document: each keeps what one would keep. Very long texts are worked on alone. An empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackspark.llm.common import runs, same, stored
from trackspark.llm.words import ALNUM, find_words, mix, utf8

#: A unit as a regular expression: body, marks and line ends, blanks; or marks where there is no body.
UNIT = r"[^.!?\n]+[.!?\n]*[ \t\n]*|[.!?\n]+[ \t\n]*"
MIN_WORDS = 5
_MARK = np.isin(np.arange(256), [ord(c) for c in ".!?"])
_BLANK = np.isin(np.arange(256), [ord(c) for c in " \t"])
_LINE_END = np.arange(256) == ord("\n")


def _last(flags: np.ndarray) -> np.ndarray:
    """For each position the last one before it that has the flag, else -1."""
    at = np.where(flags, np.arange(len(flags)), -1)
    out = np.empty(len(at), np.int64)
    if len(at):
        out[0], out[1:] = -1, np.maximum.accumulate(at)[:-1]
    return out


def unit_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """First bytes of all units of texts that lie end to end.

    A text begins one. Inside, a unit ends where, after marks or line ends, something comes that is neither blank nor of
    these, or where, after marks or line ends and then blanks, another mark comes.
    """
    n = len(data)
    mark, blank, line = _MARK[data], _BLANK[data], _LINE_END[data]
    body = ~(mark | blank | line)
    first = np.zeros(n, bool)
    first[offsets[:-1][offsets[1:] > offsets[:-1]]] = True
    # positions before a text's own begin do not count for it
    begin = np.repeat(offsets[:-1], np.diff(offsets))
    last_body, last_mark = _last(body), _last(mark)
    last_line, last_blank = _last(line), _last(blank)
    # a body byte after a mark or line end that came since the last body byte
    since = np.maximum(last_body, begin - 1)
    starts = body & (np.maximum(last_mark, last_line) > since)
    # a mark after a blank that came after a mark or line end since the last body byte
    ended = np.maximum(last_mark, since)
    after_mark = last_mark > since
    # the first line end after the last body byte, which ends the body like a mark does
    upcoming = np.full(n + 1, n, np.int64)
    if n:
        upcoming[:n] = np.minimum.accumulate(np.where(line, np.arange(n), n)[::-1])[::-1]
    opened = np.where(after_mark, ended, upcoming[np.minimum(since + 1, n)])
    starts |= mark & (last_blank > opened)
    return np.flatnonzero(starts | first)


def units(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Units worth comparing of rows (doc_id, text_hash, text): doc_id, text_hash, unit number, and two 64-bit digests."""
    least = max(1, min_words)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in runs(batch, "text")):
            words = find_words(part.column("text"), ALNUM)
            starts = unit_starts(words.data, words.offsets)
            unit = np.searchsorted(starts, words.start, "right") - 1
            first = np.flatnonzero(np.diff(unit, prepend=-1))
            size = np.diff(np.append(first, len(unit)))
            digests = []
            for factor in (0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F):
                digests.append(_digest(words.hash, first, size, factor))
            keep = size >= least
            which = unit[first[keep]]
            doc = np.searchsorted(words.offsets, starts[which], "right") - 1
            number = which - np.searchsorted(starts, words.offsets[doc])
            take = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(take), part.column("text_hash").take(take), pa.array(number.astype(np.int32)),
                 *(pa.array(d[keep].view(np.int64)) for d in digests)], ["doc_id", "text_hash", "unit", "d1", "d2"])

    return docs.select("doc_id", "text_hash", "text").mapInArrow(work, "doc_id long, text_hash long, unit int, d1 long, d2 long")


def _digest(words: np.ndarray, first: np.ndarray, size: np.ndarray, factor: int) -> np.ndarray:
    """A hash of each run of word hashes, with the place of each word in it."""
    if not len(first):
        return np.zeros(0, np.uint64)
    place = (np.arange(len(words)) - np.repeat(first, size)).astype(np.uint64)
    spread = mix(words * np.uint64(factor | 1) + mix(place + np.uint64(factor)))
    return mix(np.add.reduceat(spread, first) + size.astype(np.uint64))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for part in (p for batch in batches for p in runs(batch, "text")):
        data, offsets = utf8(part.column("text"))
        starts = unit_starts(data, offsets)
        edges = np.append(starts, len(data))
        # characters before each byte: bytes that do not continue one
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        bounds = np.searchsorted(starts, offsets)
        n_units, removed, kept = np.diff(bounds), [], []
        for i, gone in enumerate(part.column("gone").to_pylist()):
            raw = data[offsets[i]:offsets[i + 1]].tobytes()
            if not gone:
                removed.append([])
                kept.append(raw)
                continue
            at = bounds[i] + np.sort(np.asarray(gone, np.int64))
            base = int(offsets[i])
            spans = chars[edges[at]] - chars[base], chars[edges[at + 1]] - chars[base]
            removed.append([{"start": a, "end": b} for a, b in zip(*(x.tolist() for x in spans))])
            cuts = np.stack([edges[at], edges[at + 1]], 1).ravel() - base
            cuts = [0, *cuts.tolist(), len(raw)]
            kept.append(b"".join(raw[a:b] for a, b in zip(cuts[::2], cuts[1::2])))
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n_units, pa.int64()), pa.array(removed, span),
                                          pa.array([k.decode() for k in kept], pa.string())], ["doc_id", "n_units", "removed", "kept"])


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: doc_id, n_units, removed (structs of start and end, in characters), kept text."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    base = base.withColumn("text_hash", F.xxhash64("text"))
    found = stored(units(base, min_words), "units")
    place = F.struct("doc_id", "text_hash", "unit")
    # one row per digest and task before the shuffle, however often a line occurs
    repeated = (found.groupBy("d1", "d2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
                .select("d1", "d2", "first"))
    gone = (found.join(repeated, ["d1", "d2"]).where(~same(place, F.col("first")))
            .groupBy(F.col("doc_id").alias("d"), F.col("text_hash").alias("h")).agg(F.collect_set("unit").alias("gone")))
    joined = base.join(gone, same(base["doc_id"], gone["d"]) & (base["text_hash"] == gone["h"]), "left")
    return joined.select("doc_id", "text", "gone").mapInArrow(
        _cut, "doc_id long, n_units long, removed array<struct<start:int,end:int>>, kept string")
