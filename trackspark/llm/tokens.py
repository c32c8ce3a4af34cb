"""Token ids in binary shards with a minimal perfect hash index.

Documents are range-sorted by doc_id (equal ids by hash of the text), encoded, and written as shards of
about ``shard_bytes``. A shard file is

    ids        little-endian, 2 bytes each if the vocabulary allows it, else 4
    table      per document where its ids begin (8 bytes each, one more for the end), its key (8), whether the key is NULL (1)
    index      displacements (4 bytes per bucket), then per slot a fingerprint of its key and a document number (4 + 4)
    footer     counts, width, and the shard's place: range partition and number in it

The index is a minimal perfect hash of the shard's distinct keys by hash and displace: a key's bucket has
a displacement, and with it the key falls on a slot of its own, or, in buckets of one key, the slot itself is
stored. The fingerprint in the slot tells keys that are not in the shard (but for 1 in 2^32). A key that is repeated
leads to its first document; its others follow. Spark's text writer writes one shard per file, ended by its line separator.

Encoding: texts are cut at blanks and line ends, which no token spans, and each distinct word of a task is encoded once
by the tokenizer; what a task knows of words is forgotten above ``KNOWN_BYTES``. Words of plain letters (ASCII and
Latin-1) skip its normaliser and splitter, which only lower-case them; ASCII marks that follow them, other than
apostrophes, are encoded apart, as the splitter does.

NULL and empty texts have the end id alone. NULL as doc_id sorts first; such rows are in the table but have no key in the
index. Rows that repeat an id each have an entry. Empty tables write no shard. Other columns are not read.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackspark.llm.common import bound_batches, give_back, running_total, runs, stored
from trackspark.llm.words import mix

END_ID = 1
SHARD_BYTES = 4 << 20
#: bytes of text whose distinct words are encoded together
WORDS_FROM = 2 << 20
#: bytes of words and their ids that a task keeps; above it, they are forgotten before the next texts
KNOWN_BYTES = 16 << 20
#: words that the tokenizer gets at once
_AT_ONCE = 1000
#: marks that the splitter parts from letters before them; an apostrophe may begin a piece with letters
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: buckets that search alone once so few are left, and the seeds each tries at once
_STUBBORN, _SEEDS = 200, 256
#: letters of the Latin-1 block: in composed form, and what lower-casing makes of them
_LATIN = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_LATIN_LOWER = "\u00df-\u00f6\u00f8-\u00ff"
_LETTERS = "".join(c for c in map(chr, range(256)) if re.match(f"[A-Za-z{_LATIN}]", c))
_SEPARATOR = "\nSHARD\n"
_FOOTER = "<QIIIIIB7s"
_MAGIC = b"IDSHRD1"


@lru_cache(maxsize=1)
def _tokenizers(described: str) -> tuple:
    """The tokenizer, one of its model that only cuts at blanks, and which ids end a word.

    A worker keeps them for its next tasks: megabytes stay in the process with each tokenizer that has encoded and is deleted.
    """
    from tokenizers import Tokenizer, pre_tokenizers

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    full = Tokenizer.from_str(described)
    plain = Tokenizer(full.model)
    plain.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    vocab = full.get_vocab()
    ends = np.zeros(max(vocab.values(), default=0) + 1, bool)
    ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
    return full, plain, ends


class Encoder:
    """Encodes many texts, each distinct word once while it is among the known ones."""

    def __init__(self, tokenizer: str, end_id: int = END_ID, known_bytes: int = KNOWN_BYTES):
        self.full, self.plain, self.ends = _tokenizers(tokenizer)
        self.width = 2 if len(self.ends) <= 1 << 16 and end_id < 1 << 16 else 4
        self.end_id = end_id
        self.known_bytes = known_bytes
        self._forget()

    def _forget(self) -> None:
        """Words known, their ids end to end, and where each word's begin."""
        self.known, self.pool, self.begin = pa.array([], pa.string()), np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, each with the end id, and where each text's begin."""
        flat = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        if isinstance(flat, pa.ChunkedArray):
            flat = flat.combine_chunks()
        words = flat.flatten().dictionary_encode()
        bounds = flat.offsets.to_numpy().astype(np.int64) - flat.offsets[0].as_py()
        which, names = words.indices.to_numpy(zero_copy_only=False), words.dictionary
        del flat, words  # the texts' words, before those of them that are new are encoded
        pool, begin = self._words(names)
        size = np.append(np.diff(begin), 1)
        pool, begin = np.append(pool, np.uint32(self.end_id)), begin  # the end id is one word more
        out, total = [], [0]
        for i in range(0, len(texts), 500):
            j = min(len(texts), i + 500)
            part = np.insert(which[bounds[i]:bounds[j]], bounds[i + 1:j + 1] - bounds[i], len(size) - 1)
            out.append(_ragged(pool, begin[part], size[part]).astype(np.uint16 if self.width == 2 else np.uint32))
            upto = np.cumsum(size[part])
            total += (total[-1] + upto[bounds[i + 1:j + 1] - bounds[i] + np.arange(j - i)]).tolist()
        return np.concatenate(out) if out else np.zeros(0, np.uint32), np.asarray(total)

    def _words(self, names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words end to end, and where each word's begin."""
        base = pc.utf8_rtrim(names, _MARKS)
        plain = pc.match_substring_regex(base, f"^[A-Za-z{_LATIN}]+$")
        # only words of plain letters are lower-cased and parted from the marks after them here
        keys = pc.if_else(plain, pc.utf8_lower(base), names)
        tails = pc.if_else(plain, pc.utf8_ltrim(names, _LETTERS), "")
        both = pa.concat_arrays([keys, tails]).dictionary_encode()
        if self.known.nbytes + self.pool.nbytes + self.begin.nbytes > self.known_bytes:
            self._forget()
        places = self._places(both.dictionary)[both.indices.to_numpy(zero_copy_only=False).reshape(2, -1).T]
        sizes = np.diff(self.begin)[places]
        return _ragged(self.pool, self.begin[places].ravel(), sizes.ravel()), np.concatenate([[0], np.cumsum(sizes.sum(1))])

    def _places(self, words: pa.Array) -> np.ndarray:
        """Numbers of distinct words among the known ones; the tokenizer encodes those that are new."""
        self.known = self.known.cast(words.type)
        at = pc.index_in(words, value_set=self.known)
        new = pc.is_null(at)
        unseen = words.filter(new)
        at = pc.fill_null(at, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        if len(unseen):
            at[new.to_numpy(zero_copy_only=False)] = len(self.known) + np.arange(len(unseen))
            ids, size = self._distinct(unseen)
            self.begin = np.append(self.begin, self.begin[-1] + np.cumsum(size))
            self.pool = np.append(self.pool, ids)
            self.known = pa.concat_arrays([self.known, unseen])
        return at

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        letters = pc.match_substring_regex(words, f"^[a-z{_LATIN_LOWER}]+$").to_numpy(zero_copy_only=False)
        plain = words.filter(pa.array(letters))
        cuts = pa.array([*range(0, len(plain), _AT_ONCE), len(plain)], pa.int32())
        joined = pc.binary_join(pa.ListArray.from_arrays(cuts, plain), " ")
        got = [np.asarray(e.ids, np.uint32) for text in joined for e in self.plain.encode_batch_fast([text.as_py()], add_special_tokens=False)]
        ids = np.concatenate(got or [np.zeros(0, np.uint32)])
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) != len(plain):
            raise ValueError("the tokenizer does not mark the ends of words")
        others = words.filter(pa.array(~letters))
        rest, lengths = [np.zeros(0, np.uint32)], []
        for i in range(0, len(others), _AT_ONCE):
            part = [e.ids for e in self.full.encode_batch_fast(others.slice(i, _AT_ONCE).to_pylist(), add_special_tokens=False)]
            rest.append(np.fromiter((x for r in part for x in r), np.uint32))
            lengths += map(len, part)
        other = np.concatenate(rest)
        size = np.zeros(len(words), np.int64)
        size[letters] = np.diff(np.concatenate([[0], cuts]))
        size[~letters] = lengths
        start = np.zeros(len(words), np.int64)
        start[letters] = np.concatenate([[0], cuts])[:-1]
        start[~letters] = len(ids) + np.cumsum(size[~letters]) - size[~letters]
        return _ragged(np.concatenate([ids, other]), start, size), size


def _ragged(pool: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Runs of ``pool``, one after the other."""
    upto = np.cumsum(size)
    return pool[np.repeat(start - (upto - size), size) + np.arange(upto[-1] if len(upto) else 0)]


def _hash(keys: np.ndarray, seed: int) -> np.ndarray:
    return mix(keys.astype(np.int64).view(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))


def minimal_perfect_hash(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Displacements and the slot of each of the distinct ``keys``: slots are 0 to n - 1, each once.

    Buckets are placed from the largest size down, all of one size together: each round tries one
    seed for all that are left and places those that fit. Few stubborn buckets try many seeds at once.
    Buckets of one key take what is free.
    """
    n = len(keys)
    buckets = max(1, n // 4)
    place = (_hash(keys, 0) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(place, kind="stable")
    cuts = np.searchsorted(place[order], np.arange(buckets + 1))
    size = np.diff(cuts)
    moves, slots, free = np.zeros(buckets, np.int32), np.zeros(n, np.int64), np.ones(n, bool)
    for width in range(int(size.max(initial=0)), 1, -1):
        left = np.flatnonzero(size == width)
        members = order[cuts[left][:, None] + np.arange(width)]  # keys of each bucket, a row for each
        seed = 1
        while len(left) > _STUBBORN:
            at = (_hash(keys[members.ravel()], seed) % np.uint64(n)).astype(np.int64).reshape(members.shape)
            fits = np.flatnonzero(_apart(at) & free[at].all(axis=1))
            # where two buckets want one slot, the first gets it; the other tries on
            owner = np.full(n, len(left))
            np.minimum.at(owner, at[fits].ravel(), np.repeat(fits, width))
            fits = fits[(owner[at[fits]] == fits[:, None]).all(axis=1)]
            moves[left[fits]], slots[members[fits]], free[at[fits]] = seed, at[fits], False
            rest = np.ones(len(left), bool)
            rest[fits] = False
            left, members, seed = left[rest], members[rest], seed + 1
        for b, own in zip(left, members):
            first = 1
            while True:
                seeds = np.arange(first, first + _SEEDS, dtype=np.uint64)[:, None]
                at = (mix(keys[own].astype(np.int64).view(np.uint64) + (seeds + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
                      % np.uint64(n)).astype(np.int64)
                good = np.flatnonzero(_apart(at) & free[at].all(axis=1))
                if len(good):
                    break
                first += _SEEDS
            moves[b], slots[own], free[at[good[0]]] = first + good[0], at[good[0]], False
    single = np.flatnonzero(size == 1)
    at = np.flatnonzero(free)
    moves[single], slots[order[cuts[single]]] = -at - 1, at
    return moves, slots


def _apart(at: np.ndarray) -> np.ndarray:
    """Rows whose entries all differ."""
    ordered = np.sort(at, axis=1)
    return (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)


class Shard:
    """One shard's bytes; ``get`` finds a key's document in constant time."""

    def __init__(self, data: bytes):
        end = len(data) - len(_SEPARATOR)
        (self.n_ids, self.n_docs, self.n_keys, self.n_buckets, self.part, self.number, self.width,
         magic) = struct.unpack_from(_FOOTER, data, end - struct.calcsize(_FOOTER))
        if magic != _MAGIC or data[end:] != _SEPARATOR.encode():
            raise ValueError("not a shard")
        self._at = 0
        self._data = data
        self.ids = self._take(f"<u{self.width}", self.n_ids)
        self.begin = self._take("<u8", self.n_docs + 1).astype(np.int64)
        self.keys = self._take("<i8", self.n_docs)
        self.missing = self._take("u1", self.n_docs).astype(bool)
        self.moves = self._take("<i4", self.n_buckets)
        self.prints = self._take("<u4", self.n_keys)
        self.numbers = self._take("<u4", self.n_keys)

    def _take(self, kind: str, n: int) -> np.ndarray:
        out = np.frombuffer(self._data, kind, n, self._at)
        self._at += out.nbytes
        return out

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of the first documents of the keys, -1 where the shard has none."""
        if not self.n_keys:
            return np.full(len(keys), -1)
        moves = self.moves[(_hash(keys, 0) % np.uint64(self.n_buckets)).astype(np.int64)]
        slots = np.where(moves < 0, -moves.astype(np.int64) - 1, 0)
        for seed in np.unique(moves[moves >= 0]).tolist():
            these = moves == seed
            slots[these] = (_hash(keys[these], seed) % np.uint64(self.n_keys)).astype(np.int64)
        fits = self.prints[slots] == _fingerprint(keys)
        return np.where(fits, self.numbers[slots].astype(np.int64), -1)

    def get(self, key: int) -> np.ndarray | None:
        number = int(self.find(np.asarray([key]))[0])
        return None if number < 0 else self.ids[self.begin[number]:self.begin[number + 1]]


def _fingerprint(keys: np.ndarray) -> np.ndarray:
    return (_hash(keys, -2) >> np.uint64(32)).astype(np.uint32)


def shard_bytes(ids: np.ndarray, sizes: np.ndarray, keys: np.ndarray, missing: np.ndarray, part: int, number: int, width: int) -> bytes:
    distinct, first = np.unique(keys[~missing], return_index=True)
    numbers = np.flatnonzero(~missing)[first]
    moves, slots = minimal_perfect_hash(distinct) if len(distinct) else (np.zeros(0, np.int32), np.zeros(0, np.int64))
    prints, at = np.zeros(len(distinct), "<u4"), np.zeros(len(distinct), "<u4")
    prints[slots], at[slots] = _fingerprint(distinct), numbers
    begin = np.concatenate([[0], np.cumsum(sizes)]).astype("<u8")
    return b"".join([ids.astype(f"<u{width}").tobytes(), begin.tobytes(), keys.astype("<i8").tobytes(), missing.astype("u1").tobytes(),
                     moves.astype("<i4").tobytes(), prints.tobytes(), at.tobytes(),
                     struct.pack(_FOOTER, len(ids), len(keys), len(distinct), len(moves), part, number, width, _MAGIC)])


def write_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, limit: int = SHARD_BYTES) -> None:
    """Encode ``docs`` with the tokenizer file ``tokenizer`` and write shards below ``path``."""
    bound_batches(docs.sparkSession)
    described = Path(tokenizer).read_text()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, number = Encoder(described, end_id), TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        size = 0

        def shard() -> pa.RecordBatch:
            data = shard_bytes(*(np.concatenate(x) for x in zip(*held)), part, number, encoder.width)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["shard"])
        for batch in batches:
            for piece in runs(batch, "text", WORDS_FROM):
                ids, begin = encoder.encode(piece.column("text"))
                key = piece.column("doc_id")
                held.append((ids, np.diff(begin), pc.fill_null(key, 0).to_numpy(zero_copy_only=False), key.is_null().to_numpy(zero_copy_only=False)))
                size += len(ids) * encoder.width
                if size >= limit:
                    yield shard()
                    size, number = 0, number + 1
                give_back()
        if held:
            yield shard()
        del encoder  # all that a task's words took
        give_back()
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    sorted_docs = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                   .repartitionByRange(*order).sortWithinPartitions(*order))
    (sorted_docs.mapInArrow(run, "shard binary").select(F.col("shard").cast("string").alias("shard"))
     .write.option("lineSep", _SEPARATOR).option("maxRecordsPerFile", 1).text(path))


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """One row per document, found through the index: doc_id, start (ids before it), n_tokens, ids_crc32."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                data = content.as_py()
                if data:
                    yield _entries(Shard(data))
            give_back()
    rows = stored(spark.read.format("binaryFile").load(path).select("content")
                  .mapInArrow(run, "part int, number int, doc_id long, at long, n_tokens long, ids_crc32 long"), "entries")
    shards = rows.groupBy("part", "number").agg(F.sum("n_tokens").alias("n"))
    starts = running_total(shards, ["part", "number"], "n", "upto").select("part", "number", (F.col("upto") - F.col("n")).alias("before"))
    return rows.join(starts, ["part", "number"]).select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def _entries(shard: Shard) -> pa.RecordBatch:
    known = ~shard.missing
    first = shard.find(shard.keys[known])
    if (first < 0).any() or (shard.keys[first] != shard.keys[known]).any() or (first > np.flatnonzero(known)).any():
        raise ValueError("the index does not lead to its documents")
    # a repeated key leads to its first document, the others follow it
    number = np.arange(shard.n_docs)
    wide = memoryview(shard.ids.astype("<u4").tobytes())
    begin = shard.begin
    crc = [zlib.crc32(wide[4 * begin[i]:4 * begin[i + 1]]) for i in number]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(shard.n_docs, shard.part, np.int32)), pa.array(np.full(shard.n_docs, shard.number, np.int32)),
         pa.array(shard.keys, mask=shard.missing), pa.array(begin[:-1]), pa.array(np.diff(begin)), pa.array(np.asarray(crc, np.int64))],
        ["part", "number", "doc_id", "at", "n_tokens", "ids_crc32"])
