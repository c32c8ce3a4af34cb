"""N-gram Jaccard join: which documents share at least 9 of 10 of their word shingles.

The join is a blocked product of the sparse incidence matrix of documents by shingles, cut down by what
sizes imply. Documents with equal sets are one row of it. For the smaller of two linked sets, of size s, the
sets differ in at most d = s * (1 - t) / t shingles. Shingles are dealt by hash over parts, more than d of them; some parts
are then equal in both. A part is keyed by the hash of its shingles. Parts of few shingles are
left out where a document has more than d others, as one of those must be equal too; else all of them stay. For low bounds,
where parts are small, shingles of passages that many documents share are found first and left out of the keys in the same way.
Sizes are put into classes, and a document is keyed for its own class and for that of the least size it may be linked with.

Documents that share a key are candidates (keys are shuffled once and not written down), and connected candidates are put into blocks of bounded size in order of size.
Two blocks whose sizes can be linked at all are multiplied: shingles of many documents by dense blocks of columns, the others pair by
pair, and overlaps below the bound that sizes give are dropped. A product gives back at most one row per document, a
forest over its links; those make the components. Keys only propose: counts are of the shingles' 64-bit hashes.

A set is the distinct runs of 3 words ``[^\\x20\\x09-\\x0D]+`` (A-Z lower-cased) of the whole text; with fewer words the
whole sequence. NULL and empty texts have an empty set and link with nothing. Rows with NULL as doc_id are counted but
linked with nothing. Rows that repeat an id are one document for linking, connected with what any of them is. An empty
table gives no rows; other columns are not read. The work within a near-copy group that stays unlinked grows with the square
of its rows; it is cut into block pairs, and no more rows than documents per pair come out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackspark.llm.bitmap import key_bitmap, may_hold
from trackspark.llm.common import give_back, running_total, runs, stored
from trackspark.llm.components import components, join_sets
from trackspark.llm.words import NOT_SPACE, find_words, grams, mix

#: shingles counted so often in batches that hold them twice are common, where parts are small
COMMON = 10
#: bytes of text that are looked at together for these
REPEATS_FROM = 8 << 20
#: a size class ends at so many times its least size
CLASS_RATIO = 1.25
BLOCK_WEIGHT = 1 << 18
LEAST_WEIGHT = 512
#: keys that are looked at together, keys of a bucket and of a shuffled row, and most partitions of that shuffle
KEYS_FROM = 1 << 18
BUCKET_KEYS = 1 << 19
PACK_KEYS = 128
MOST_PARTITIONS = 20_000
#: rows of block pairs that are broadcast at a time
BROADCAST_ROWS = 1_000_000


@dataclass(frozen=True)
class Overlap:
    """Linked: ``den * |intersection| >= num * |union|``."""

    num: int = 90
    den: int = 100

    @property
    def thin(self) -> int:
        """Least shingles of a part that is keyed in any case: about a third of what a part has."""
        return max(1, self.num // (self.den - self.num) // 3)

    def linked(self, overlap: np.ndarray, total: np.ndarray) -> np.ndarray:
        return self.den * overlap >= self.num * (total - overlap)

    def differing(self, size: int) -> int:
        """Most shingles in which a set of ``size`` differs from one at least as large it is linked with."""
        return size * (self.den - self.num) // self.num

    def least_partner(self, size: int) -> int:
        return -(-size * self.num // self.den)


def shingle_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = find_words(texts, NOT_SPACE)
    counts = words.counts()
    ends = np.cumsum(counts)
    hashes = grams(words.hash, n)
    out = []
    for a, b in zip((ends - counts).tolist(), ends.tolist()):
        if b - a >= n:
            out.append(np.unique(hashes[a:b - n + 1]))
        elif b > a:  # few words: the whole sequence, apart from all longer ones
            short = np.concatenate([words.hash[a:b], np.zeros(n - (b - a), np.uint64)])
            out.append(mix(grams(short, n) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _classes(size: int) -> tuple[int, int]:
    """Number of the class of a size, and the largest size in it."""
    number, top = 0, 8
    while size > top:
        number, top = number + 1, max(top + 1, int(top * CLASS_RATIO))
    return number, top


def part_keys(shingles: np.ndarray, rule: Overlap, common: np.ndarray | None = None) -> np.ndarray:
    """Keys of a set, of which two linked sets share one unless they are equal.

    ``common`` marks shingles that are left out of the keys (the same ones for every set) as long as enough parts remain.
    """
    size = len(shingles)
    if not size:
        return np.zeros(0, np.uint64)
    rare = shingles if common is None else shingles[~common]
    wanted = {_classes(size), _classes(rule.least_partner(size))}
    out = []
    for number, top in sorted(wanted):
        d = rule.differing(top)
        if d == 0:
            continue  # sets this small are linked only if equal
        keys, thick = _parts(rare, d, number, rule.thin)
        if common is not None:
            out.append(keys[thick])
            if thick.sum() > d:
                continue
            keys, thick = _parts(shingles, d, number + (1 << 16), rule.thin)
        out.append(keys[thick] if thick.sum() > d else keys)
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _parts(shingles: np.ndarray, d: int, salt: int, thin: int) -> tuple[np.ndarray, np.ndarray]:
    """A key per part, and which parts hold at least ``thin`` shingles."""
    parts = d + 1 + d // 4
    place = ((shingles >> np.uint64(20)) % np.uint64(parts)).astype(np.int64)
    sums, counts = np.zeros(parts, np.uint64), np.bincount(place, minlength=parts)
    np.add.at(sums, place, mix(shingles + np.uint64(1)))
    return mix(sums + mix(np.arange(parts, dtype=np.uint64) + np.uint64(salt << 32))), counts >= thin


def _repeats(n: int):
    """Shingles that several of the texts looked at together hold, with how many."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in (part for batch in batches for part in runs(batch, "text", REPEATS_FROM)):
            sets = [s for part in runs(some, "text") for s in shingle_sets(part.column("text"), n)]
            shingles, counts = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            twice = counts > 1
            yield pa.RecordBatch.from_arrays([pa.array(shingles[twice].view(np.int64)), pa.array(counts[twice])], ["shingle", "n"])
    return run


def _sized(n: int):
    """Size and two 64-bit sums of each text's set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in runs(batch, "text"):
                sets = shingle_sets(part.column("text"), n)
                one, other = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
                for i, s in enumerate(sets):
                    one[i], other[i] = mix(s).sum(), mix(s ^ np.uint64(0x5555555555555555)).sum()
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.asarray([len(s) for s in sets], np.int64)), pa.array(one.view(np.int64)),
                     pa.array(other.view(np.int64))], ["doc_id", "n", "one", "other"])
    return run


def _keyed(n: int, rule: Overlap, common):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in runs(batch, "text"):
                sets = shingle_sets(part.column("text"), n)
                one, other = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
                keys = []
                for i, s in enumerate(sets):
                    one[i], other[i] = mix(s).sum(), mix(s ^ np.uint64(0x5555555555555555)).sum()
                    known = may_hold(common.value, s.view(np.int64)) if common is not None else None
                    keys.append(part_keys(s, rule, known).view(np.int64))
                size = np.asarray([len(k) for k in keys])
                offsets = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
                flat = pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.asarray([len(s) for s in sets], np.int64)), pa.array(one.view(np.int64)),
                     pa.array(other.view(np.int64)), pa.ListArray.from_arrays(offsets, flat)], ["doc_id", "n", "one", "other", "keys"])
    return run


def _ends(keys: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key with the least and, if that is another, the greatest of its sets."""
    order = np.lexsort((ones, keys))
    keys, ones = keys[order], ones[order]
    first = np.append(True, keys[1:] != keys[:-1])[:len(keys)]
    last = np.append(first[1:], True)[:len(keys)]
    starts = np.flatnonzero(first)
    keep = first | (last & (ones != ones[starts][np.cumsum(first) - 1]))
    return keys[keep], ones[keep]


def _forest(keys: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sets that share a key with another, each with the least set it is connected with so."""
    order = np.lexsort((ones, keys))
    keys, ones = keys[order], ones[order]
    several = np.flatnonzero(keys[1:] == keys[:-1])
    several = several[ones[several] != ones[several + 1]]
    nodes, roots = join_sets(ones[several], ones[several + 1]) if len(several) else (ones[:0], ones[:0])
    far = nodes != roots
    return nodes[far], roots[far]


def _key_slices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys of a batch with the sets that have them, at most ``KEYS_FROM`` at a time."""
    lists, ones = batch.column("keys"), batch.column("one").to_numpy()
    offsets, keys = lists.offsets.to_numpy(), lists.values.to_numpy()
    for a in range(int(offsets[0]), int(offsets[-1]), KEYS_FROM):
        b = min(a + KEYS_FROM, int(offsets[-1]))
        yield keys[a:b], ones[np.searchsorted(offsets, np.arange(a, b), "right") - 1]


def _packed_keys(buckets: int, linked: bool = False):
    """Keys with their sets, those of a bucket together in rows of bounded size.

    Of the sets that are looked at together the least and the greatest with a key are sent on. With ``linked``, what
    connects all of them follows as rows of set and set, whose bucket is ``buckets`` or above.
    """
    def packs(bucket: np.ndarray, pairs: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(bucket, kind="stable")
        bucket, pairs = bucket[order], pairs[order]
        begin = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        size = np.diff(np.append(begin, len(bucket)))
        cuts = np.concatenate([np.arange(a, a + n, PACK_KEYS) for a, n in zip(begin.tolist(), size.tolist())])
        ends = np.append(cuts[1:], len(bucket))
        return pa.RecordBatch.from_arrays([pa.array(bucket[cuts]), pa.array([pairs[a:b].tobytes() for a, b in zip(cuts.tolist(), ends.tolist())],
                                                                            pa.binary())], ["bucket", "pairs"])

    def spread(of: np.ndarray) -> np.ndarray:
        return ((of.view(np.uint64) >> np.uint64(16)) % np.uint64(buckets)).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, owner in (part for batch in batches for part in _key_slices(batch)):
            nodes, roots = _forest(keys, owner) if linked else (keys[:0], keys[:0])
            keys, owner = _ends(keys, owner)
            yield packs(spread(keys), np.stack([keys, owner], 1))
            if len(nodes):
                yield packs(buckets + spread(nodes), np.stack([nodes, roots], 1))
        give_back()
    return run


def _merged_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys that several sets have, each with the least of these; rows come sorted by bucket."""
    def shared() -> pa.RecordBatch:
        keys, ones = _ends(*np.concatenate(held).T) if held else (np.zeros(0, np.int64),) * 2
        several = np.flatnonzero(keys[1:] == keys[:-1])  # least and greatest stand next to each other
        return pa.RecordBatch.from_arrays([pa.array(keys[several]), pa.array(ones[several])], ["key", "first"])

    now, held, count = None, [], 0
    for batch in batches:
        for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column("pairs").to_pylist()):
            if bucket != now:
                yield shared()
                now, held, count = bucket, [], 0
            held.append(np.frombuffer(data, np.int64).reshape(-1, 2))
            count += len(held[-1])
            if count > 2 * BUCKET_KEYS:  # a key that very many texts hold stays two entries
                held = [np.stack(_ends(*np.concatenate(held).T), 1)]
                count = len(held[0])
        give_back()
    yield shared()
    held = []
    give_back()


def _shared_keys(keyed: DataFrame) -> DataFrame:
    """key and the first set that has it, of the keys that several sets have."""
    total = keyed.agg(F.sum(F.size("keys")).alias("n")).first()["n"] or 0
    buckets = -(-total // BUCKET_KEYS) or 1
    packs = keyed.select("one", "keys").mapInArrow(_packed_keys(buckets), "bucket long, pairs binary")
    return packs.repartition(min(buckets, MOST_PARTITIONS), "bucket").sortWithinPartitions("bucket").mapInArrow(_merged_keys, "key long, first long")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Small batches of keys together, as many as make ``KEYS_FROM`` keys: the fewer slices, the fuller the rows of a bucket."""
    some, held = [], 0
    for batch in batches:
        some.append(batch.select(["one", "keys"]))
        held += len(some[-1].column("keys").flatten())
        if held >= KEYS_FROM:
            yield from pa.Table.from_batches(some).combine_chunks().to_batches()
            some, held = [], 0
    if some:
        yield from pa.Table.from_batches(some).combine_chunks().to_batches()


def _merged_links(buckets: int):
    """Rows of ``_packed_keys``, sorted by bucket, to edges that connect the sets which share a key: a forest per bucket."""
    def edges(nodes: np.ndarray, roots: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(roots, pa.int64())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, count, most = None, [], 0, 2 * BUCKET_KEYS
        for batch in batches:
            for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column("pairs").to_pylist()):
                pairs = np.frombuffer(data, np.int64).reshape(-1, 2)
                if bucket >= buckets:
                    yield edges(*pairs.T)
                    continue
                if held and (bucket != now or count > most):
                    yield edges(*_forest(*np.concatenate(held).T))
                    # a key that very many texts hold stays two entries
                    held = [np.stack(_ends(*np.concatenate(held).T), 1)] if bucket == now else []
                    count = sum(map(len, held))
                    most = 2 * max(BUCKET_KEYS, count)
                now = bucket
                held.append(pairs)
                count += len(pairs)
            give_back()
        if held:
            yield edges(*_forest(*np.concatenate(held).T))
        held = []
        give_back()
    return run


def _candidate_edges(base: DataFrame, n: int, rule: Overlap, common, shingles: int) -> DataFrame:
    """(a, b): sets connected through keys they share, both by 64 bits. Keys are made, sent to their bucket and gone."""
    # keys of two classes, each of a quarter more parts than shingles may differ
    total = shingles * 5 * (rule.den - rule.num) // (2 * rule.num)
    buckets = total // BUCKET_KEYS + 1
    keyed, pack = _keyed(n, rule, common), _packed_keys(buckets, linked=True)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from pack(_joined(keyed(batches)))

    packs = base.where("doc_id is not null").mapInArrow(packed, "bucket long, pairs binary")
    return (packs.repartition(min(buckets, MOST_PARTITIONS), "bucket").sortWithinPartitions("bucket")
            .mapInArrow(_merged_links(buckets), "a long, b long"))


def overlaps(sets: list[np.ndarray], columns: int = 2048, dense_from: int = 17) -> np.ndarray:
    """Counts of shared shingles between all of ``sets``, as the product of their incidence matrix with itself."""
    m = len(sets)
    row = np.repeat(np.arange(m), [len(s) for s in sets])
    shingles, col, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    counts = np.zeros(m * m, np.int32)
    few = (df[col] > 1) & (df[col] < dense_from)
    order = np.argsort(col[few], kind="stable")
    r, c = row[few][order], col[few][order]
    for step in range(1, dense_from - 1):
        pair = np.flatnonzero(c[:-step] == c[step:]) if len(c) > step else np.zeros(0, np.int64)
        if not len(pair):
            break
        np.add.at(counts, r[pair] * m + r[pair + step], np.int32(1))
    counts = counts.reshape(m, m)
    counts = counts + counts.T
    many = df >= dense_from
    number = np.cumsum(many) - 1
    keep = many[col]
    r, c = row[keep], number[col[keep]]
    order = np.argsort(c, kind="stable")
    r, c = r[order], c[order]
    for first in range(0, int(many.sum()), columns):
        a, b = np.searchsorted(c, [first, first + columns])
        block = np.zeros((m, columns), np.float32)
        block[r[a:b], c[a:b] - first] = 1
        counts += (block @ block.T).astype(np.int32)
    counts[np.arange(m), np.arange(m)] = [len(s) for s in sets]
    return counts


def _products(rule: Overlap):
    """Rows sorted by block pair in, links out: a forest per pair."""
    def multiply(rows: list[tuple]) -> pa.RecordBatch:
        rows = list({r[0]: r for r in rows}.values())
        ids, sets = np.asarray([r[0] for r in rows]), [np.frombuffer(r[1], "<u8") for r in rows]
        size = np.asarray([len(s) for s in sets])
        counts = overlaps(sets)
        a, b = np.nonzero(np.triu(rule.linked(counts, size[:, None] + size[None, :]), 1))
        nodes, roots = join_sets(ids[a], ids[b]) if len(a) else (ids[:0], ids[:0])
        far = nodes != roots
        return pa.RecordBatch.from_arrays([pa.array(nodes[far], pa.int64()), pa.array(roots[far], pa.int64())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            for group, left, right, node, data in zip(*(batch.column(c).to_pylist() for c in ("group", "left", "right", "node", "shingles"))):
                if (group, left, right) != now:
                    if len(rows) > 1:
                        yield multiply(rows)
                    now, rows = (group, left, right), []
                rows.append((node, data))
            give_back()
        if len(rows) > 1:
            yield multiply(rows)
        rows = []
        give_back()
    return run


def _block_pairs(members: DataFrame, rule: Overlap) -> DataFrame:
    """Members (group, node, n) with every pair of blocks they are in: group, node, left, right."""
    weighted = members.withColumn("weight", F.greatest("n", F.lit(LEAST_WEIGHT)))
    placed = running_total(weighted, ["group", "n", "node"], "weight", "upto")
    first = placed.groupBy("group").agg(F.min("upto").alias("from"))
    blocked = stored(placed.join(first, "group").select(
        "group", "node", "n", ((F.col("upto") - F.col("from")) / BLOCK_WEIGHT).cast("int").alias("block")), "blocked")
    sizes = blocked.groupBy("group", "block").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    left = sizes.select("group", F.col("block").alias("left"), F.col("most").alias("left_most"))
    right = sizes.select("group", F.col("block").alias("right"), F.col("least").alias("right_least"))
    # blocks of a group, not documents; sizes that cannot be linked are not paired
    pairs = left.join(right, "group").where((F.col("left") <= F.col("right"))
                                            & (rule.den * F.col("left_most") >= rule.num * F.col("right_least")))
    ends = pairs.select("group", "left", "right", F.explode(F.array_distinct(F.array("left", "right"))).alias("block"))
    return blocked.join(ends, ["group", "block"]).select("group", "node", "left", "right")


def ngram_join(docs: DataFrame, n: int = 3, rule: Overlap = Overlap()) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest doc_id it is connected with)."""
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    common = None
    if rule.thin < 3:
        often = base.select("text").mapInArrow(_repeats(n), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
        common = spark.sparkContext.broadcast(key_bitmap(often.where(F.col("n") >= COMMON).select("shingle")))
    keyed = stored(base.mapInArrow(_sized(n), "doc_id long, n long, one long, other long"), "keyed")
    able = keyed.where("n > 0 and doc_id is not null")
    sets = stored(able.groupBy("n", "one", "other").agg(F.min("doc_id").alias("first")), "sets")
    groups = components(_candidate_edges(base, n, rule, common, keyed.agg(F.sum("n")).first()[0] or 0))
    # a set alone with its keys is in no edge; the smallest of each group is its own label
    labels = groups.select("node", "component").unionByName(groups.select(F.col("component").alias("node"), "component").distinct())
    # a set is a node of its own, as documents that repeat an id have several
    members = stored(sets.join(labels, sets["one"] == labels["node"]).select(
        F.col("component").alias("group"), F.col("first").alias("doc_id"), "n", "node"), "members")
    pairs = stored(_block_pairs(members.select("group", "node", "n"), rule), "pairs")

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in runs(batch, "text"):
                sets = shingle_sets(part.column("text"), n)
                # rows that repeat an id meet each set of that id; a row gives its own
                nodes = part.column("node").to_pylist()
                meant = [mix(s).sum() == np.uint64(node % (1 << 64)) for s, node in zip(sets, nodes)]
                yield pa.RecordBatch.from_arrays([pa.array([x for x, ok in zip(nodes, meant) if ok], pa.int64()),
                                                  pa.array([s.tobytes() for s, ok in zip(sets, meant) if ok], pa.binary())],
                                                 ["node", "shingles"])

    links = None
    passes = -(-pairs.count() // BROADCAST_ROWS) or 1
    for i in range(passes):
        # whole block pairs a pass, of which both sides of the joins get no more than can be broadcast: shingles are shuffled once
        some = pairs.where(F.pmod(F.xxhash64("group", "left", "right"), F.lit(passes)) == i) if passes > 1 else pairs
        chosen = members.select("doc_id", "node")
        chosen = chosen.join(some.select("node").distinct(), "node") if passes > 1 else chosen
        shingles = base.join(F.broadcast(chosen), "doc_id").select("node", "text").mapInArrow(shingled, "node long, shingles binary")
        met = (shingles.join(F.broadcast(some), "node").repartition("group", "left", "right")
               .sortWithinPartitions("group", "left", "right", "node").select("group", "left", "right", "node", "shingles"))
        found = stored(met.mapInArrow(_products(rule), "a long, b long"), "links")
        links = links.unionByName(found) if links else found
    # the sets of one id are linked through it
    ids = able.groupBy("doc_id").agg(F.min("one").alias("b"), F.max("one").alias("top")).where("top > b").select("doc_id", "b")
    again = able.join(ids, "doc_id").where("one > b").select(F.col("one").alias("a"), "b").distinct()
    found = components(links.unionByName(again))
    placed = stored(sets.join(found, sets["one"] == found["node"], "left")
                    .select("one", "first", F.coalesce("component", "one").alias("home")), "homes")
    least = placed.groupBy("home").agg(F.min("first").alias("component_id"))
    named = placed.join(least, "home").select(F.col("one").alias("set"), "component_id").distinct()
    # rows of one id get one component, also those without a set; rows without an id are linked with nothing
    docs_of = (able.select("doc_id", "one").join(named, F.col("one") == F.col("set"))
               .groupBy(F.col("doc_id").alias("id")).agg(F.min("component_id").alias("component_id")))
    out = keyed.select("doc_id", F.col("n").alias("n_shingles"))
    return out.join(docs_of, out["doc_id"] == docs_of["id"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
