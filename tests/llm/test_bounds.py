"""Passes of queries and carried bounds, exact large scores, samples that stay within their bounds."""

from __future__ import annotations

import math
import platform
import random
import resource
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from trackspark.llm import language, queries as q, toxicity
from trackspark.llm.common import runs
from trackspark.llm.topk import top_k

R = random.Random(21)


def best_of(rows, asked, k=5):
    want = []
    for a, x in asked:
        scored = sorted((-sum(i * j for i, j in zip(x, y)), b) for b, y in rows if b != a and len(y) == len(x))
        want += [(a, n + 1, b, min(max(-s, -(1 << 63)), (1 << 63) - 1)) for n, (s, b) in enumerate(scored[:k])]
    return sorted(want)


@pytest.mark.parametrize("sizes", [dict(block_rows=40, query_rows=7, query_bytes=600), dict(block_rows=40, query_rows=30), {}])
def test_op5_over_many_blocks_and_passes(spark, sizes):
    rows = [(i % 230, [R.choice([-1.0, -0.25, 0.0, 0.5, 0.3]) for _ in range(R.choice([3, 3, 5]))]) for i in range(300)]
    rows += [(400, []), (401, []), (402, [0.0, 0.0, 0.0]), (500, [-0.0] * 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(6)
    asked = df.where("vec_id % 20 = 0")
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in top_k(df, asked, **sizes).collect())
    assert got == best_of(whole, [r for r in whole if r[0] % 20 == 0])


def test_op5_ranks_scores_beyond_the_range_of_long(spark):
    rows = [(0, [1e307, 1.0]), (1, [1e307, 0.0]), (2, [1.7e308, -1.0]), (3, [-1e300, 5.0]), (4, [1e13, 1e13]), (5, [1e307, 1e3]), (20, [3e9, 3e9])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    whole = [(i, [256 * int(x) for x in v]) for i, v in rows]
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score)
                 for r in top_k(df, df.where("vec_id % 20 = 0"), k=6, block_rows=2, query_rows=1).collect())
    assert got == best_of(whole, [r for r in whole if r[0] % 20 == 0], 6)


def test_op6_sample_is_bounded_however_often_a_text_repeats(spark):
    copies = spark.range(20_000).select(F.lit("the one text that is everywhere").alias("text"), F.lit("en").alias("lang"))
    others = spark.createDataFrame([(f"own text number {i} of them", "en") for i in range(900)] + [("une phrase", "fr"), (None, "fr"), ("x", None)],
                                   "text string, lang string")
    known = copies.unionByName(others).where("text is not null and lang is not null")
    drawn = [(r.lang, r.text) for r in language._drawn(known, 400).collect()]
    assert len(drawn) == len(set(drawn)) == 401 and ("fr", "une phrase") in drawn
    assert language._drawn(known.where("false"), 400) is None


def test_op9_sample_is_bounded_however_often_an_id_repeats(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    docs = docs.unionByName(spark.range(5000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("again").alias("text")))
    labels = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 3 == 0).cast("int").alias("toxic"))
    labels = labels.unionByName(labels.where("doc_id = 7"))
    assert toxicity._marked(docs, labels, 500).count() == 500
    every = toxicity._marked(docs, labels, 10_000).collect()
    assert len(every) == 3000 and sum(r.toxic for r in every) == 1000


def held_out(doc_id, modulus, rest):
    return zlib.crc32(str(doc_id).encode()) % modulus == rest


def test_op6_is_right_on_held_out_documents(spark):
    d = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in q.table(spark, d, "documents").select("doc_id", "lang").collect()}
    rows = [r for r in q.op6_language(spark, d).collect() if held_out(r.doc_id, 3, 1) and truth[r.doc_id] and r.lang_pred != "und"]
    assert sum(r.lang_pred == truth[r.doc_id] for r in rows) >= 0.97 * len(rows) > 100


def test_op9_on_held_out_labels(spark):
    d = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.toxic for r in q.table(spark, d, "labels").collect()}
    rows = [r for r in q.op9_toxicity(spark, d).collect() if held_out(r.doc_id, 4, 2) and truth.get(r.doc_id) is not None]
    toxic = [r.predicted for r in rows if truth[r.doc_id]]
    clean = [r.predicted for r in rows if not truth[r.doc_id]]
    print("recall", sum(toxic), len(toxic), "false alarms", sum(clean), len(clean))
    assert sum(toxic) >= 0.7 * len(toxic) and sum(clean) <= 0.02 * len(clean)


def test_op4_shared_keys_over_many_buckets(spark, monkeypatch):
    from trackspark.llm import ngram_join

    rows = [(R.randrange(-40, 40), [R.randrange(-2 ** 63, 2 ** 63) if R.random() < 0.5 else R.randrange(-3, 60) << 20 for _ in range(R.randrange(9))])
            for _ in range(900)]
    have = {}
    for one, keys in rows:
        for key in keys:
            have.setdefault(key, set()).add(one)
    want = sorted((key, min(ones)) for key, ones in have.items() if len(ones) > 1)
    for size, pack in ((1 << 20, 128), (50, 4)):
        monkeypatch.setattr(ngram_join, "KEYS_FROM", size)
        monkeypatch.setattr(ngram_join, "BUCKET_KEYS", size)
        monkeypatch.setattr(ngram_join, "PACK_KEYS", pack)
        df = spark.createDataFrame(rows, "one long, keys array<long>").repartition(5)
        parts = [b for batch in df.toArrow().to_batches() for b in ngram_join._packed_keys(7)(iter([batch]))]
        table = ngram_join.pa.Table.from_batches(parts).sort_by("bucket").combine_chunks()
        merged = [r for b in ngram_join._merged_keys(iter(table.to_batches(max_chunksize=11))) for r in zip(*b.to_pydict().values())]
        assert sorted(merged) == want
        assert sorted(map(tuple, ngram_join._shared_keys(df).collect())) == want


def test_key_slices_are_whole_and_bounded(monkeypatch):
    from trackspark.llm import ngram_join

    rows = [(i, [R.randrange(1000) for _ in range(n)]) for i, n in enumerate([0, 7, 0, 0, 1, 30, 2, 0])]
    pa = ngram_join.pa
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), pa.array([k for _, k in rows], pa.list_(pa.int64()))], ["one", "keys"])
    monkeypatch.setattr(ngram_join, "KEYS_FROM", 8)
    for part, some in ((batch, rows), (batch.slice(1, 5), rows[1:6]), (batch.slice(2, 2), []), (batch.slice(0, 0), [])):
        slices = [(k.tolist(), o.tolist()) for k, o in ngram_join._key_slices(part)]
        assert [p for k, o in slices for p in zip(o, k)] == [(i, k) for i, keys in some for k in keys]
        assert all(len(k) <= 8 for k, _ in slices)


def test_arrow_batches_are_bounded_and_a_lower_limit_stays(spark):
    from trackspark.llm.common import BATCH_BYTES, bound_batches

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        for value, want in (("64m", str(BATCH_BYTES)), ("67108864b", str(BATCH_BYTES)), ("1g", str(BATCH_BYTES)), ("9mb", str(BATCH_BYTES)),
                            ("4m", "4m"), ("4096", "4096"), ("4097b", "4097b")):
            spark.conf.set(key, value)
            bound_batches(spark)
            assert spark.conf.get(key) == want
    finally:
        spark.conf.set(key, before)


@pytest.mark.skipif(platform.libc_ver()[0] != "glibc", reason="only glibc's heap is asked to shrink")
def test_workers_give_back_what_a_batch_took():
    def resident():
        return int(Path("/proc/self/statm").read_text().split()[1]) * resource.getpagesize()

    held = [np.ones(256) for _ in range(100_000)]
    last = np.ones(256)  # keeps the end of the heap in use
    full = resident()
    del held
    list(runs(pa.RecordBatch.from_pydict({"text": ["a"]}), "text"))
    assert resident() < full - (100 << 20) and len(last)
