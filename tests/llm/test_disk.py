"""What the near-copy join and stored tables leave on disk, and that sets stay connected through shared keys."""

from __future__ import annotations

import random
import time
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from trackspark.llm import ngram_join
from trackspark.llm.common import stored
from trackspark.llm.components import join_sets
from trackspark.session import shared_dir

R = random.Random(4)


def connected(edges):
    a, b = np.asarray([e[0] for e in edges], np.int64), np.asarray([e[1] for e in edges], np.int64)
    return dict(zip(*(x.tolist() for x in join_sets(a, b)))) if len(a) else {}


def test_op4_sets_are_connected_through_the_keys_they_share(monkeypatch):
    rows = [(R.randrange(-99, 99), [R.randrange(-2 ** 63, 2 ** 63) if R.random() < 0.7 else R.randrange(-3, 300) << 20 for _ in range(R.randrange(4))])
            for _ in range(400)]
    holders = {}
    for one, keys in rows:
        for key in keys:
            holders.setdefault(key, set()).add(one)
    want = connected([(x, min(ones)) for ones in holders.values() if len(ones) > 1 for x in ones])
    batches = [pa.RecordBatch.from_arrays([pa.array([o for o, _ in rows[i:i + 7]], pa.int64()), pa.array([k for _, k in rows[i:i + 7]], pa.list_(pa.int64()))],
                                          ["one", "keys"]) for i in range(0, len(rows), 7)]
    for size, pack in ((1 << 20, 128), (50, 4), (3, 1)):
        monkeypatch.setattr(ngram_join, "KEYS_FROM", size)
        monkeypatch.setattr(ngram_join, "BUCKET_KEYS", size)
        monkeypatch.setattr(ngram_join, "PACK_KEYS", pack)
        packed = list(ngram_join._packed_keys(7, linked=True)(ngram_join._joined(iter(batches))))
        table = pa.Table.from_batches(packed).sort_by("bucket").combine_chunks()
        links = [e for b in ngram_join._merged_links(7)(iter(table.to_batches(max_chunksize=11))) for e in zip(*b.to_pydict().values())]
        assert connected(links) == want


def test_op4_over_several_passes(spark, monkeypatch):
    texts = [" ".join(R.choice("abcdefgh") + str(i % 9) for _ in range(40)) for i in range(30)]
    rows = [(3 * i + j, text + " end" * j) for i, text in enumerate(texts) for j in range(3)]
    df = spark.createDataFrame([*rows, (None, texts[0]), (500, None)], "doc_id long, text string").repartition(4)
    want = sorted(ngram_join.ngram_join(df, 3, ngram_join.Overlap(80, 100)).collect(), key=str)
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", 40)
    assert sorted(ngram_join.ngram_join(df, 3, ngram_join.Overlap(80, 100)).collect(), key=str) == want
    assert sum(r.component_id not in (None, r.doc_id) for r in want) == 60


def test_op4_writes_no_keys_down(spark):
    words = 200_000
    df = spark.createDataFrame([(i, " ".join(str(R.randrange(10 ** 9)) for _ in range(words // 100))) for i in range(100)], "doc_id long, text string")
    folder = Path(shared_dir(spark).removeprefix("file:"))
    before = {f: f.stat().st_size for f in folder.rglob("*.parquet")}
    assert ngram_join.ngram_join(df, 5, ngram_join.Overlap(80, 100)).where("component_id <> doc_id").isEmpty()
    left = sum(f.stat().st_size for f in folder.rglob("*.parquet") if f not in before)
    assert left < words  # less than a byte for each shingle


def test_shuffle_files_go_with_the_query_that_made_them(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles()
        names = [files.apply(i).getName() for i in range(files.size())]
        return {n for n in names if n.startswith("shuffle_")}

    before = shuffled()
    kept = stored(spark.range(20_000).withColumn("x", F.col("id") % 1000).repartition(5, "x"), "dropped")
    until = time.time() + 20
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - before and kept.count() == 20_000
