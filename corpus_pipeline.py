"""A corpus from ``documents`` to token ids: toxicity, near copies, benchmark passages, mix, ids.

Each stage is (name, function of spark, docs, sf_dir); what it returns is written as Parquet and
read again as the next one's ``docs``. All but the last return the columns of documents. No stage
depends on numbers of an earlier one but through the rows that it kept.

* toxicity: documents that the classifier of operator 9 rejects go. It learns from the labelled rows that it may learn from.
* near_copies: of the documents that five-word shingles connect at a Jaccard similarity of 0.8 or more, the one with
  the smallest doc_id stays. Rows without doc_id stay.
* decontamination: documents with a window of a benchmark item go.
* mixing: every document as many times as the mix takes it; that may be none, and it may be three.
* token_ids: shards are written and read back: doc_id, start, n_tokens, ids_crc32 per row of the mix.

Rows that repeat an id stay or go together. Empty tables pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackspark.llm.common import same, stored
from trackspark.llm.decontaminate import decontaminate
from trackspark.llm.mixing import mix_sources
from trackspark.llm.ngram_join import BROADCAST_ROWS, Overlap, ngram_join
from trackspark.llm.queries import table, tokenizer_path, toxicity_model
from trackspark.llm.tokens import read_shards, write_shards
from trackspark.llm.toxicity import toxicity
from trackspark.session import fresh_path

REJECT_FROM = 0.3


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id is not in ``gone``; the list is as long as what goes.

    A list of up to ``BROADCAST_ROWS`` ids goes to the texts, else texts go to the list.
    """
    name = _free(docs, "gone")
    listed = stored(gone.select(F.col("doc_id").alias(name)).distinct(), "gone")
    few = listed.count() <= BROADCAST_ROWS
    return docs.join(F.broadcast(listed) if few else listed, docs["doc_id"] == listed[name], "left_anti")


def _free(docs: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity_model(spark, docs, sf_dir)
    return docs.where(toxicity(model)("text") < REJECT_FROM)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = ngram_join(docs, 5, Overlap(80, 100))
    return _without(docs, found.where("doc_id <> component_id"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = stored(decontaminate(docs, table(spark, sf_dir, "benchmark")).where(F.size("spans") > 0).select("doc_id"), "contaminated")
    nameless = found.where("doc_id is null").isEmpty()
    kept = _without(docs, found)
    return kept if nameless else kept.where("doc_id is not null")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    key, copies, n = (_free(docs, name) for name in ("id", "copies", "n"))
    taken = mix_sources(docs).where("copies > 0").select(
        F.col("doc_id").alias(key), "copies").groupBy(key).agg(F.max("copies").cast("int").alias(copies))
    joined = docs.join(taken, same(docs["doc_id"], taken[key]))
    return joined.withColumn(n, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*docs.columns)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "ids")
    write_shards(docs, path, tokenizer_path())
    return read_shards(spark, path)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_copies", near_copies_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_ids", token_stage),
]

#: The first stage is a trained model and the last a tokenizer, so SQL cannot express run()'s rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
