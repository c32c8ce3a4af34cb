"""The registered queries: each applies its operator, with production parameters, to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackspark.llm import language, toxicity
from trackspark.llm.common import bound_batches
from trackspark.llm.conversations import damaged, repair_report
from trackspark.llm.decontaminate import decontaminate, hit_words
from trackspark.llm.lexical import lexical_search
from trackspark.llm.lines import dedup_lines
from trackspark.llm.mixing import mix_sources
from trackspark.llm.ngram_join import ngram_join
from trackspark.llm.simhash import simhash_groups
from trackspark.llm.suffixes import dedup_substrings
from trackspark.llm.tokens import read_shards, write_shards
from trackspark.llm.topk import top_k
from trackspark.llm.warc import read_archives, write_archives
from trackspark.session import fresh_path

TOKENIZER = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontaminate(spark: SparkSession, d: str) -> DataFrame:
    found = decontaminate(table(spark, d, "documents"), table(spark, d, "benchmark"))
    hit = hit_words(F.col("spans"))
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def op2_warc(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    write_archives(table(spark, d, "pages"), path)
    return read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_token_ids(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "ids")
    write_shards(table(spark, d, "documents"), path, tokenizer_path())
    return read_shards(spark, path)


def op4_ngram_join(spark: SparkSession, d: str) -> DataFrame:
    return ngram_join(table(spark, d, "documents"))


def op5_top_k(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"))


def held_out(modulus: int, remainder: int):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def op6_language(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    model = language.train(docs.where(~held_out(3, 1)))
    return language.identify(docs, model).select("doc_id", held_out(3, 1).alias("held_out"), "lang_pred", "score")


def op7_lines(spark: SparkSession, d: str) -> DataFrame:
    spans = F.array_join(F.transform("removed", lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    return dedup_lines(table(spark, d, "documents")).select(
        "doc_id", "n_units", F.size("removed").cast("long").alias("n_removed"), spans.alias("removed_spans"),
        F.length("kept").cast("long").alias("kept_chars"), F.md5("kept").alias("kept_md5"))


def op8_mixing(spark: SparkSession, d: str) -> DataFrame:
    return mix_sources(table(spark, d, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def toxicity_model(spark: SparkSession, docs: DataFrame, d: str) -> toxicity.Model:
    labels = table(spark, d, "labels").where(~held_out(4, 2))
    return toxicity.train(docs.where(~held_out(4, 2)), labels)


def op9_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    scored = toxicity.score_toxicity(docs, toxicity_model(spark, docs, d))
    return scored.select("doc_id", held_out(4, 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_suffixes(spark: SparkSession, d: str) -> DataFrame:
    return dedup_substrings(table(spark, d, "documents")).drop("kept")


def op11_simhash(spark: SparkSession, d: str) -> DataFrame:
    return simhash_groups(table(spark, d, "documents"))


def op12_conversations(spark: SparkSession, d: str) -> DataFrame:
    turns = table(spark, d, "conversations")
    return repair_report(damaged(turns), turns)


def op13_lexical(spark: SparkSession, d: str) -> DataFrame:
    return lexical_search(table(spark, d, "documents"), table(spark, d, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontaminate": op1_decontaminate,
        "op2_warc": op2_warc,
        "op3_token_ids": op3_token_ids,
        "op4_ngram_join": op4_ngram_join,
        "op5_top_k": op5_top_k,
        "op6_language": op6_language,
        "op7_lines": op7_lines,
        "op8_mixing": op8_mixing,
        "op9_toxicity": op9_toxicity,
        "op10_suffixes": op10_suffixes,
        "op11_simhash": op11_simhash,
        "op12_conversations": op12_conversations,
        "op13_lexical": op13_lexical,
    }
