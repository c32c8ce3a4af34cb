"""Toxicity: a logistic classifier over words, regularised by counterfactual sentences.

A text is the set of its words (digits, letters, longer characters; A-Z lower-cased). The vocabulary is what
labelled texts show to be frequent enough and telling beyond chance, plus the terms that name groups (``groups``). Training adds, for every labelled sentence that names a group, the sentence with another
group in its place, and penalises the square of the change in score, so a score does not hang on
which group is named: fewer false alarms on neutral mentions.

Training rows are a sample bounded by ``TRAIN_ROWS``, taken by hash; vocabulary statistics are
computed in Spark over it, and what reaches the driver is at most that many short lists. Scoring
reads whole texts in runs of bounded size.

NULL and empty texts are scored like a text without known words. A label that is NULL is no label; an id with
several labels counts once, as toxic if one of them says so, and one with several texts teaches one of them. Without labelled rows of both kinds the score is their share (0.5 without any).
Repeated rows get equal scores; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackspark.llm.common import runs, stored
from trackspark.llm.words import ALNUM, find_words

#: documented bounds: labelled rows to learn from, words the model knows, texts a word must be in
TRAIN_ROWS = 20_000
VOCABULARY = 4096
LEAST_TEXTS = 5
#: standard errors by which a word's share of toxic texts has to differ from the mean
TELLING = 5.0
#: labels are drawn by their place among so many hashes
DRAWS = 1 << 62

#: Terms naming groups, by kind; a term is swapped for the others of its kind.
IDENTITY_TERMS = {
    "gender": ["women", "men", "woman", "man", "female", "male", "transgender", "nonbinary"],
    "orientation": ["gay", "straight", "lesbian", "bisexual", "heterosexual", "homosexual", "queer"],
    "religion": ["muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "catholic", "protestant", "atheist"],
    "origin": ["african", "american", "arab", "asian", "european", "indian", "latino", "mexican", "chinese", "black", "white"],
    "age": ["young", "old", "elderly", "teenage"],
    "ability": ["blind", "deaf", "disabled", "paralyzed"],
}


def word_hashes(words: list[str]) -> np.ndarray:
    return find_words(pa.array(words, pa.string()), ALNUM).hash


@dataclass
class Model:
    """Sorted word hashes with a weight each, and the score of a text without any of them."""

    hashes: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, texts: pa.Array) -> np.ndarray:
        rows, known = present(texts, self.hashes)
        logit = self.bias + np.bincount(rows, self.weights[known], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def present(texts: pa.Array, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which known words are in which text, once each, as rows and indexes."""
    if not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    words = find_words(texts, ALNUM)
    doc, unit = words.doc, words.hash
    maybe = np.zeros(1 << 16, bool)
    maybe[hashes & np.uint64(0xFFFF)] = True
    near = maybe[unit & np.uint64(0xFFFF)]
    doc, unit = doc[near], unit[near]
    at = np.minimum(np.searchsorted(hashes, unit), len(hashes) - 1)
    hit = hashes[at] == unit
    pairs = np.unique(doc[hit] * np.int64(len(hashes)) + at[hit])
    return pairs // len(hashes), pairs % len(hashes)


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in runs(batch, "text"):
            words = find_words(part.column("text"), ALNUM)
            toxic = np.asarray(part.column("toxic").to_pylist(), np.int64)
            order = np.lexsort((words.hash, words.doc))
            h, d = words.hash[order], words.doc[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(h[new].view(np.int64)), pa.array(toxic[d[new]])], ["word", "toxic"])


def _lists(hashes: np.ndarray, swaps: dict[int, list[int]]):
    """Per labelled text its label, known words, and the swaps that its sentences allow."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in runs(batch, "text"):
                rows, known = present(part.column("text"), hashes)
                cut = np.searchsorted(rows, np.arange(part.num_rows + 1))
                known_lists = [known[a:b].tolist() for a, b in zip(cut[:-1], cut[1:])]
                pairs = [_sentence_swaps(t or "", hashes, swaps) if any(k in swaps for k in ks) else []
                         for t, ks in zip(part.column("text").to_pylist(), known_lists)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("toxic"), pa.array(known_lists, pa.list_(pa.int32())), pa.array(pairs, pa.list_(pa.int32()))],
                    ["toxic", "words", "swaps"])
    return run


def _sentence_swaps(text: str, hashes: np.ndarray, swaps: dict[int, list[int]]) -> list[int]:
    """Term and its substitute, flattened, for each sentence of the text that holds the term but not the substitute."""
    sentences = [s for line in text.split("\n") for s in line.split(".") if s.strip()]
    rows, known = present(pa.array(sentences, pa.string()), hashes)
    out: dict[tuple[int, int], None] = {}
    for s in range(len(sentences)):
        here = set(known[rows == s].tolist())
        for k in here:
            out.update({(k, other): None for other in swaps.get(k, []) if other not in here})
    return [x for pair in out for x in pair]


def _marked(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """toxic and text of at most ``rows`` labelled documents, those whose ids have the least hashes."""
    marked = (labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id"))
              .agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).cast("long").alias("toxic"))
              .withColumn("draw", F.xxhash64("id").bitwiseAND(DRAWS - 1)))
    total = marked.count()
    if total > rows:  # some more than wanted by hash, and of those the first
        marked = marked.where(F.col("draw") < int(DRAWS * min(1.0, 1.2 * rows / total + 1000 / total))).orderBy("draw", "id").limit(rows)
    # ``rows`` labels at most, so they go to the texts and not the texts to them
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(marked), F.col("doc_id") == F.col("id"))
    # an id that repeats teaches once, with the text whose hash is least
    return (chosen.withColumn("text", F.struct(F.xxhash64("text").alias("hash"), "text"))
            .groupBy("id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text")).select("toxic", "text.text"))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, counterfactual: float = 10.0, ridge: float = 1.0,
          groups: dict[str, list[str]] | None = None) -> Model:
    """Fit to the texts of ``docs`` that ``labels`` (doc_id, toxic) marks. Both hold training rows only.

    ``groups`` names the terms that are swapped for one another, lower-case words by kind.
    """
    groups = IDENTITY_TERMS if groups is None else groups
    sample = stored(_marked(docs, labels, rows), "marked")
    seen = sample.groupBy("toxic").count().collect()
    n = {r["toxic"]: r["count"] for r in seen}
    if not n.get(0) or not n.get(1):
        share = 0.5 if not n else float(1 in n)
        return Model(np.zeros(0, np.uint64), np.zeros(0), 30.0 * (2 * share - 1) if n else 0.0)
    base = n[1] / (n[0] + n[1])
    telling = (sample.mapInArrow(_distinct_words, "word long, toxic long").groupBy("word")
               .agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).where(F.col("n") >= LEAST_TEXTS)
               .withColumn("z", F.abs(F.col("t") - F.col("n") * base) / F.sqrt(F.col("n") * base * (1 - base)))
               .where(F.col("z") >= TELLING).orderBy(F.desc("z"), "word").limit(VOCABULARY).collect())
    terms = {t: word_hashes([t])[0] for kind in groups.values() for t in kind}
    hashes = np.unique(np.concatenate([np.asarray([r["word"] for r in telling], np.int64).view(np.uint64),
                                       np.asarray(list(terms.values()), np.uint64)]))
    place = {t: int(np.searchsorted(hashes, h)) for t, h in terms.items()}
    swaps = {place[t]: [place[o] for o in kind if o != t] for kind in groups.values() for t in kind}
    lists = sample.mapInArrow(_lists(hashes, swaps), "toxic long, words array<int>, swaps array<int>").collect()
    return _fit(hashes, lists, counterfactual, ridge)


def _fit(hashes: np.ndarray, lists: list, counterfactual: float, ridge: float) -> Model:
    """Accelerated gradient descent on log loss + ridge + squared changes of score by a swap."""
    lists = sorted(lists, key=lambda r: (r["toxic"], r["words"]))  # sums in one order, whatever order rows came in
    y = np.asarray([r["toxic"] for r in lists], float)
    row = np.repeat(np.arange(len(lists)), [len(r["words"]) for r in lists])
    col = np.asarray([w for r in lists for w in r["words"]], np.int64)
    pairs = np.asarray([w for r in lists for w in r["swaps"]], np.int64).reshape(-1, 2)
    pairs, weight = np.unique(pairs, axis=0, return_counts=True) if len(pairs) else (pairs, np.zeros(0))
    n, v = len(y), len(hashes)
    df = np.bincount(col, minlength=v)
    scale = 1 / np.sqrt(1 + 10 * df / n)  # words of most texts move slowly
    w, b, mw, mb = np.zeros(v), np.log(y.mean() / (1 - y.mean())), np.zeros(v), 0.0
    vw, vb = np.zeros(v), 0.0
    for t in range(1, 401):  # Adam, with the whole sample each step
        z = b + np.bincount(row, w[col] * scale[col], minlength=n)
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n
        gw = np.bincount(col, g[row], minlength=v) * scale + ridge / n * w
        if len(pairs):
            change = (w * scale)[pairs[:, 0]] - (w * scale)[pairs[:, 1]]
            pull = 2 * counterfactual / n * weight * change
            gw += (np.bincount(pairs[:, 0], pull, minlength=v) - np.bincount(pairs[:, 1], pull, minlength=v)) * scale
        gb = g.sum()
        mw, mb = 0.9 * mw + 0.1 * gw, 0.9 * mb + 0.1 * gb
        vw, vb = 0.999 * vw + 0.001 * gw * gw, 0.999 * vb + 0.001 * gb * gb
        step = 0.1 / (1 + t / 100)
        w -= step * (mw / (1 - 0.9 ** t)) / (np.sqrt(vw / (1 - 0.999 ** t)) + 1e-8)
        b -= step * (mb / (1 - 0.9 ** t)) / (np.sqrt(vb / (1 - 0.999 ** t)) + 1e-8)
    return Model(hashes, w * scale, float(b))


def toxicity(model: Model):
    """The model as a function of a text column."""
    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        # a batch is scored in runs of bounded size, whatever its texts are
        batch = pa.RecordBatch.from_arrays([text], ["text"])
        parts = [model.score(part.column("text")) for part in runs(batch, "text")]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())
    return score


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, score."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), toxicity(model)("text").alias("score"))
