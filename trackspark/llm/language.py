"""Language ID in two steps: a family first, then one-versus-one linear SVMs within it.

Features are the relative frequencies of hashed runs of three bytes of the whole text (A-Z
lower-cased, a blank before and after). Families are voted on by one-versus-one SVMs as well. A
language that ``FAMILIES`` does not list is a family of its own. Learning uses the
``PER_LANGUAGE`` different texts of each language whose hashes are least, all if fewer; copies of a text count once.
Their feature vectors go to the driver, and the model is a few weight vectors that travel with the tasks.

A NULL text, or one without a letter, is ``und`` with score 0. Without anything to learn from every
text is. With one language known every other text is that one. Rows with NULL as language teach nothing. Equal
texts get equal results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackspark.llm.common import runs
from trackspark.llm.words import LOWER, utf8

#: documented bound: texts of a language that are learned from
PER_LANGUAGE = 400
BINS = 4096
#: texts are drawn by their place among so many hashes
DRAWS = 1 << 62
UNDETERMINED = "und"

#: Families of languages by ISO 639-1 code.
FAMILIES = {
    "germanic": ["en", "de", "nl", "af", "da", "sv", "no", "is"],
    "romance": ["fr", "es", "it", "pt", "ro", "ca", "gl"],
    "slavic": ["ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "sl"],
    "uralic": ["fi", "et", "hu"],
    "turkic": ["tr", "az", "kk", "uz"],
    "indic": ["hi", "bn", "mr", "ur", "pa", "gu"],
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}


def family_of(language: str) -> str:
    return _FAMILY_OF.get(language, language)


def _codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed three-byte runs of all texts, and where each text's begin."""
    blank = pa.scalar(" ")
    padded = pc.binary_join_element_wise(blank, pc.fill_null(texts, ""), blank, pa.scalar(""))
    data, offsets = utf8(padded)
    low = LOWER[data].astype(np.uint32)
    codes = low[:-2] << 16 | low[1:-1] << 8 | low[2:]
    codes = (codes * np.uint32(2654435761)) >> np.uint32(20)
    return codes.astype(np.int32), offsets


def _summed(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of what belongs to each text; the two runs that cross into the next text are left out."""
    cum = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    begin = np.minimum(offsets[:-1], len(values))
    end = np.maximum(np.minimum(offsets[1:] - 2, len(values)), begin)
    return cum[end] - cum[begin]


def features(texts: pa.Array) -> np.ndarray:
    codes, offsets = _codes(texts)
    out = np.zeros((len(texts), BINS), np.float32)
    for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
        if b - a > 2:
            out[i] = np.bincount(codes[a:b - 2], minlength=BINS)[:BINS] / (b - a - 2)
    return out


def linear_svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, steps: int = 200) -> np.ndarray:
    """Weights and bias (last) of a squared-hinge SVM, classes weighted alike, by accelerated gradient descent."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    w = np.zeros(x.shape[1])
    v, t = w.copy(), 1.0
    rate = 1 / (1e-3 + 2 * c * float((share * (x ** 2).sum(1)).sum()))
    for _ in range(steps):
        loss = np.maximum(0, 1 - y * (x @ v))
        new = v - rate * (1e-3 * v - 2 * c * (x.T @ (share * y * loss)))
        t, old = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        v = new + (old - 1) / t * (new - w)
        w = new
    return w


@dataclass
class Model:
    """SVMs between families and between the languages of each: (one, other, weights)."""

    families: dict[str, list[str]]
    machines: list[tuple[str, str, np.ndarray, float]]

    def predict(self, texts: pa.Array) -> tuple[list[str | None], np.ndarray]:
        if not self.families:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        codes, offsets = _codes(texts)
        n = np.maximum(offsets[1:] - offsets[:-1] - 2, 1)
        margin = {(a, b): _summed(w[codes], offsets) / n + bias for a, b, w, bias in self.machines}
        family, sure = _vote(sorted(self.families), margin, len(texts), "family:")
        found = np.empty(len(texts), object)
        score = np.zeros(len(texts))
        for f, languages in self.families.items():
            here = family == f
            language, also = _vote(languages, margin, len(texts), "")
            found[here], score[here] = language[here], (sure * also)[here]
        return found.tolist(), score


def _vote(names: list[str], margin: dict, n: int, prefix: str) -> tuple[np.ndarray, np.ndarray]:
    """The name that wins most pairs, by sum of margins among equals; how sure its narrowest pair is."""
    votes, sums, narrow = (np.full((len(names), n), x) for x in (0.0, 0.0, 30.0))
    for i, j in combinations(range(len(names)), 2):
        m = margin[prefix + names[i], prefix + names[j]]
        for k, signed in ((i, m), (j, -m)):
            votes[k] += (signed > 0) + 0.5 * (signed == 0)
            sums[k] += np.tanh(signed)
            narrow[k] = np.minimum(narrow[k], signed)
    best = np.argmax(votes + 1e-3 * sums / max(1, len(names)), axis=0)
    return np.asarray(names, object)[best], 1 / (1 + np.exp(-4 * np.clip(narrow[best, np.arange(n)], -5, 5)))


def _drawn(known: DataFrame, per_language: int) -> DataFrame | None:
    """lang and text of the ``per_language`` texts of each language with the least hashes."""
    drawn = known.withColumns({"draw": F.xxhash64("text").bitwiseAND(DRAWS - 1), "draw2": F.xxhash64(F.lit(1), "text")})
    counts = {r["lang"]: r["n"] for r in drawn.groupBy("lang").agg(F.approx_count_distinct("draw").alias("n")).collect()}  # one row per language
    if not counts:
        return None
    # twice what is wanted passes, so that the estimate may be wrong by half; copies meet in the map-side half of the grouping
    bound = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, int(DRAWS * min(1.0, 2 * per_language / max(1, n))))])
    once = drawn.where(F.col("draw") < F.element_at(bound, F.col("lang"))).dropDuplicates(["lang", "draw", "draw2"])
    ranked = once.withColumn("at", F.row_number().over(Window.partitionBy("lang").orderBy("draw", "draw2")))
    return ranked.where(F.col("at") <= per_language).select("lang", "text")


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Fit to text and lang of ``docs``, which holds training rows only."""
    known = docs.where("text is not null and lang is not null").select("text", F.col("lang").cast("string").alias("lang"))
    sample = _drawn(known, per_language)
    if sample is None:
        return Model({}, [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in runs(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("lang"), pa.array([x.tobytes() for x in features(part.column("text"))], pa.binary())],
                                                 ["lang", "x"])
    rows = sorted((r["lang"], bytes(r["x"])) for r in sample.mapInArrow(run, "lang string, x binary").collect())
    languages = sorted({lang for lang, _ in rows})
    label = np.asarray([lang for lang, _ in rows], object)
    x = np.frombuffer(b"".join(v for _, v in rows), np.float32).reshape(len(rows), BINS)
    spread = 1 / (x.std(0) + 1e-4)
    families: dict[str, list[str]] = {}
    for lang in languages:
        families.setdefault(family_of(lang), []).append(lang)
    family = np.asarray([family_of(lang) for lang in label], object)
    scaled = x * (spread / np.sqrt(BINS))
    pairs = [("family:", family, a, b) for a, b in combinations(sorted(families), 2)]
    pairs += [("", label, a, b) for group in families.values() for a, b in combinations(group, 2)]
    machines = []
    for prefix, names, a, b in pairs:
        part = (names == a) | (names == b)
        w = linear_svm(scaled[part], np.where(names[part] == a, 1.0, -1.0))
        machines.append((prefix + a, prefix + b, (w[:-1] * spread / np.sqrt(BINS)).astype(np.float32), float(w[-1])))
    return Model(families, machines)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, lang_pred, score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in runs(batch, "text", 1 << 20):
                languages, score = model.predict(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("lettered"), pa.array(languages, pa.string()), pa.array(score)],
                                                 ["doc_id", "lettered", "lang_pred", "score"])
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    scored = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", lettered.alias("lettered"))
              .mapInArrow(run, "doc_id long, lettered boolean, lang_pred string, score double"))
    return scored.select("doc_id", F.when(F.col("lettered"), F.col("lang_pred")).otherwise(F.lit(UNDETERMINED)).alias("lang_pred"),
                         F.when(F.col("lettered"), F.col("score")).otherwise(F.lit(0.0)).alias("score"))
