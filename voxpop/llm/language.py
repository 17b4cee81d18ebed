"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams.

Document frequencies are counted over all documents that may be learned from; the
weights are fitted on a bounded sample by follow-the-regularised-leader with
elastic-net penalties, which leaves most of them zero; a temperature fitted on a
part of the sample that the weights haven't seen calibrates the scores.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxpop.llm.common import documents
from voxpop.llm.registry import register
from voxpop.llm.samples import id_remainder, labelled_sample

#: The sample: labelled documents, and their characters together.
SAMPLE_ROWS, SAMPLE_CHARS = 3000, 12_000_000
BITS, LONGEST = 15, 3
FEATURES = 1 << BITS
EPOCHS, ALPHA, BETA, L1, L2 = 3, 0.5, 1.0, 0.05, 0.01
#: Every so many rows of the sample are kept for the temperature.
CALIBRATION = 5
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
#: Odd multipliers that spread n-grams over the features, one a place.
_SPREAD = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35], np.uint32)


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features (hashed n-grams of 1 to 3 code points of the lower-cased text) that
    a text has, and how often."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4").astype(np.uint32)
    found, value = [], np.zeros(len(points), np.uint32)
    for n in range(1, LONGEST + 1):
        if len(points) < n:
            break
        value = (value[: len(points) - n + 1] ^ points[n - 1 :]) * _SPREAD[n - 1]
        value ^= value >> np.uint32(15)
        found.append((value * _SPREAD[0] + np.uint32(n)) >> np.uint32(32 - BITS))
    counts = np.bincount(np.concatenate(found), minlength=FEATURES) if found else np.zeros(FEATURES, np.int64)
    has = np.flatnonzero(counts)
    return has, counts[has]


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Number of texts, and of texts that have each feature. A task gives one row
    a feature at most, and so does the sum that comes to the driver."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(FEATURES + 1, np.int64)
        for pdf in batches:
            for text in pdf["text"]:
                total[gram_counts(text)[0]] += 1
                total[FEATURES] += 1
        has = np.flatnonzero(total)
        yield pd.DataFrame({"feature": has, "n": total[has]})

    counts = docs.select("text").mapInPandas(each, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    total = np.zeros(FEATURES + 1, np.int64)
    for r in counts.collect():
        total[r["feature"]] = r["n"]
    return int(total[FEATURES]), total[:FEATURES]


@dataclass
class LanguageModel:
    """Languages in code point order, idf a feature, weights with the bias last."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float = 1.0

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """TF-IDF of unit length, sparse, with the bias at the end."""
        has, counts = gram_counts(text)
        x = counts * self.idf[has]
        return np.append(has, FEATURES), np.append(x / max(np.sqrt(x @ x), 1e-12), 1.0)

    def probabilities(self, text: str) -> np.ndarray:
        at, x = self.vector(text)
        odds = x @ self.weights[at] / self.temperature
        odds = np.exp(odds - odds.max())
        return odds / odds.sum()

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not _LETTER.search(text):
            return UNKNOWN, 0.0
        p = self.probabilities(text)
        best = int(np.argmax(p))
        return self.languages[best], float(p[best])


def _leader(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Weights of the regularised leader: zero within the L1 penalty, else shrunk."""
    kept = np.where(np.abs(z) > L1, np.sign(z) * L1 - z, 0.0)
    return kept / ((BETA + np.sqrt(n)) / ALPHA + L2)


def fit(labels: list[str], texts: list[str], idf: np.ndarray, seed: int = 1) -> LanguageModel:
    languages = sorted(set(labels))
    model = LanguageModel(languages, idf, np.zeros((FEATURES + 1, len(languages))))
    if not languages:
        return model
    y = np.array([languages.index(x) for x in labels])
    rows = [model.vector(t) for t in texts]
    learned = [i for i in range(len(rows)) if i % CALIBRATION] or list(range(len(rows)))
    z, n = np.zeros_like(model.weights), np.zeros_like(model.weights)
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in rng.permutation(learned):
            at, x = rows[i]
            w = _leader(z[at], n[at])
            odds = x @ w
            p = np.exp(odds - odds.max())
            p /= p.sum()
            p[y[i]] -= 1
            slope = np.outer(x, p)
            squared = n[at] + slope * slope
            z[at] += slope - (np.sqrt(squared) - np.sqrt(n[at])) / ALPHA * w
            n[at] = squared
    model.weights = _leader(z, n)
    held = [i for i in range(len(rows)) if i % CALIBRATION == 0]
    odds = np.array([rows[i][1] @ model.weights[rows[i][0]] for i in held])

    def loss(log_t: float) -> float:
        scaled = odds / np.exp(log_t)
        top = scaled.max(axis=1)
        return float((np.log(np.exp(scaled - top[:, None]).sum(axis=1)) + top - scaled[np.arange(len(held)), y[held]]).mean())

    model.temperature = float(np.exp(min(np.linspace(-3, 3, 121), key=loss)))
    return model


def fit_language(docs: DataFrame, skip: int = 0, parts: int = 5) -> LanguageModel:
    """Fit on (doc_id, text, lang) rows whose id's crc32 modulo ``parts`` isn't
    ``skip``: frequencies over all of them, weights on a sample of those that have
    a language. Null texts count as empty."""
    mine = docs.where(id_remainder(F.col("doc_id"), parts) != skip).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang")
    total, having = document_frequencies(mine)
    idf = np.log((1 + total) / (1 + having)) + 1
    # Ids may repeat with other texts, so a language goes with the hash of its text.
    known = mine.where("lang is not null").select("doc_id", F.xxhash64("text").alias("key"), F.col("lang").alias("label"))
    sample = labelled_sample(known, mine, SAMPLE_ROWS, SAMPLE_CHARS)
    return fit(sample["label"].tolist(), sample["text"].tolist(), idf)


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` (one named ``predicted`` gives way) and ``predicted``
    (lang, score), a struct, of each row by itself, repeated rows too. Texts are read
    whole, however long; an empty table gives an empty result. Null texts and texts without a letter are ``und`` with score 0, and so is every
    text if there was no language to learn."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # features x languages, whatever the data

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = sent.value
        for texts in batches:
            yield pd.DataFrame([model.predict(t) for t in texts], columns=["lang", "score"])

    return docs.withColumn("predicted", predict(F.col(text_col).cast("string")))


@register("op7_language_id")
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    return identify(docs.select("doc_id", "text"), fit_language(docs)).select(
        "doc_id",
        (id_remainder(F.col("doc_id"), 5) == 0).alias("held_out"),
        F.col("predicted.lang").alias("lang_pred"),
        "predicted.score",
    )
