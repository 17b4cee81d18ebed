"""Quality classifier on supervised subword embeddings.

A document is the average of its words, a word the average of the learned vectors
of the word and its character n-grams, found by hash. A word that repeats the one
before it counts as a word of its own kind. A softmax layer scores the
average; both layers are fitted by numpy stochastic gradient descent on a bounded
sample. As the score is linear in the average, a word's share of it is one number.
"""

from __future__ import annotations

from collections import Counter
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
BITS, DIM = 18, 16
BUCKETS = 1 << BITS
SHORTEST, LONGEST = 3, 5
EPOCHS, RATE = 6, 1.0
THRESHOLD = 0.7
#: Words whose numbers a worker keeps.
CACHED = 200_000
#: Characters of texts whose new words are hashed together.
TOGETHER = 500_000
#: An odd multiplier that spreads hashes.
SPREAD = np.uint32(0x9E3779B1)
#: Stands for the end of a text, so that an empty one has a vector too.
END = "\n"
#: Stands for a word that repeats the one before it.
AGAIN = "\n\n"


def words_of(text: str | None) -> list[str]:
    """The words of a text and its end."""
    found = (text or "").split()
    return [w if w != last else AGAIN for w, last in zip(found, [END, *found])] + [END]


def word_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of words and of their character n-grams, as (place of the word,
    bucket); < and > are a word's borders. All words are hashed at once."""
    points = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "replace"), "<u4").astype(np.uint32)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.cumsum(lengths) - lengths
    word = np.repeat(np.arange(len(words)), lengths)
    at = np.arange(len(points)) - starts[word]
    powers = np.multiply.accumulate(np.full(int(lengths.max()), SPREAD, np.uint32), dtype=np.uint32)
    owners, hashes = [np.arange(len(words))], [np.add.reduceat(points * powers[at], starts, dtype=np.uint32)]
    value = np.zeros(len(points), np.uint32)
    for n in range(1, LONGEST + 1):
        if len(points) < n:
            break
        value = (value[: len(points) - n + 1] ^ points[n - 1 :]) * SPREAD
        value ^= value >> np.uint32(15)
        if n >= SHORTEST:
            inside = np.flatnonzero(at[: len(value)] + n <= lengths[word[: len(value)]])
            owners.append(word[inside])
            hashes.append(value[inside] + np.uint32(n))
    return np.concatenate(owners), (np.concatenate(hashes) * SPREAD) >> np.uint32(32 - BITS)


def document_weights(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a document and their parts of its average."""
    words = Counter(words_of(text))
    owner, bucket = word_buckets(list(words))
    counts = np.fromiter(words.values(), np.float64, len(words))
    parts = (counts / counts.sum() / np.bincount(owner))[owner]
    own, at = np.unique(bucket, return_inverse=True)
    return own, np.bincount(at, weights=parts).astype(np.float32)


@dataclass
class SubwordModel:
    """One number a bucket: the log odds of label 1 that its vector adds."""

    numbers: np.ndarray
    bias: float = 0.0
    learned: bool = True

    def scorer(self):
        """A function from texts to scores that keeps the numbers of words it has met."""
        known: dict[str, float] = {}

        def part_scores(lists: list[list[str]]) -> Iterator[float]:
            new = list(set().union(*lists).difference(known))
            if new:
                if len(known) + len(new) > CACHED:
                    known.clear()
                    new = list(set().union(*lists))
                owner, bucket = word_buckets(new)
                sums = np.bincount(owner, weights=self.numbers[bucket]) / np.bincount(owner)
                known.update(zip(new, sums.tolist()))
            for words in lists:
                value = sum(map(known.__getitem__, words)) / len(words) + self.bias
                yield float(1 / (1 + np.exp(-np.clip(value, -50, 50))))

        def scores(texts) -> Iterator[float]:
            lists, chars = [], 0
            for text in texts:
                lists.append(words_of(text))
                chars += len(text or "")
                if chars > TOGETHER:
                    yield from part_scores(lists)
                    lists, chars = [], 0
            if lists:
                yield from part_scores(lists)

        return scores


def fit(labels: np.ndarray, texts: list[str], seed: int = 1) -> SubwordModel:
    """Fit both layers. Without two classes there's nothing to learn: the score is
    the share of label 1 (one half without any row)."""
    if len(set(labels.tolist())) < 2:
        share = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3)) if len(labels) else 0.5
        return SubwordModel(np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share))), False)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    layer = np.zeros((2, DIM), np.float32)
    rows = [document_weights(t) for t in texts]
    steps, done = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            rate = RATE * (1 - done / steps)
            ids, parts = rows[i]
            own = vectors[ids]
            mean = parts @ own
            odds = layer @ mean
            odds = np.exp(odds - odds.max())
            miss = odds / odds.sum()
            miss[labels[i]] -= 1
            back = miss @ layer
            layer -= rate * np.outer(miss, mean)
            # A part is small, as there are many; its step is scaled to the largest.
            vectors[ids] = own - rate * np.outer(parts / parts.max(), back)
            done += 1
    return SubwordModel(vectors @ (layer[1] - layer[0]))


def fit_quality(docs: DataFrame, labels: DataFrame, skip: int = 2, parts: int = 4) -> SubwordModel:
    """Fit on a sample of the labelled documents whose id's crc32 modulo ``parts``
    isn't ``skip``; other labels are never looked at. Rows without id or label
    are left out."""
    known = labels.select("doc_id", F.col("quality").cast("int").alias("label"))
    known = known.where((id_remainder(F.col("doc_id"), parts) != skip) & F.col("label").isin(0, 1))
    sample = labelled_sample(known, docs, SAMPLE_ROWS, SAMPLE_CHARS)
    return fit(sample["label"].to_numpy(np.int64), sample["text"].tolist())


def score_texts(docs: DataFrame, model: SubwordModel, text_col: str = "text", out: str = "score") -> DataFrame:
    """All columns of ``docs`` (one named ``out`` gives way) and the score of the
    whole text, however long, 0 to 1; null counts as empty, which has a score as well.
    Each row is scored by itself, repeated rows too; an empty table gives an empty result."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a number a bucket, whatever the data

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = sent.value.scorer()
        for texts in batches:
            yield pd.Series(list(of(texts)), dtype="float64")

    return docs.withColumn(out, score(F.col(text_col).cast("string")))


@register("op4_quality_classifier")
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_texts(docs, model).select(
        "doc_id",
        (id_remainder(F.col("doc_id"), 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
