"""Best-fit packing by patterns: sequences of up to three documents.

Documents become token ids, long ones are cut. The lengths' histogram, of at
most ``SEQUENCE`` counts, is all that the driver sees: it enumerates the patterns
of one to three lengths that fill a sequence, fits their repeat counts to the
histogram by non-negative least squares, rounds them, and packs what is left by
best fit. Tasks then look up each piece's place by its number among the pieces
of its length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxpop.llm.common import documents, number_within, save
from voxpop.llm.registry import register

SEQUENCE = 1024
END = 2
SPECIAL = "<|endoftext|>"
SPECIAL_ID = 50256


@lru_cache(maxsize=2)
def encoder(ranks_path: str):
    """The byte-level BPE of ``ranks_path``; its ids are those of the ``tokenizers``
    file of the same vocabulary, at a fraction of the time."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={SPECIAL: SPECIAL_ID})


def ranks_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def token_ids(text: str | None, ranks_path: str) -> np.ndarray:
    """Ids of a whole text, with the end id, as little-endian 32-bit numbers."""
    text = text or ""
    try:
        ids = encoder(ranks_path).encode_to_numpy(text, allowed_special="all")
    except UnicodeEncodeError:  # half of a surrogate pair, which Parquet can't hold
        ids = encoder(ranks_path).encode_to_numpy(text.encode("utf-8", "replace").decode(), allowed_special="all")
    return np.append(ids, END).astype("<u4")


def pieces_of(docs: DataFrame, id_col: str, text_col: str, length: int, ranks_path: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: each document's ids cut so that
    all pieces but the first are full."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path = ranks_path or ranks_file()
        for pdf in batches:
            rows = []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                ids = token_ids(text, path)
                first = len(ids) % length or min(length, len(ids))
                ends = [first, *range(first + length, len(ids) + 1, length)]
                start = 0
                for piece, end in enumerate(ends):
                    rows.append((doc_id, piece, start, end - start, zlib.crc32(ids[start:end].tobytes())))
                    start = end
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    # Ids go round the workers as text: pandas has no null in its long type.
    rows = docs.select(F.col(id_col).cast("long").cast("string").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInPandas(each, "doc_id string, piece int, start long, length long, ids_crc32 long")
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


# -- the plan, from the histogram ---------------------------------------------


def patterns(length: int) -> np.ndarray:
    """All multisets of one, two or three lengths that sum to ``length``; rows of
    three, 0 for none."""
    whole = np.array([[length, 0, 0]])
    a = np.arange(1, length // 2 + 1)
    two = np.stack([a, length - a, np.zeros_like(a)], axis=1)
    three = [np.stack([np.full_like(b, x), b, length - x - b], axis=1) for x in range(1, length // 3 + 1) for b in [np.arange(x, (length - x) // 2 + 1)]]
    return np.concatenate([whole, two, *three])


def fit_counts(pats: np.ndarray, histogram: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Repeat counts x >= 0 that least-squares fit sum of patterns to the
    histogram, by accelerated projected gradient steps."""
    n = len(histogram)
    used = pats > 0

    def made(x):
        return sum(np.bincount(pats[used[:, i], i], weights=x[used[:, i]], minlength=n) for i in range(3))

    def grad(x):
        miss = made(x) - histogram
        miss[0] = 0
        return miss[pats].sum(axis=1)

    step = np.ones(len(pats))
    for _ in range(20):  # largest eigenvalue, for the step size
        miss = made(step)
        miss[0] = 0
        step = miss[pats].sum(axis=1)
        scale = np.linalg.norm(step)
        step /= scale
    x = ahead = np.zeros(len(pats))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(ahead - grad(ahead) / scale, 0)
        grown = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / grown * (new - x)
        x, t = new, grown
    return x


def best_fit(counts: dict[int, int], length: int) -> list[tuple[tuple[int, ...], int]]:
    """Pack counted lengths, longest first, each into the fullest open sequence
    that has room. Equal sequences are kept as one with a count, so the work
    follows the number of lengths and not of documents."""
    room: dict[int, list[list]] = {}  # space left -> [pattern, count]
    for size in sorted(counts, reverse=True):
        n = counts[size]
        while n:
            space = min((s for s in room if s >= size), default=None)
            if space is None:
                per = length // size
                if n >= per:
                    room.setdefault(length - per * size, []).append([(size,) * per, n // per])
                if n % per:
                    room.setdefault(length - (n % per) * size, []).append([(size,) * (n % per), 1])
                break
            group = room[space][-1]
            take = min(n, group[1])
            room.setdefault(space - size, []).append([(*group[0], size), take])
            group[1] -= take
            n -= take
            if not group[1]:
                room[space].pop()
                if not room[space]:
                    del room[space]
    return [(pattern, count) for groups in room.values() for pattern, count in groups]


def plan(histogram: np.ndarray, length: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how often) such that every counted length is used
    exactly once: rounded fitted patterns first, largest counts first and never
    beyond what the histogram has, then best fit for the residuals."""
    left = histogram.astype(np.int64).copy()
    pats = patterns(length)
    x = np.rint(fit_counts(pats, histogram.astype(float)) if left.any() else np.zeros(len(pats))).astype(np.int64)
    out = []
    for i in np.argsort(-x, kind="stable"):
        if not x[i]:
            break
        sizes, times = np.unique(pats[i][pats[i] > 0], return_counts=True)
        n = min(int(x[i]), int((left[sizes] // times).min()))
        if n:
            left[sizes] -= n * times
            out.append((tuple(int(s) for s in pats[i] if s), n))
    return out + best_fit({int(s): int(left[s]) for s in np.flatnonzero(left)}, length)


def places(planned: list[tuple[tuple[int, ...], int]], length: int) -> dict[int, np.ndarray]:
    """Per length, rows (first number, first sequence, offset): the pieces of that
    length from this number on go to consecutive sequences at this offset."""
    rows: dict[int, list] = {}
    given: dict[int, int] = {}
    sequence = 0
    for sizes, n in planned:
        offset = 0
        for size in sizes:
            rows.setdefault(size, []).append((given.get(size, 0), sequence, offset))
            given[size] = given.get(size, 0) + n
            offset += size
        sequence += n
    return {size: np.array(r, dtype=np.int64) for size, r in rows.items()}


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = SEQUENCE) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is one piece, the end id. Every row of ``docs`` is packed,
    also repeated ones; equal pieces may swap places. Other columns aren't read; an
    empty table gives an empty result.
    """
    # The row number tells equal pieces apart; fixed once it's written.
    pieces = save(pieces_of(docs, id_col, text_col, length).withColumn("row", F.monotonically_increasing_id()), "op10-pieces")
    histogram = np.zeros(length + 1, np.int64)
    for r in pieces.groupBy("length").count().collect():  # at most ``length`` rows
        histogram[r["length"]] = r["count"]
    table = places(plan(histogram, length), length)

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sequence, offset = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
            sizes, numbers = pdf["length"].to_numpy(), pdf["number"].to_numpy()
            for size in np.unique(sizes):
                here = np.flatnonzero(sizes == size)
                rows = table[int(size)]
                at = np.searchsorted(rows[:, 0], numbers[here], "right") - 1
                sequence[here] = rows[at, 1] + numbers[here] - rows[at, 0]
                offset[here] = rows[at, 2]
            yield pdf.drop(columns="number").assign(sequence_id=sequence, offset=offset)

    numbered = number_within(pieces, "length", ["doc_id", "piece", "ids_crc32", "row"], "number").drop("row")
    numbered = numbered.withColumn("doc_id", F.col("doc_id").cast("string"))
    packed = numbered.mapInPandas(
        each, "doc_id string, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
    return packed.withColumn("doc_id", F.col("doc_id").cast("long"))


@register("op10_packing")
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))
