"""Alignment of two tokenisations of a text, between whitespace-token anchors.

Both tokenisers run over the whole text. Where both have a token end and both go on
with a token that is marked with a space, the text is cut; between two such anchors
lies a window, two short tuples of token ids. Words come back all the time, and so do
their windows: what a window's tokens share is worked out once per pair of id tuples
and remembered. How many documents link two ids is counted over the corpus, and each
document is joined with the counts of its own links.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxpop.llm.common import documents, join_few, save
from voxpop.llm.registry import register

#: Windows that a worker remembers; beyond, it forgets all and goes on.
REMEMBERED = 200_000
#: Windows of more links aren't remembered.
LONG = 64
#: Texts and characters that are aligned together, at most (one text may be longer).
TEXTS, CHARS = 500, 1 << 20
#: Id pairs that are sent to every task; beyond, they're joined by a shuffle.
PAIRS_SENT = 500_000


@lru_cache(maxsize=2)
def byte_tokens(path: str):
    """Encoder and the bytes of each id of a byte-level BPE, from its rank file. The
    ids are those of the ``tokenizers`` file of the same vocabulary (tested), and no
    string in a text is special."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoding = tiktoken.Encoding("alignment", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        tokens[i] = token
    return encoding, tokens


@lru_cache(maxsize=2)
def piece_tokens(path: str):
    """Encoder (of several texts) and the bytes of each id of a sentencepiece model."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    tokens = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            tokens.append(bytes([int(piece[3:5], 16)]))
        elif model.is_unknown(i) or model.is_control(i):
            tokens.append(b"")
        else:
            tokens.append(piece.replace("▁", " ").encode())
    return (lambda texts: model.encode(texts, num_threads=1)), tokens


class Aligner:
    """Aligns whole texts; keeps the alignments of windows by their id tuples."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.a_tokens = byte_tokens(a_path)
        self.b_encode, self.b_tokens = piece_tokens(b_path)
        self.a_sizes, self.b_sizes = ([len(t) for t in tokens] for tokens in (self.a_tokens, self.b_tokens))
        self.a_space, self.b_space = (np.array([t.startswith(b" ") for t in tokens]) for tokens in (self.a_tokens, self.b_tokens))
        self.a_lengths, self.b_lengths = np.array(self.a_sizes), np.array(self.b_sizes)
        self.a_array, self.b_array = (pa.array(tokens, pa.large_binary()) for tokens in (self.a_tokens, self.b_tokens))
        self.a_bits, self.b_bits = (len(tokens).bit_length() for tokens in (self.a_tokens, self.b_tokens))
        #: Each id as it's written before another of its side, before the B tokens, before the next group.
        self.written = pa.array([f"{i}{mark}" for i in range(max(len(self.a_tokens), len(self.b_tokens))) for mark in ",|;"], pa.large_string())
        self.known: dict[tuple[tuple[int, ...], tuple[int, ...]], tuple[str, int, np.ndarray]] = {}

    def windows(self, keys: list[tuple[tuple[int, ...], tuple[int, ...]]]) -> list[tuple[str, int, np.ndarray]]:
        """Alignments of pairs of id tuples, new ones worked out and remembered."""
        found = list(map(self.known.get, keys))
        missing = [at for at, one in enumerate(found) if one is None]
        if missing:
            for at, new in zip(missing, self.align_windows([keys[at] for at in missing])):
                found[at] = new
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                if len(new[2]) <= LONG:
                    self.known[keys[at]] = new
        return found

    def align_windows(self, keys: list[tuple[tuple[int, ...], tuple[int, ...]]]) -> Iterator[tuple[str, int, np.ndarray]]:
        """Groups as text, each followed by a semicolon, their number, and the links
        (a << 32 | b) of windows: two tuples of ids with the same bytes each."""
        a, b = zip(*keys)
        n_a, n_b = (np.fromiter(map(len, side), np.int64, len(keys)) for side in (a, b))
        a_ids, b_ids = np.fromiter(chain.from_iterable(a), np.int64, n_a.sum()), np.fromiter(chain.from_iterable(b), np.int64, n_b.sum())
        a_ends, b_ends = self.a_lengths[a_ids].cumsum(), self.b_lengths[b_ids].cumsum()
        ended_a, ended_b = np.zeros((2, a_ends[-1] + 1), bool)
        ended_a[a_ends] = ended_b[b_ends] = True
        # Between two ends, whichever side's, one A token and one B token overlap.
        ends, shared = np.flatnonzero(ended_a | ended_b), np.flatnonzero(ended_a & ended_b)
        links = a_ids[np.searchsorted(a_ends, ends)] << 32 | b_ids[np.searchsorted(b_ends, ends)]
        window_ends = a_ends[n_a.cumsum() - 1]
        linked, grouped = (np.searchsorted(at, window_ends, "right") for at in (ends, shared))
        # A group's A tokens stand before its B tokens.
        a_group, b_group = np.searchsorted(shared, a_ends), np.searchsorted(shared, b_ends)
        order = np.empty(len(a_ids) + len(b_ids), np.int64)
        order[np.arange(len(a_ids)) + np.searchsorted(b_group, a_group)] = a_ids * 3 + ended_b[a_ends]
        order[np.arange(len(b_ids)) + np.searchsorted(a_group, b_group, "right")] = b_ids * 3 + 2 * ended_a[b_ends]
        text = self.written.take(pa.array(order))
        offsets = np.frombuffer(text.buffers()[1], np.int64)[np.append(0, (n_a + n_b).cumsum())]
        texts = pa.LargeStringArray.from_buffers(len(keys), pa.py_buffer(offsets.tobytes()), text.buffers()[2]).to_pylist()
        at = [0, *linked.tolist()]
        return zip(texts, np.diff(grouped, prepend=0).tolist(), [links[x:y].copy() for x, y in zip(at, at[1:])])

    def same_bytes(self, ids: list[list[int]], tokens: pa.Array, texts: list[bytes]) -> np.ndarray:
        """Whether the tokens of each text are, joined, its bytes."""
        joined, at = tokens.take(pa.array(np.fromiter(chain.from_iterable(ids), np.int64))), np.cumsum([0, *map(len, ids)])
        offsets = np.frombuffer(joined.buffers()[1], np.int64)[at].tolist() if len(joined) else [0] * len(at)
        raw = memoryview(joined.buffers()[2] or b"")
        return np.array([bytes(raw[i:j]) == text for i, j, text in zip(offsets, offsets[1:], texts)], bool)

    def align(self, texts: list[str]) -> list[tuple]:
        """n_a, n_b, n_groups, n_links, groups_sha256, distinct links and how often
        each stands in the text, of each text."""
        spaced = [(" " + text).encode() for text in texts]
        a, b = [self.a.encode_ordinary(" " + text) for text in texts], self.b_encode(texts)
        whole = self.same_bytes(a, self.a_array, spaced) & self.same_bytes(b, self.b_array, spaced)
        whole &= np.array([text != "" for text in texts], bool)
        rows: list[tuple] = [(0, 0, 0, 0, "", [], [])] * len(texts)
        at = np.flatnonzero(whole).tolist()
        for i, row in zip(at, self.align_whole([a[i] for i in at], [b[i] for i in at])):
            rows[i] = row
        return rows

    def align_whole(self, a: list[list[int]], b: list[list[int]]) -> Iterator[tuple]:
        """The same, of texts whose tokens have the same bytes; all texts' windows of few
        tokens are told apart by one number, so each is looked up once."""
        if not a:
            return
        n_a, n_b = (np.array(list(map(len, side))) for side in (a, b))
        a_list, b_list = (list(chain.from_iterable(side)) for side in (a, b))
        a_ids, b_ids = (np.array(listed, np.int64) for listed in (a_list, b_list))
        a_ends, b_ends = self.a_lengths[a_ids].cumsum(), self.b_lengths[b_ids].cumsum()
        # The tokens after a shared end: where both begin with a space is an anchor.
        ended_b = np.zeros(a_ends[-1] + 1, np.int64)
        ended_b[b_ends] = np.arange(1, len(b_ends) + 1)
        i = np.arange(1, len(a_ids))
        j = ended_b[a_ends[:-1]]
        i, j = i[j > 0], j[j > 0]
        first = np.zeros(len(a_ids), bool)
        first[n_a.cumsum()[:-1]] = True  # so is the begin of a text
        anchor = (self.a_space[a_ids[i]] & self.b_space[b_ids[j]]) | first[i]
        i, j = np.append(0, i[anchor]), np.append(0, j[anchor])
        a_size, b_size = np.diff(i, append=len(a_ids)), np.diff(j, append=len(b_ids))
        few = (a_size <= 63 // self.a_bits) & (b_size <= 63 // self.b_bits)
        short, long = np.flatnonzero(few), np.flatnonzero(~few)
        parts = packed(a_ids, i[short], a_size[short], self.a_bits), packed(b_ids, j[short], b_size[short], self.b_bits)
        (of_a, _), (of_b, listed) = map(pd.factorize, parts)
        codes, distinct = pd.factorize(of_a * len(listed) + of_b)
        code = np.empty(len(i), np.int64)
        code[short], code[long] = codes, len(distinct) + np.arange(len(long))
        one = np.empty(len(distinct) + len(long), np.int64)  # a place of each
        one[code] = np.arange(len(i))
        at = zip(i[one].tolist(), a_size[one].tolist(), j[one].tolist(), b_size[one].tolist())
        groups, numbers, links = zip(*self.windows([(tuple(a_list[i0 : i0 + x]), tuple(b_list[j0 : j0 + y])) for i0, x, j0, y in at]))

        starts = np.searchsorted(i, np.append(0, n_a.cumsum()[:-1]))  # each text's first window
        text = pa.array(groups, pa.large_string()).take(pa.array(code))
        offsets = np.frombuffer(text.buffers()[1], np.int64)[np.append(starts, len(i))].tolist()
        raw = memoryview(text.buffers()[2])
        digests = [hashlib.sha256(raw[x : y - 1]).hexdigest() for x, y in zip(offsets, offsets[1:])]
        n_groups = np.add.reduceat(np.array(numbers)[code], starts)

        size, flat = np.array(list(map(len, links))), np.concatenate(links)
        flat = flat >> 32 << self.b_bits | flat & (1 << 32) - 1
        many, begin = size[code], (size.cumsum() - size)[code]
        n_links = np.add.reduceat(many, starts)
        every = flat[np.repeat(begin - (many.cumsum() - many), many) + np.arange(many.sum())]
        wide = self.a_bits + self.b_bits
        every = np.sort(np.repeat(np.arange(len(a)), n_links) << wide | every)
        new = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
        times, every = np.diff(new, append=len(every)), every[new]
        pairs = (every >> self.b_bits & (1 << self.a_bits) - 1) << 32 | every & (1 << self.b_bits) - 1
        ends = np.searchsorted(every, np.arange(1, len(a)) << wide)
        yield from zip(n_a.tolist(), n_b.tolist(), n_groups.tolist(), n_links.tolist(), digests, np.split(pairs, ends), np.split(times, ends))


def packed(ids: np.ndarray, at: np.ndarray, size: np.ndarray, bits: int) -> np.ndarray:
    """One number for the ``size`` ids from ``at`` on, of as many as fit into 63 bits."""
    ids = np.append(ids + 1, np.zeros(63 // bits, np.int64))
    key = np.zeros(len(at), np.int64)
    for n in range(63 // bits):
        key = key << bits | np.where(n < size, ids[at + n], 0)
    return key


def portions(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Texts that are aligned together: ``TEXTS`` at most, of about ``CHARS`` together."""
    begin = chars = 0
    for at, text in enumerate(texts):
        if at > begin and (at - begin == TEXTS or chars + len(text) > CHARS):
            yield begin, at
            begin, chars = at, 0
        chars += len(text)
    if texts:
        yield begin, len(texts)


def aligned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """One row a document: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and its
    distinct links (``pairs``, as A id << 32 | B id) with their numbers (``times``)."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import public_tokenizers as files

        aligner = Aligner(a_path or files.path("byte_bpe_50k.tiktoken"), b_path or files.path("piece_bpe_32k.model"))
        gc.disable()  # tuples of ids make no cycles, and looking for some takes a quarter of the time
        try:
            for pdf in batches:
                texts = pdf["text"].tolist()
                for begin, end in portions(texts):
                    out = pd.DataFrame(aligner.align(texts[begin:end]), columns=["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])
                    yield out.assign(doc_id=pdf["doc_id"].iloc[begin:end].to_numpy())[["doc_id", *out.columns]]
        finally:
            gc.enable()

    # Ids go round the workers as text: pandas has no null in its long type.
    rows = docs.select(F.col(id_col).cast("long").cast("string").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    out = rows.mapInPandas(
        each, "doc_id string, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"
    )
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def pair_counts(found: DataFrame) -> DataFrame:
    """pair, held (documents that hold it linked), best: whether no other pair of the
    same A id is held by more."""
    counts = found.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("held"))
    counts = counts.withColumn("a", F.shiftright("pair", 32))
    highest = counts.groupBy("a").agg(F.max("held").alias("highest"))
    return counts.join(highest, "a").select("pair", "held", (F.col("held") == F.col("highest")).alias("best"))


def align_tokenizers(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """One row a row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256.

    Null and empty texts, and those that either tokeniser doesn't give back byte by
    byte, have no tokens: zeros, and '' for the digest. Each row is a document of its
    own, also with a null or repeated id. Long texts are aligned whole; only windows of
    more than ``LONG`` links aren't remembered. Other columns aren't read; an empty table gives
    an empty result.
    """
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    # Rows are numbered in the written table, where a number stays what it is.
    found = save(aligned(docs, id_col, text_col, a_path, b_path).withColumn("row", F.monotonically_increasing_id()), "op12-aligned")
    counts = save(pair_counts(found), "op12-pairs")
    links = found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select("row", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"))
    counts = counts.withColumnRenamed("pair", "known")
    joined = join_few(links, counts, F.col("pair") == F.col("known"), PAIRS_SENT)
    sums = joined.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("held")).alias("count_sum")
    )
    out = found.select("row", *columns).join(sums, "row", "left")
    return out.select(*columns[:-1], *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")], "groups_sha256")


@register("op12_token_alignment")
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(documents(spark, sf_dir))
