"""SimHash near-dedup with a Gray-order hierarchical index.

Fingerprints within ``max_bits`` differing bits are linked; linked documents form
components. Two fingerprints that close agree on all but ``max_bits`` of the bit
blocks, so they meet under one choice of ``blocks - max_bits`` blocks (of six blocks, a
pair). The blocks' pattern is the root of an index: the fingerprints below it are sorted
by Gray rank, runs of them share masked bit patterns that go into upper nodes, and a
search adds up the differing bits from node to node and drops a whole run once they
exceed the limit. The more fingerprints there are, the more blocks are shared, so that
chance meetings below a root don't grow with the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxpop.llm.common import documents, save
from voxpop.llm.registry import register

SHINGLE, MAX_BITS, SEED = 4, 4, 42
#: Children of an index node.
FAN = 16
#: Fingerprints under one root that are searched together; of more, every two parts of
#: about this many are. Random fingerprints stay below half of it (see block_count).
TILE = 1024
#: Frontier pairs (fingerprint, node) that a search holds at once.
FRONTIER = 1 << 20
#: Shingle hashes whose bits are counted at once.
COUNTED = 1 << 14


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """Fingerprint of a whole text: bit i is set where over half of the shingles'
    XXH64 have it. ``bytes.lower`` changes A-Z alone and ``bytes.split`` cuts at
    ASCII blanks."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - shingle + 1].tolist()
    stops = (ends[shingle - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, stops)), np.uint64, len(starts))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), COUNTED):
        part = hashes[at : at + COUNTED].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """doc_id, key (a hash of the text), fp (the fingerprint's 64 bits as a signed long)."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fps = np.array([simhash(t, shingle) for t in pdf["text"]], np.uint64).astype(np.int64)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "key": pdf["key"], "fp": fps})

    text = F.col(text_col).cast("string")
    # Ids go round the workers as text: pandas has no null in its long type.
    rows = docs.select(F.col(id_col).cast("long").cast("string").alias("doc_id"), text_key(text).alias("key"), text.alias("text"))
    out = rows.mapInPandas(each, "doc_id string, key long, fp long")
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def text_key(text: Column) -> Column:
    """Tells rows apart that share an id."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def gray_rank(fp: Column) -> Column:
    """Place of a bit pattern in the reflected Gray code: its prefix parities."""
    rank = fp
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank


def block_count(fingerprints: int, max_bits: int) -> int:
    """Number of even bit blocks so that random fingerprints have at most half a tile
    below a root: six up to some 2^30 of them, seven up to 2^36 (for four bits)."""
    blocks = max_bits + 2
    while fingerprints > TILE / 2 * 2.0 ** (64 * (blocks - max_bits) // blocks) and blocks < 2 * max_bits + 2:
        blocks += 1
    return blocks


def block_masks(max_bits: int, blocks: int) -> list[int]:
    """Masks of all choices of ``blocks - max_bits`` blocks."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [reduce(int.__or__, chosen) for chosen in combinations(masks, blocks - max_bits)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


# -- the index, within a task ------------------------------------------------


def _runs(group: np.ndarray, fan: int) -> np.ndarray:
    """First places of runs of at most ``fan`` neighbours of the same group."""
    new = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    at = np.arange(len(group)) - np.repeat(new, np.diff(np.r_[new, len(group)]))
    return np.flatnonzero(at % fan == 0)


def _expand(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges first[i]..last[i]-1: the i and the member of each."""
    n = np.maximum(last - first, 0)
    owner = np.repeat(np.arange(len(n)), n)
    return owner, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[owner]


class GrayIndex:
    """Nodes over codes that are sorted by (group, Gray rank).

    ``levels[0]`` has the leaf runs, each further one runs of the level below, up
    to one that has at most ``FAN`` nodes a group. A node keeps the bits which all
    its codes share and the mask of those that its parent doesn't already share.
    """

    def __init__(self, group: np.ndarray, codes: np.ndarray):
        self.codes, self.levels = codes, []
        low = high = codes
        while True:
            starts = _runs(group, FAN)
            low, high = np.bitwise_and.reduceat(low, starts), np.bitwise_or.reduceat(high, starts)
            self.levels.append({"starts": starts, "n": len(group), "bits": low, "mask": ~(low ^ high)})
            group = group[starts]
            if len(starts) == self.levels[-1]["n"] or np.bincount(group - group[0]).max() <= FAN:
                break
        self.group = group
        for lower, upper in zip(self.levels, self.levels[1:]):
            parent = np.repeat(np.arange(len(upper["starts"])), np.diff(np.r_[upper["starts"], len(lower["starts"])]))
            lower["own"] = lower["mask"] & ~upper["mask"][parent]
        self.levels[-1]["own"] = self.levels[-1]["mask"]

    def pairs(self, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All pairs of places (i < j) of one group within ``max_bits`` bits."""
        n = len(self.codes)
        node = np.arange(n)
        for level in self.levels:
            node = np.searchsorted(level["starts"], node, "right") - 1
        ends = np.searchsorted(self.group, self.group, "right")
        lasts = ends[node]  # a code looks from its own top node on
        step = np.cumsum(lasts - node)
        for cut in np.split(np.arange(n), np.searchsorted(step, np.arange(FRONTIER, step[-1], FRONTIER))):
            if len(cut):
                yield from self._search(cut, node[cut], lasts[cut], max_bits, len(self.levels) - 1, np.zeros(len(cut), np.int64))

    def _search(self, q, first, last, max_bits, depth, so_far):
        level = self.levels[depth]
        for at in range(0, len(q), FRONTIER // FAN):
            part = slice(at, at + FRONTIER // FAN)
            owner, node = _expand(first[part], last[part])
            asked, acc = q[part][owner], so_far[part][owner]
            differ = (self.codes[asked] ^ level["bits"][node]) & level["own"][node]
            acc = acc + np.bitwise_count(differ)
            stay = acc <= max_bits
            asked, node, acc = asked[stay], node[stay], acc[stay]
            below = np.r_[level["starts"], level["n"]]
            if depth:
                yield from self._search(asked, below[node], below[node + 1], max_bits, depth - 1, acc)
                continue
            owner, other = _expand(np.maximum(below[node], asked + 1), below[node + 1])
            left = (self.codes[asked[owner]] ^ self.codes[other]) & ~level["mask"][node[owner]]
            known = np.bitwise_count((self.codes[asked] ^ level["bits"][node]) & level["mask"][node])
            near = known[owner] + np.bitwise_count(left) <= max_bits
            yield asked[owner[near]], other[near]


def smallest_reachable(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Least place that each of ``n`` places reaches over the pairs."""
    root = np.arange(n)

    def flat(root):
        while True:
            up = root[root]
            if np.array_equal(up, root):
                return root
            root = up

    for a, b in pairs:
        while True:
            ra, rb = root[a], root[b]
            differ = ra != rb
            if not differ.any():
                break
            np.minimum.at(root, np.maximum(ra, rb)[differ], np.minimum(ra, rb)[differ])
            root = flat(root)
    return root


def _linked(max_bits: int):
    """mapInPandas body: rows sorted by search group in, star links out. A group
    that a batch ends in is carried over to the next."""
    key = ["pair", "bits", "a", "b"]

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        cols = [pdf[k].to_numpy() for k in key]
        new = np.zeros(len(pdf), bool)
        new[0] = True
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        codes = pdf["fp"].to_numpy().astype(np.uint64)
        root = smallest_reachable(len(codes), GrayIndex(np.cumsum(new) - 1, codes).pairs(max_bits))
        tied = np.flatnonzero(root != np.arange(len(root)))
        x, y = codes[root[tied]].astype(np.int64), codes[tied].astype(np.int64)
        return pd.DataFrame({"x": np.minimum(x, y), "y": np.maximum(x, y)}).drop_duplicates()

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for pdf in batches:
            if not len(pdf):
                continue
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            end = pdf[key].iloc[-1]
            same = np.logical_and.reduce([pdf[k].to_numpy() == end[k] for k in key])
            first = int(np.argmax(same))
            held = pdf.iloc[first:]
            if first:
                yield links(pdf.iloc[:first])
        if held is not None:
            yield links(held)

    return each


def near_links(nodes: DataFrame, max_bits: int, blocks: int | None = None) -> DataFrame:
    """Links (x < y) between fingerprints, enough to connect all that reach each
    other in steps of at most ``max_bits`` bits. ``nodes`` has distinct ``fp``."""
    blocks = blocks or block_count(nodes.count(), max_bits)
    masks = [_signed(m) for m in block_masks(max_bits, blocks)]
    keyed = nodes.select(
        "fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("pair", "bits")
    )
    # One row a root, made map-side first. Single fingerprints link nothing, two are the
    # least and the largest; only what is below roots of three or more is moved again.
    roots = keyed.groupBy("pair", "bits").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("x"), F.max("fp").alias("y"))
    roots = save(roots.where((F.col("n") > 2) | (F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= max_bits)).where("n > 1"), "op9-roots")
    twos = roots.where("n = 2").select("x", "y")
    crowds = roots.where("n > 2").select(F.col("pair").alias("p"), F.col("bits").alias("k"), F.ceil(F.col("n") / TILE).cast("int").alias("tiles"))
    met = keyed.join(crowds, (F.col("pair") == F.col("p")) & (F.col("bits") == F.col("k")))
    mine = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    tiled = met.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    grouped = tiled.select(
        "pair", "bits", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"), "fp", gray_rank(F.col("fp")).alias("gray")
    )
    grouped = grouped.repartition("pair", "bits", "a", "b").sortWithinPartitions("pair", "bits", "a", "b", "gray")
    return grouped.mapInPandas(_linked(max_bits), "x long, y long").unionByName(twos).distinct()


# -- components --------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """(fp, root) for every end of a link: root is the least fp that it reaches.

    Rounds of large-star and small-star: each vertex ties its larger, then its
    smaller neighbours to the least of them, until nothing changes. Minima are
    made map-side first, joins on a hub are split at run time, and each round is
    written, so a lost executor costs one round at most.
    """
    edges = save(links.select(F.col("y").alias("v"), F.col("x").alias("m")), "op9-links")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("m").alias("v"), F.col("v").alias("m")))
        least = both.groupBy(F.col("v").alias("c")).agg(F.min("m").alias("low"))
        least = save(least.withColumn("low", F.least("c", "low")), "op9-low")
        large = both.join(least, F.col("v") == F.col("c")).where(F.col("m") > F.col("v")).select(F.col("m").alias("v"), F.col("low").alias("m"))
        large = save(large.distinct(), "op9-large")
        down = large.groupBy(F.col("v").alias("c")).agg(F.min("m").alias("low"))
        down = save(down, "op9-down")
        tied = large.join(down, F.col("v") == F.col("c"))
        small = tied.where(F.col("m") != F.col("low")).select(F.col("m").alias("v"), F.col("low").alias("m"))
        edges = save(small.unionByName(down.select(F.col("c").alias("v"), F.col("low").alias("m"))).distinct(), "op9-edges")
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("v", "m").cast("decimal(20,0)")).alias("h")).first()
        if now == state:
            return edges.select(F.col("v").alias("fp"), F.col("m").alias("root"))
        state = now


def near_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row a row of ``docs``: doc_id, key, fp (signed long), component_id (the
    smallest id reachable over fingerprints at most ``max_bits`` bits apart).

    A text without words, null or empty, has fingerprint 0, linked like any other;
    one of fewer words than ``shingle`` is one shingle. Null ids aren't candidates
    for a component's id, which is null where all are. Other columns aren't read;
    an empty table gives an empty result.
    """
    return _rooted(docs, id_col, text_col, shingle, max_bits).drop("root")


def _rooted(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``near_dedup`` and ``root``, the fingerprint that names the component."""
    fps = save(with_fingerprints(docs, id_col, text_col, shingle), "op9-fps")
    nodes = save(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "op9-nodes")
    roots = components(near_links(nodes.select("fp"), max_bits))
    rooted = save(
        nodes.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "op9-rooted"
    )
    ids = save(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "op9-ids")
    named = save(rooted.join(ids, "root").select("fp", "root", "component_id"), "op9-named")
    return fps.join(named, "fp").select("doc_id", "key", "fp", "component_id", "root")


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, of which each component keeps one: that of
    its smallest id, or of its smallest text key where it has no id at all; of rows
    that share id and text, one."""
    groups = _rooted(docs, id_col, text_col, **options)
    nobody = F.lit(-(2**63))
    # Null ids last; one row a component, made map-side first.
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")
    stay = groups.groupBy("root").agg(F.min(first).alias("first"))
    stay = stay.select(F.coalesce("first.doc_id", nobody).alias("__id"), F.col("first.key").alias("__key"))
    rows = docs.withColumn("__id", F.coalesce(F.col(id_col).cast("long"), nobody)).withColumn("__key", text_key(F.col(text_col)))
    return rows.join(stay, ["__id", "__key"], "left_semi").dropDuplicates(["__id", "__key"]).select(*docs.columns)


@register("op9_simhash_dedup")
def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(documents(spark, sf_dir)).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
