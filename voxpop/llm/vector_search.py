"""Nearest neighbours by cosine: probed lists, scanned over ever more dimensions.

Vectors are scaled to length one and turned by a random rotation, so that the first
dimensions of a difference say how long the whole is likely to be. Every vector goes
to the list of its nearest centre, and a list is kept as chunks: matrices cut into
blocks of columns. A query scans the chunks of the lists nearest to it, block by
block; after each, a hypothesis test drops the candidates whose partial distance is
too long for the nearest found so far. What is left at the last block is compared by
the exact cosine of the original vectors.

Equal vectors are one class, with the ids that can come into a result at all.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voxpop.llm.common import save
from voxpop.llm.registry import register
from voxpop.llm.samples import first_by_hash

NEAREST = 5
EVERY = 50
#: Classes a list holds on average, and lists at most.
PER_LIST = 128
MOST_LISTS = 4096
#: A query scans as many lists as hold this share of the true neighbours of the trial
#: queries, of which there are at most so many.
RECALL = 0.96
TRIALS = 256
#: Centres are fitted on so many classes a list, and so many numbers in all, at most;
#: of these classes so many give each query a first distance to beat.
FIT_PER_LIST = 32
FIT_NUMBERS = 4_000_000
SEEDS = 4096
#: Rows of a chunk and queries of a tile, about; lists side by side on a shelf, and
#: columns of a block.
CHUNK = 2048
TILE = 512
SHELF = 16
COLUMNS = 8
#: Strictness of the hypothesis test: a candidate goes when its partial distance,
#: scaled up, is over (1 + SURE / sqrt(columns seen))^2 times the distance to beat.
SURE = 2.1
#: Rounding of distances between unit vectors.
ROUNDING = 1e-9
SEED = 11

FOUND = ["query", "class", "no_id", "id", "score"]


@lru_cache(maxsize=4)
def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def turned(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors, rotated."""
    return (vectors / lengths(vectors)[:, None]) @ rotation(vectors.shape[1])


def lengths(vectors: np.ndarray) -> np.ndarray:
    """Norms that neither overflow nor vanish: scaled by the largest component."""
    top = np.abs(vectors).max(axis=1)
    return top * np.sqrt(((vectors / top[:, None]) ** 2).sum(axis=1))


def fit_centres(sample: np.ndarray, lists: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means by numpy: unit centres of ``lists`` groups of unit vectors."""
    rng = np.random.default_rng(SEED)
    centres = sample[rng.choice(len(sample), lists, replace=False)]
    for _ in range(rounds):
        near = nearest_centre(sample, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        norm = np.sqrt((sums**2).sum(axis=1))
        centres = np.where(norm[:, None] > 1e-12, sums / np.maximum(norm, 1e-12)[:, None], centres)
    return centres


def nearest_centre(unit: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The number of each row's nearest centre; so many rows at a time that what is
    held beside them does not grow with their number."""
    parts = [np.argmax(unit[s : s + CHUNK] @ centres.T, axis=1) for s in range(0, len(unit), CHUNK)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def survivors(rows: np.ndarray, queries: np.ndarray, beat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, row) of rotated unit vectors that no test drops: block of columns
    by block of columns, a pair goes once its partial distance says that the whole one
    is over the square distance that its query has to ``beat``."""
    dim = rows.shape[1]
    so_far = np.zeros((len(queries), len(rows)))
    at: tuple[np.ndarray, np.ndarray] | None = None  # the pairs left, once they're few
    for start in range(0, dim, COLUMNS):
        x, q = rows[:, start : start + COLUMNS], queries[:, start : start + COLUMNS]
        seen = start + x.shape[1]
        # With the last column the distance is known, and only rounding may part equals.
        slack = (1 + SURE / np.sqrt(seen)) ** 2 * seen / dim if seen < dim else 1.0
        if at is None:
            so_far += (q**2).sum(axis=1)[:, None] + (x**2).sum(axis=1) - 2 * q @ x.T
            stay = so_far <= (beat * slack + ROUNDING)[:, None]
            if seen == dim or stay.mean() < 0.5:
                at = np.nonzero(stay)
                so_far = so_far[at]
        else:
            so_far += ((q[at[0]] - x[at[1]]) ** 2).sum(axis=1)
            stay = so_far <= beat[at[0]] * slack + ROUNDING
            at, so_far = (at[0][stay], at[1][stay]), so_far[stay]
    return at


def best_of(query: np.ndarray, row: np.ndarray, score: np.ndarray, most: int) -> np.ndarray:
    """Positions of the ``most`` first of each query, by score and then by row."""
    order = np.lexsort((row, -score, query))
    starts = np.searchsorted(query[order], query[order], "left")
    return order[np.arange(len(order)) - starts < most]


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """row, id, vector (doubles) and dim of the rows that take part."""
    x = F.col(vector_col).cast("array<double>")
    rows = rows.select(F.col(id_col).cast("long").alias("id"), x.alias("vector")).where(F.col("vector").isNotNull())
    limit = float(np.finfo(np.float64).max)
    odd = F.exists("vector", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) > limit))
    return rows.where(~odd & F.exists("vector", lambda v: v != 0)).select(
        F.monotonically_increasing_id().alias("row"), "id", F.transform("vector", lambda v: v + F.lit(0.0)).alias("vector"), F.size("vector").alias("dim")
    )


def chunk_rows(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64)


def unit_rows(vectors: pd.Series) -> np.ndarray:
    rows = chunk_rows(vectors)
    return rows / lengths(rows)[:, None]


def nearest(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = EVERY, most: int = NEAREST, recall: float = RECALL
) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by ``every``
    the ``most`` nearest other rows found, nearest first, ties to the smaller id.

    Vectors that are null, empty or zero or hold a null or non-finite component take no
    part. Vectors of different lengths have no cosine: each length is searched by
    itself. A row without id is a candidate behind all others of its score; repeated
    rows and ids are rows of their own, and a query only leaves out its own row. Fewer
    candidates than ``most`` are all returned; an empty table gives an empty result.
    Other columns aren't read. Centres, first distances and the number of lists to scan
    come from samples of bounded size, chosen by the vectors' hash; every vector is
    indexed and can be found.
    """
    spark = rows.sparkSession
    table = save(usable(rows, id_col, vector_col), "op13-vectors", "none")
    out = None
    for r in table.groupBy("dim").count().orderBy("dim").collect():  # lengths of vectors: a handful
        part = search(table.where(F.col("dim") == r["dim"]), r["dim"], every, most, recall)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return out


def sampled(vectors: DataFrame, dim: int, most: int) -> tuple[pd.DataFrame, np.ndarray]:
    """Up to ``most`` rows, by their vectors' hash: the other columns, and the vectors as
    a matrix. Tasks sort only what lies below a bound of the hash, and the rows come as
    Arrow batches, so that the driver holds the numbers once and no object for each."""
    order = [F.xxhash64("vector"), F.col("vector")]
    got = first_by_hash(vectors, order[0], order, most).toArrow()
    numbers = got.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return got.drop_columns(["vector"]).to_pandas(), numbers.reshape(-1, dim)


def lists_to_scan(index: DataFrame, trials: np.ndarray, centres: np.ndarray, most: int, recall: float) -> int:
    """How many lists, nearest first, hold ``recall`` of the trial queries' true
    neighbours, found by comparing them with every class of the index."""

    def true_ones(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                score = trials @ turned(chunk_rows(pdf["vector"])).T
                score[score > 1 - ROUNDING] = -2  # the query itself
                near = np.argsort(-score, axis=1)[:, :most]
                trial = np.repeat(np.arange(len(trials)), near.shape[1])
                yield pd.DataFrame({"trial": trial, "score": np.take_along_axis(score, near, 1).ravel(), "list": pdf["list"].to_numpy()[near.ravel()]})

    found = index.select("vector", "list").mapInPandas(true_ones, "trial int, score double, list int").where("score > -2")
    first = Window.partitionBy("trial").orderBy(F.desc("score"), "list")
    near = found.withColumn("at", F.row_number().over(first)).where(F.col("at") <= most).select("trial", "list").toPandas()
    if near.empty:
        return 1
    order = np.argsort(-(trials @ centres.T), axis=1, kind="stable")
    place = np.argsort(order, axis=1)[near["trial"].to_numpy(), near["list"].to_numpy()]
    return int(np.sort(place)[min(len(place) - 1, int(recall * len(place)))]) + 1


def search(table: DataFrame, dim: int, every: int, most: int, recall: float) -> DataFrame:
    # -- classes of equal vectors, each with the ids that a result can show --------
    order = [F.col("id").asc_nulls_last(), F.col("row")]
    shown = table.withColumn("at", F.row_number().over(Window.partitionBy("vector").orderBy(*order))).where(F.col("at") <= most + 1)
    members = F.array_sort(F.collect_list(F.struct(F.col("id").isNull().alias("no_id"), "id", "row")))
    classes = shown.groupBy("vector").agg(members.alias("members"))
    classes = save(classes.withColumn("class", F.monotonically_increasing_id()), "op13-classes", "none")
    n = classes.count()
    lists = max(1, min(MOST_LISTS, round(n / PER_LIST)))
    first = F.col("members")[0]
    held = classes.select("class", "vector", first["id"].isNull().cast("int").alias("no_id"), F.coalesce(first["id"], F.lit(0)).alias("id"))
    sample, vectors = sampled(held, dim, max(lists, min(FIT_PER_LIST * lists, FIT_NUMBERS // dim)))
    centres = fit_centres(turned(vectors), min(lists, len(sample)))
    seeds = sample.iloc[:SEEDS]
    seeds_unit = vectors[:SEEDS] / lengths(vectors[:SEEDS])[:, None]
    # Lists whose centres are near each other stand on one shelf.
    shelf_centres = fit_centres(centres, max(1, len(centres) // SHELF))
    shelf_of_list = np.argmax(centres @ shelf_centres.T, axis=1)

    # -- the index: every class in the list of its nearest centre -------------------
    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield pdf.assign(list=nearest_centre(turned(chunk_rows(pdf["vector"])), centres).astype(np.int32))

    index = save(held.mapInPandas(listed, "class long, vector array<double>, no_id int, id long, list int"), "op13-lists", "none")
    sizes = np.zeros(len(centres), np.int64)
    for r in index.groupBy("list").count().collect():  # one row a list
        sizes[r["list"]] = r["count"]

    # -- queries: distinct vectors, sent to the shelves of the nearest lists --------
    asked = table.where(F.col("id") % every == 0).select("id", "row", "vector")
    questions = save(classes.join(asked.select("vector").distinct(), "vector", "left_semi").select("class", "vector"), "op13-questions", "none")
    _, trials = sampled(questions, dim, TRIALS)
    probes = lists_to_scan(index, turned(trials), centres, most, recall) if len(trials) else 1

    def probed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in (some.iloc[s : s + CHUNK] for some in batches for s in range(0, len(some), CHUNK)):
            unit = turned(chunk_rows(pdf["vector"]))
            near = np.argsort(-(unit @ centres.T), axis=1, kind="stable")
            # So many lists, or more until they hold enough classes for a result.
            enough = np.maximum(probes, (np.cumsum(sizes[near], axis=1) <= most).sum(axis=1) + 1)
            beat = np.full(len(unit), 4.0)
            if len(seeds) > most:
                beat = np.partition(2 - 2 * unit_rows(pdf["vector"]) @ seeds_unit.T, most, axis=1)[:, most]
            out = []
            for query, vector, nearest_lists, m, b in zip(pdf["class"], pdf["vector"], near, enough, beat):
                wanted = nearest_lists[:m]
                for shelf in np.unique(shelf_of_list[wanted]):
                    out.append((query, vector, b, shelf, wanted[shelf_of_list[wanted] == shelf]))
            yield pd.DataFrame(out, columns=["query", "asked", "beat", "shelf", "lists"])

    def seeded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The seeds that set the distance to beat are results as well."""
        for pdf in batches:
            if len(pdf):
                asked = unit_rows(pdf["vector"])
                near = np.argsort(-(asked @ seeds_unit.T), axis=1, kind="stable")[:, : most + 1]
                query = np.repeat(np.arange(len(pdf)), near.shape[1])
                out = seeds.iloc[near.ravel()][["class", "no_id", "id"]]
                yield out.assign(query=pdf["class"].to_numpy()[query], score=(asked[query] * seeds_unit[near.ravel()]).sum(axis=1))[FOUND]

    visits = save(questions.mapInPandas(probed, "query long, asked array<double>, beat double, shelf int, lists array<int>"), "op13-visits", "none")
    rows_of, calls_of = (np.zeros(len(shelf_centres), np.int64) for _ in range(2))
    np.add.at(rows_of, shelf_of_list, sizes)
    for r in visits.groupBy("shelf").count().collect():  # one row a shelf
        calls_of[r["shelf"]] = r["count"]

    def looked_up(values: np.ndarray, key: str):
        return F.element_at(F.lit([int(v) for v in values]).cast("array<int>"), F.col(key) + 1)

    # A shelf's chunks meet its tiles of queries, and both are of bounded size.
    chunks, tiles = looked_up(np.maximum(1, -(-rows_of // CHUNK)), "shelf"), looked_up(np.maximum(1, -(-calls_of // TILE)), "shelf")
    cells = index.withColumn("shelf", looked_up(shelf_of_list, "list"))
    cells = cells.withColumn("chunk", F.pmod(F.xxhash64("class"), chunks).cast("int")).withColumn("tile", F.explode(F.sequence(F.lit(0), tiles - 1)))
    calls = visits.withColumn("tile", F.pmod(F.xxhash64("query"), tiles).cast("int")).withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks - 1)))

    def scanned(cell: pd.DataFrame, call: pd.DataFrame) -> pd.DataFrame:
        if not len(cell) or not len(call):
            return pd.DataFrame([], columns=FOUND)
        cell = cell.sort_values(["no_id", "id", "class"], kind="stable").reset_index(drop=True)
        plain, asked = unit_rows(cell["vector"]), unit_rows(call["asked"])
        rows, queries, beat = plain @ rotation(dim), asked @ rotation(dim), call["beat"].to_numpy()
        list_of, wanted = cell["list"].to_numpy(), call["lists"].to_numpy()
        asks = np.repeat(np.arange(len(call)), [len(x) for x in wanted])
        of_lists = np.concatenate(wanted)
        pairs = []
        for one in np.unique(list_of):
            here, who = np.flatnonzero(list_of == one), asks[of_lists == one]
            if len(who):
                q, x = survivors(rows[here], queries[who], beat[who])
                pairs.append((who[q], here[x]))
        if not pairs:
            return pd.DataFrame([], columns=FOUND)
        q, x = (np.concatenate(p) for p in zip(*pairs))
        score = np.concatenate([(asked[q[s : s + 65536]] * plain[x[s : s + 65536]]).sum(axis=1) for s in range(0, max(1, len(q)), 65536)])
        best = best_of(q, x, score, most + 1)
        out = cell.loc[x[best], ["class", "no_id", "id"]].assign(query=call["query"].to_numpy()[q[best]], score=score[best])
        return out[FOUND]

    keys = ["shelf", "chunk", "tile"]
    kind = "query long, class long, no_id int, id long, score double"
    near = cells.groupBy(*keys).cogroup(calls.groupBy(*keys)).applyInPandas(scanned, kind)
    near = near.unionByName(questions.mapInPandas(seeded, kind)).groupBy(*FOUND[:-1]).agg(F.max("score").alias("score"))

    # -- back to rows ---------------------------------------------------------------
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "no_id", "id", "class")
    near = near.withColumn("at", F.row_number().over(by_score)).where(F.col("at") <= most + 1).select("query", "class", "score")
    shown = near.join(classes.select("class", "members"), "class").select("query", "score", F.explode("members").alias("m")).select("query", "score", "m.*")
    by_id = Window.partitionBy("query").orderBy(F.desc("score"), "no_id", "id", "row")
    shown = shown.withColumn("at", F.row_number().over(by_id)).where(F.col("at") <= most + 1)
    queries = asked.join(classes.select("class", "vector"), "vector").select(F.col("class").alias("query"), F.col("id").alias("query_id"), F.col("row").alias("own"))
    result = queries.join(shown, "query").where(F.col("row") != F.col("own"))
    ranked = result.withColumn("rank", F.row_number().over(Window.partitionBy("own").orderBy("at"))).where(F.col("rank") <= most)
    return ranked.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


@register("op13_vector_search")
def op13_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
