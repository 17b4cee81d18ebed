"""Mixing sources to target weights by Pareto order sampling.

Every document of a source gets the whole part of target / size copies for
certain. The rest of the target is a fixed-size sample, fixed in words: the
documents are ranked by their random odds divided by their inclusion odds and
taken from the lowest rank until the words are reached. No source is sorted as
a whole: sums of words over ever finer intervals of the rank find its cut.
All steps are DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voxpop.llm.common import WORD, documents, join_few, number_within, save, text_or_empty, word_count
from voxpop.llm.registry import register

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
#: Documents of fewer words than this have half the weight of others in the draw.
SHORT_WORDS = 20
#: Sources are sent to every task up to this many.
FEW_SOURCES = 100_000
#: Rank intervals of each of the two rounds that narrow down a cut.
INTERVALS = 1024


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """Per source: source_size, target, whole copies, rest (words still to be
    drawn), share (rest / size) and mean weight of a word.

    Targets share out all words by weight, at most ``max_copies`` times a
    source's size. In the order of size / weight the capped sources come first,
    so one pass of running sums finds the level at which nobody is above. One
    row a source goes through one task here.
    """
    per = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("weight")).alias("heavy")
    )
    ranked = per.withColumn("at", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.pmod(F.col("at") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = ranked.withColumn("w", w).withColumn("cap", F.col("source_size") * max_copies)
    by_cap = Window.orderBy(F.col("cap") / F.col("w"), "at")
    before, rest = by_cap.rowsBetween(Window.unboundedPreceding, -1), by_cap.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).partitionBy()
    levelled = (
        ranked.withColumn("place", F.row_number().over(by_cap))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("w").over(rest))
        .withColumn("fits", F.col("level") * F.col("w") <= F.col("cap"))
        .withColumn("from", F.min(F.when(F.col("fits"), F.col("place"))).over(everything))
        .withColumn("final", F.max(F.when(F.col("place") == F.col("from"), F.col("level"))).over(everything))
    )
    target = F.when(F.col("place") >= F.col("from"), F.col("final") * F.col("w")).otherwise(F.col("cap").cast("double"))
    size = F.col("source_size")
    return (
        levelled.withColumn("target", F.when(size == 0, F.lit(0.0)).otherwise(target))
        .withColumn("whole", F.coalesce(F.floor(F.try_divide(F.col("target"), size)), F.lit(0)))
        .withColumn("rest", F.col("target") - F.col("whole") * size)
        .select(
            "source",
            "source_size",
            "target",
            F.col("whole").cast("int").alias("whole"),
            "rest",
            F.coalesce(F.try_divide(F.col("rest"), size), F.lit(0.0)).alias("share"),
            F.coalesce(F.try_divide(F.col("heavy"), size), F.lit(1.0)).alias("mean_weight"),
        )
    )


def uniform(seed: str, id_col: Column, text: Column) -> Column:
    """A number strictly between 0 and 1, the same on every run."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")), F.lit(":"), text)
    return (F.conv(F.substring(F.md5(named), 1, 12), 16, 10).cast("long") + 0.5) / float(2**48)


def pareto_rank(u: Column, inclusion: Column) -> Column:
    """q / (1 + q) for q = odds(u) / odds(inclusion): ranks as q does, in [0, 1).
    Documents that are certain (inclusion 1) rank first, impossible ones last."""
    q = (u / (1 - u)) / (inclusion / (1 - inclusion))
    return F.when(inclusion >= 1, F.lit(0.0)).when(inclusion <= 0, F.lit(1.0)).otherwise(q / (1 + q))


def _summed(sums: DataFrame, *order: str) -> DataFrame:
    """``before``: the words of a source ahead of each row of ``sums`` in that order."""
    run = Window.partitionBy("source").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return sums.withColumn("before", F.col("base") + F.coalesce(F.sum("words").over(run), F.lit(0)))


def _taken(before: Column, size: Column, rest: Column) -> Column:
    """A document is drawn if it brings the words drawn nearer to the rest."""
    return before + size / 2 <= rest


def _last_taken(sums: DataFrame) -> DataFrame:
    """Per source, from (source, rank, size, words, base, rest), words being those of
    all documents of one rank and size: ``last`` (rank, size), up to which all are
    drawn, and ``tied`` (rank, size, words before), of which some are. Documents tie
    where they are equal in id and text, so most sources have no ``tied``."""
    summed = _summed(sums, "rank", "size")
    size, rest = F.col("size"), F.col("rest")
    whole = _taken(F.col("before") + F.col("words") - size, size, rest)
    part = _taken(F.col("before"), size, rest) & ~whole
    return summed.groupBy("source").agg(
        F.max(F.when(whole, F.struct("rank", "size"))).alias("last"),
        F.max(F.when(part, F.struct("rank", "size", F.col("before").cast("long").alias("before")))).alias("tied"),
    )


def _crossing(sums: DataFrame) -> DataFrame:
    """Per source, from (source, part, words, base, rest): the interval in which
    the running sum of words passes ``rest``."""
    summed = _summed(sums, "part")
    inside = (F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words"))
    return summed.where(inside).select("source", F.col("part").alias("in_part"), F.col("before").alias("base"))


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    max_copies: int = MAX_COPIES,
    short_words: int = SHORT_WORDS,
    seed: str = "mix",
) -> DataFrame:
    """``docs`` with __size, __source_size, __target and __copies.

    ``weights`` go to the sources in code point order (null is a source, the
    last), repeating. A document's inclusion probability is its source's share
    times its weight (one half below ``short_words`` words, else one) over the
    mean weight of a word of the source. The draw depends on the id, the text
    and ``seed`` alone; of rows equal in both, as many are taken as the target
    has room for. Texts of any length count whole. Null texts have size
    0; a source of no words has target 0. All columns of ``docs`` are kept; an
    empty table gives an empty result.
    """
    size = word_count(F.col(text_col))
    weight = F.when(size < short_words, F.lit(0.5)).otherwise(F.lit(1.0))
    u = uniform(seed, F.col(id_col), text_or_empty(text_col))
    drawn = docs.withColumn("__size", size).withColumn("__weight", weight).withColumn("__u", u)
    narrow = save(
        drawn.select(
            F.col(source_col).cast("string").alias("source"),
            F.col("__size").alias("size"),
            F.col("__weight").alias("weight"),
            F.col("__u").alias("u"),
        ),
        "op3-sizes",
    )
    sources = save(source_targets(narrow, weights, max_copies), "op3-sources")

    def ranked(rows: DataFrame, source: str, w: str, draw: str) -> DataFrame:
        few = sources.select([F.col(c).alias(f"__s_{c}") for c in sources.columns])
        inclusion = F.col("__s_share") * F.col(w) / F.col("__s_mean_weight")
        joined = join_few(rows, few, _same(source, "__s_source"), FEW_SOURCES)
        return joined.withColumn("__rank", pareto_rank(F.col(draw), inclusion))

    ranks = ranked(narrow, "source", "weight", "u").select("source", "size", F.col("__rank").alias("rank"))
    coarse, fine = F.floor(F.col("rank") * INTERVALS), F.floor(F.col("rank") * INTERVALS * INTERVALS)

    def with_cut(cut: DataFrame) -> DataFrame:
        return cut.select([F.col(c).alias(f"c_{c}") for c in cut.columns])

    level1 = with_cut(sources.select("source", "rest").withColumn("base", F.lit(0).cast("long")))
    sums1 = ranks.groupBy("source", coarse.alias("part")).agg(F.sum("size").alias("words"))
    first = _crossing(
        join_few(sums1, level1, _same("source", "c_source"), FEW_SOURCES).withColumnsRenamed({"c_base": "base", "c_rest": "rest"})
    )
    cut1 = save(first.join(with_cut(sources.select("source", "rest")), _same("source", "c_source")).select("source", "in_part", "base", F.col("c_rest").alias("rest")), "op3-cut1")
    in1 = join_few(ranks, with_cut(cut1), _same("source", "c_source") & (coarse == F.col("c_in_part")), FEW_SOURCES)
    sums2 = in1.groupBy("source", fine.alias("part"), F.col("c_base").alias("base"), F.col("c_rest").alias("rest")).agg(F.sum("size").alias("words"))
    cut2 = save(
        _crossing(sums2)
        .join(with_cut(sources.select("source", "rest")), _same("source", "c_source"))
        .select("source", "in_part", "base", F.col("c_rest").alias("rest")),
        "op3-cut2",
    )
    in2 = join_few(ranks, with_cut(cut2), _same("source", "c_source") & (fine == F.col("c_in_part")), FEW_SOURCES)
    sums3 = in2.groupBy("source", "rank", "size", F.col("c_base").alias("base"), F.col("c_rest").alias("rest")).agg(F.sum("size").alias("words"))
    # The cut of a source: all ranks before its finest interval, and in it up to ``last``.
    cuts = save(
        with_cut(cut2)
        .join(_last_taken(sums3), _same("c_source", "source"), "left")
        .select(
            F.col("c_source").alias("__c_source"),
            (F.col("c_in_part") / float(INTERVALS * INTERVALS)).alias("__below"),
            F.col("last").alias("__last"),
            F.col("tied").alias("__tied"),
        ),
        "op3-cuts",
    )
    placed = ranked(drawn, source_col, "__weight", "__u")
    placed = join_few(placed, cuts, _same(source_col, "__c_source"), FEW_SOURCES, "left")
    at, rest = F.struct(F.col("__rank").alias("rank"), F.col("__size").alias("size")), F.col("__s_rest")
    drawn_too = (rest > 0) & ((F.col("__rank") < F.col("__below")) | (at <= F.col("__last")))
    placed = placed.withColumn("__drawn", F.coalesce(drawn_too, F.lit(False)))
    if cuts.where("__tied is not null").limit(1).count():
        # Equal rows at a cut are written with a number of their own and counted off.
        tied = (rest > 0) & (at == F.struct("__tied.rank", "__tied.size"))
        tied = F.coalesce(tied, F.lit(False))
        among = save(placed.where(tied).withColumn("__row", F.monotonically_increasing_id()), "op3-tied")
        among = number_within(among, "__c_source", ["__row"], "__nth").drop("__row")
        before = F.col("__tied.before") + F.col("__nth") * F.col("__size")
        among = among.withColumn("__drawn", _taken(before, F.col("__size"), rest)).drop("__nth")
        placed = placed.where(~tied).unionByName(among)
    return placed.select(
        *docs.columns,
        "__size",
        F.col("__s_source_size").alias("__source_size"),
        F.col("__s_target").alias("__target"),
        (F.col("__s_whole") + F.col("__drawn").cast("int")).alias("__copies"),
    )


def mixed_corpus(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    taken = mix(docs, **options).where("__copies > 0")
    return taken.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns)


ORACLE_SQL = rf"""
WITH docs AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
           (CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 12)
                 AS BIGINT) + 0.5) / 281474976710656.0::DOUBLE AS u
    FROM documents),
weighted AS (SELECT *, CASE WHEN size < {SHORT_WORDS} THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM docs),
per AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, sum(size * weight) AS heavy FROM weighted GROUP BY source),
ranked AS (
    SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS pos FROM per),
capped AS (
    SELECT *, [{", ".join(map(str, WEIGHTS))}][(pos - 1) % {len(WEIGHTS)} + 1] AS w, source_size * {MAX_COPIES} AS cap
    FROM ranked),
placed AS (
    SELECT *, row_number() OVER o AS place,
           CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                AS DOUBLE) / CAST(sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
    FROM capped WINDOW o AS (ORDER BY CAST(cap AS DOUBLE) / w, pos)),
levelled AS (
    SELECT *, min(CASE WHEN level * w <= cap THEN place END) OVER () AS start FROM placed),
targets AS (
    SELECT *, CASE WHEN source_size = 0 THEN 0.0
                   WHEN place >= start THEN max(CASE WHEN place = start THEN level END) OVER () * w
                   ELSE CAST(cap AS DOUBLE) END AS target FROM levelled),
wholes AS (
    SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE CAST(floor(target / source_size) AS BIGINT) END AS whole FROM targets),
rests AS (
    SELECT *, target - whole * source_size AS rest FROM wholes),
joined AS (
    SELECT d.doc_id, d.size, d.u, d.source, r.source_size, r.target, r.whole, r.rest,
           CASE WHEN r.source_size = 0 THEN 0.0::DOUBLE
                ELSE (r.rest / r.source_size) * d.weight / (r.heavy / r.source_size) END AS inclusion
    FROM weighted d JOIN rests r ON d.source IS NOT DISTINCT FROM r.source),
odds AS (
    SELECT *, (u / (1 - u)) / (inclusion / (1 - inclusion)) AS q FROM joined),
parts AS (
    SELECT *, CASE WHEN inclusion >= 1 THEN 0.0::DOUBLE WHEN inclusion <= 0 THEN 1.0::DOUBLE ELSE q / (1 + q) END AS rank
    FROM odds),
running AS (
    SELECT *, coalesce(sum(size) OVER (
               PARTITION BY source ORDER BY rank, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM parts)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN rest > 0 AND before + size / 2 <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM running"""


@register("op3_mix_sources", ORACLE_SQL)
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(documents(spark, sf_dir).select("doc_id", "text", "source"))
    return mixed.select(
        "doc_id",
        F.col("__size").alias("size"),
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        (F.col("__size") * F.col("__copies")).cast("long").alias("taken"),
    )
