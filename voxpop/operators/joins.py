"""Joins: labels to comments, comments to submissions, region lookups.

All joins are inner equi-joins expressed with the DataFrame API; Catalyst picks
the physical strategy. A side is only hinted for broadcast after its row count
has been checked against an explicit bound; beyond the bound the join stays a
shuffle (sort-merge) join and AQE may still convert it at run time from the
measured shuffle size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxpop.functions import text as T

# Row bound under which a side is broadcast explicitly (labels, region lists,
# hot-key lists). One million short rows is a few tens of MiB per executor.
BROADCAST_MAX_ROWS = 1_000_000

# A Bloom filter of ids takes so many bits an id, and at most so many in all
# (32 MiB an executor): some 22 million ids. Beyond that none is built.
BLOOM_BITS_PER_ID = 12
BLOOM_MAX_BITS = 1 << 28
BLOOM_HASHES = 4
# Words of 64 bits in a block of the filter.
BLOOM_BLOCK = 4096


def sized_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Return ``broadcast(df)`` if ``df`` has at most ``max_rows`` rows, else ``df``.

    The check reads at most ``max_rows + 1`` rows (a bounded job), so it is
    cheap on small sides and stops early on big ones.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def label_join(labels: DataFrame, comments: DataFrame, max_label_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Labelled rows joined to their comment on ``id`` (one ``id`` column).

    Repeated label ids multiply rows, as an inner join does. The label set is
    hand-made and small: broadcast after a size check, so the comment side is
    never shuffled.
    """
    return comments.join(sized_broadcast(labels, max_label_rows), on="id", how="inner")


def _bloom_positions(key: Column, bits: int) -> list[Column]:
    """Bit positions of a key: double hashing, without overflow."""
    first, step = F.pmod(F.xxhash64(key), F.lit(bits)), F.pmod(F.xxhash64(F.lit(11), key), F.lit(bits))
    return [F.pmod(first + step * i, F.lit(bits)) for i in range(BLOOM_HASHES)]


def bloom_filter(ids: DataFrame, key: str, max_bits: int = BLOOM_MAX_BITS) -> tuple[DataFrame, int] | None:
    """One-row table ``words`` (blocks of 64-bit words) with the bits of every id
    set, and its number of bits; None where the ids, counted first, need more than
    ``max_bits``. An empty table has a filter that holds nothing."""
    known = ids.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("_id"))
    bits = BLOOM_BITS_PER_ID * known.limit(max_bits // BLOOM_BITS_PER_ID + 1).count()
    if bits > max_bits:
        return None
    blocks = max(1, -(-bits // (64 * BLOOM_BLOCK)))
    bits = blocks * 64 * BLOOM_BLOCK
    at = known.select(F.explode(F.array(*_bloom_positions(F.col("_id"), bits))).alias("_at"))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("_at", F.lit(64)).cast("int"))
    some = at.select(F.floor(F.col("_at") / 64).cast("long").alias("_w"), mask.alias("_m"))
    # With the words of no bit, so that a block is a full array.
    every = ids.sparkSession.range(blocks * BLOOM_BLOCK).select(F.col("id").alias("_w"), F.lit(0).cast("long").alias("_m"))
    words = some.unionByName(every).groupBy("_w").agg(F.bit_or("_m").alias("_m"))
    block = F.floor(F.col("_w") / BLOOM_BLOCK).cast("long").alias("_b")
    in_order = lambda i, v: F.transform(F.sort_array(F.collect_list(F.struct(i, v))), lambda x: x[v])
    rows = words.groupBy(block).agg(in_order("_w", "_m").alias("_words"))
    return rows.agg(in_order("_b", "_words").alias("words")), bits


def prune_unmatched(comments: DataFrame, submissions: DataFrame, max_bits: int = BLOOM_MAX_BITS) -> DataFrame:
    """``comments`` without most of those that have no submission, none of the others.

    A filter right above the scan, so what an inner join would drop anyway is not
    cleaned and scored first. Up to a few in a hundred without a submission stay, for
    the join to drop. Where the submissions' ids, null ones aside, need more than
    ``max_bits`` only comments without a link go.
    """
    link = T.strip_link_prefix("link_id")
    linked = comments.where(link.isNotNull())
    found = bloom_filter(submissions, "id", max_bits)
    if found is None:
        return linked
    table, bits = found
    words = table.scalar()
    set_there = F.lit(True)
    for at in _bloom_positions(link, bits):
        word = F.floor(at / 64).cast("int")
        value = F.get(F.get(words, F.floor(word / BLOOM_BLOCK).cast("int")), F.pmod(word, F.lit(BLOOM_BLOCK)))
        bit = F.call_function("shiftright", value, F.pmod(at, F.lit(64)).cast("int")).bitwiseAND(F.lit(1))
        set_there = set_there & (bit == 1)
    return linked.where(set_there)


def comment_submission_join(
    comments: DataFrame,
    submissions: DataFrame,
    hot_key_fraction: float | None = None,
) -> DataFrame:
    """J3 + P6/P7: comments joined to their submission on the stripped link id.

    Output columns: id (submission id), comment_id, created_utc?, ts (yyyyMMdd)?,
    title, author_flair_text, c_score, s_score, body?, then any further comment
    columns (e.g. predictions) unchanged.

    Skew: a single hot submission may own a large share of all comments. With
    AQE on, the sort-merge join splits the skewed partition at run time. With
    ``hot_key_fraction`` set, hot submissions are split off explicitly
    (``hot_key_join``) so the plan does not depend on AQE.
    """
    known = {"id", "link_id", "created_utc", "author_flair_text", "score", "body"}
    extra = [c for c in comments.columns if c not in known]
    has_time = "created_utc" in comments.columns
    has_body = "body" in comments.columns
    c = comments.select(
        F.col("id").alias("comment_id"),
        T.strip_link_prefix("link_id").alias("link"),
        *(["created_utc"] if has_time else []),
        "author_flair_text",
        F.col("score").alias("c_score"),
        *(["body"] if has_body else []),
        *extra,
    )
    s = submissions.select(
        F.col("id").alias("link"), "title", F.col("score").alias("s_score")
    )
    if hot_key_fraction:
        joined = hot_key_join(c, s, "link", hot_key_fraction, ["comment_id", "c_score"])
    else:
        joined = c.join(s, on="link", how="inner")
    cols = [F.col("link").alias("id"), "comment_id"]
    if has_time:
        cols += ["created_utc", T.epoch_to_day("created_utc").alias("ts")]
    cols += ["title", "author_flair_text", "c_score", "s_score"]
    cols += (["body"] if has_body else []) + extra
    return joined.select(*cols)


def link_match_count(comments: DataFrame, submissions: DataFrame) -> DataFrame:
    """Number of comments whose link id matches a submission."""
    # Counted per link before the join: one row a thread, however hot it is.
    c = comments.groupBy(T.strip_link_prefix("link_id").alias("link")).agg(F.count(F.lit(1)).alias("_n"))
    s = submissions.groupBy(F.col("id").alias("link")).agg(F.count(F.lit(1)).alias("_m"))
    pairs = c.join(s, on="link").agg(F.sum(F.col("_n") * F.col("_m")).alias("n_matches"))
    return pairs.select(F.coalesce("n_matches", F.lit(0)).cast("bigint").alias("n_matches"))


def hot_key_join(
    fact: DataFrame, dim: DataFrame, key: str, hot_fraction: float = 0.01, salt_by: list[str] | None = None
) -> DataFrame:
    """Inner join of a large, skewed ``fact`` to a ``dim``.

    Keys holding more than ``hot_fraction`` of the fact rows are found with a
    partial-aggregated count; there are at most ``1 / hot_fraction`` of them, which
    come to the driver. Fact rows of a hot key are dealt to ``parts`` salts by the
    columns ``salt_by`` (all of them if not given) and its dim rows repeated for each, in one join over one fact scan.
    """
    counts = fact.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).persist()
    try:
        threshold = max(1, int((counts.agg(F.sum("_n")).first()[0] or 0) * hot_fraction))
        hot = [r[0] for r in counts.filter((F.col("_n") > threshold) & F.col(key).isNotNull()).select(key).collect()]
    finally:
        counts.unpersist()
    if not hot:
        return fact.join(dim, on=key, how="inner")
    parts = max(2, int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4)
    salt = F.when(F.col(key).isin(hot), F.pmod(F.xxhash64(*(salt_by or fact.columns)), F.lit(parts))).otherwise(F.lit(0)).cast("int")
    salts = F.when(F.col(key).isin(hot), F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))
    salted = dim.withColumn("_salt", F.explode(salts))
    return fact.withColumn("_salt", salt).join(salted, on=[key, "_salt"], how="inner").drop("_salt")


def region_lookup(
    regions: DataFrame,
    region_sentiment: DataFrame,
    exclude: list[str] | None = None,
    case_insensitive: bool = True,
) -> DataFrame:
    """J5 + P11: keep the listed regions, attach their sentiment.

    ``regions`` has one column ``state`` (the dimension list); the sentiment
    table has ``state, Positive, Negative``. Names match after trimming and,
    optionally, case-folding; when several sentiment rows match one listed
    name, the exact spelling wins, then the smallest name (deterministic).
    Listed regions without sentiment are dropped (the inner join), excluded
    names are removed first.
    """
    dim = regions.select(F.col("state"))
    if exclude:
        dim = dim.filter(~F.col("state").isin(*exclude))
    fold = (lambda c: F.lower(F.trim(c))) if case_insensitive else (lambda c: F.trim(c))
    dim = sized_broadcast(dim.withColumn("_k", fold(F.col("state"))))
    sent = region_sentiment.select(
        F.col("state").alias("_matched"), "Positive", "Negative"
    ).withColumn("_k", fold(F.col("_matched")))
    cand = sent.join(dim, on="_k", how="inner")
    w = Window.partitionBy("state").orderBy(
        (F.col("_matched") == F.col("state")).desc(), F.col("_matched").asc()
    )
    return (
        cand.withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") == 1)
        .select("state", "Positive", "Negative")
    )
