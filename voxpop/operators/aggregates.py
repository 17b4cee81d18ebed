"""Grouped sentiment shares and top-k rankings.

Every aggregate is a ``groupBy().agg()``: Spark aggregates partially inside
each map task before the shuffle, so a hot group (one title or one day with a
third of all comments) still ships one partial row per task, never its rows.
Top-k uses ``orderBy().limit()`` which plans as ``TakeOrderedAndProject``:
each task keeps k rows, the driver merges k x tasks rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxpop.functions import text as T


def label_distribution(df: DataFrame, label_col: str = "label", by: list[str] | None = None) -> DataFrame:
    """G1: rows per label value (optionally per split)."""
    keys = (by or []) + [label_col]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def share_by(df: DataFrame, key_col: str, value_col: str = "prediction", out_key: str | None = None,
             out_col: str = "percentage") -> DataFrame:
    """``sum(value)/count(value)`` per key (the mean of a 0/1 prediction)."""
    return df.groupBy(F.col(key_col).alias(out_key or key_col)).agg(
        (F.sum(value_col) / F.count(value_col)).alias(out_col)
    )


def sentiment_by(df: DataFrame, key: str | F.Column, out_key: str, pos_col: str = "pos",
                 neg_col: str = "neg") -> DataFrame:
    """G6-G9 core: ``key, Positive, Negative`` as the mean 0/1 prediction per key."""
    k = F.col(key) if isinstance(key, str) else key
    return df.groupBy(k.alias(out_key)).agg(
        F.avg(pos_col).alias("Positive"), F.avg(neg_col).alias("Negative")
    )


def sentiment_by_day(df: DataFrame, time_col: str = "created_utc", pos_col: str = "pos",
                     neg_col: str = "neg") -> DataFrame:
    """Daily shares keyed by ``yyyyMMdd`` (UTC day of the epoch seconds)."""
    return sentiment_by(df, T.epoch_to_day(time_col), "date", pos_col, neg_col)


def sentiment_by_state(df: DataFrame, flair_col: str = "author_flair_text", pos_col: str = "pos",
                       neg_col: str = "neg") -> DataFrame:
    """Shares per trimmed flair; the NULL flair stays its own group."""
    return sentiment_by(df, F.trim(F.col(flair_col)), "state", pos_col, neg_col)


def sentiment_by_state_totals(totals: DataFrame, flair_col: str = "author_flair_text") -> DataFrame:
    """G7 and G10 from partial sums (pos, pos_n, neg, neg_n): one row per trimmed
    flair with its shares and the overall ones, from one aggregate."""
    sums = totals.groupBy(F.trim(F.col(flair_col)).alias("state")).agg(
        *[F.sum(c).alias(c) for c in ("pos", "pos_n", "neg", "neg_n")]
    )
    share = lambda a, b: F.col(a) / F.nullif(F.col(b), F.lit(0))
    return sums.select("state", share("pos", "pos_n").alias("Positive"), share("neg", "neg_n").alias("Negative"), "pos", "pos_n", "neg", "neg_n")


def sentiment_by_score(df: DataFrame, score_col: str, out_key: str, pos_col: str = "pos",
                       neg_col: str = "neg") -> DataFrame:
    """Shares per submission or comment score."""
    return sentiment_by(df, score_col, out_key, pos_col, neg_col)


def sentiment_overall(df: DataFrame, pos_col: str = "pos", neg_col: str = "neg") -> DataFrame:
    """One row with the overall positive and negative shares."""
    return df.agg(F.avg(pos_col).alias("Positive"), F.avg(neg_col).alias("Negative"))


def count_having(df: DataFrame, key_col: str, value) -> DataFrame:
    """``count(*) GROUP BY key HAVING key = value``."""
    return (
        df.groupBy(key_col)
        .agg(F.count(F.lit(1)).alias("count"))
        .filter(F.col(key_col) == F.lit(value))
    )


def top_k(df: DataFrame, order_col: str, k: int, tie_col: str | None = None,
          ascending: bool = False) -> DataFrame:
    """K1/K2: first ``k`` rows by ``order_col`` with a deterministic tie-break."""
    first = F.col(order_col).asc() if ascending else F.col(order_col).desc()
    keys = [first] + ([F.col(tie_col).asc()] if tie_col else [])
    return df.orderBy(*keys).limit(k)


def top_k_below_perfect(df: DataFrame, order_col: str, k: int, tie_col: str | None = None) -> DataFrame:
    """K3 (+P14): drop shares of exactly 1.0, then take the top ``k``."""
    kept = df.filter(F.col(order_col) != F.lit(1.0))
    return top_k(kept, order_col, k, tie_col)


# Key columns of the combined report aggregate, in grouping_id bit order.
REPORT_KEYS = ["title", "ts", "state", "s_score", "c_score"]


def _gid(*kept: str) -> int:
    """grouping_id() of a grouping set: bit set for every key rolled up."""
    n = len(REPORT_KEYS)
    return sum(1 << (n - 1 - i) for i, k in enumerate(REPORT_KEYS) if k not in kept)


def sentiment_tables(scored: DataFrame, pos_col: str = "pos", neg_col: str = "neg",
                     stage=None) -> dict[str, DataFrame]:
    """G2/G3 + G6-G10 from ONE aggregate: grouping sets over title, day,
    region, submission score, comment score and the grand total.

    The scored rows are scanned once; ``Expand`` feeds one partial aggregation
    per task and one shuffle of partial sums. The result holds one row per
    distinct key of each set (small), and each report is a filter on
    ``grouping_id`` with ``sum/count`` (the same value as ``avg``). ``stage``
    may materialise the combined table so several reports reuse one scan.
    """
    keyed = scored.select(
        "title", "ts", F.trim(F.col("author_flair_text")).alias("state"), "s_score", "c_score",
        F.col(pos_col).alias("_p"), F.col(neg_col).alias("_n"),
    )
    sets = [["title"], ["ts"], ["state"], ["s_score"], ["c_score"], []]
    agg = keyed.groupingSets(sets, *REPORT_KEYS).agg(
        F.sum("_p").alias("_ps"), F.count("_p").alias("_pc"),
        F.sum("_n").alias("_ns"), F.count("_n").alias("_nc"),
        F.grouping_id().alias("_gid"),
    )
    if stage is not None:  # e.g. materialise the small combined table once
        agg = stage(agg)
    pos = (F.col("_ps") / F.col("_pc")).alias("Positive")
    neg = (F.col("_ns") / F.col("_nc")).alias("Negative")

    def pick(*kept: str) -> DataFrame:
        return agg.filter(F.col("_gid") == _gid(*kept))

    return {
        "title_positive": pick("title").select("title", (F.col("_ps") / F.col("_pc")).alias("percentage")),
        "title_negative": pick("title").select("title", (F.col("_ns") / F.col("_nc")).alias("percentage")),
        "daily": pick("ts").select(F.col("ts").alias("date"), pos, neg),
        "by_region": pick("state").select("state", pos, neg),
        "by_submission_score": pick("s_score").select(F.col("s_score").alias("submission_score"), pos, neg),
        "by_comment_score": pick("c_score").select(F.col("c_score").alias("comment_score"), pos, neg),
        "overall": pick().select(pos, neg),
    }
