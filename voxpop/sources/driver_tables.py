"""Adapters from the driver's parquet tables to the comment data model.

The forum dumps themselves are not available, so the driver tables stand in
for them. Every adapter is a lazy projection (plus at most one join) over the
given tables, so the work of every query grows with the data.

| concept            | table                               | mapping                                        |
|--------------------|-------------------------------------|------------------------------------------------|
| comments           | conversations, turn > 0             | id = conv_id*1000+turn, link_id = 't3_'||conv_id,
|                    |                                     | body = text, flair = role, score = length(text),
|                    |                                     | created_utc = epoch(events.ts of event_id = 50*conv_id) + turn
| submissions        | conversations, turn = 0             | id = conv_id, title = text, score = length(text)
| labelled comments  | labels + documents                  | djt = -1 if toxic, else 1 if quality, else 0
| text corpus        | documents, conversations, pages     | every text column, pages as url || ' ' || html
| regional activity  | events + customer + nation          | region = nation name of the user
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxpop.functions import text as T


# Ratio used to place conversations on the event timeline (the driver tables
# hold 50-100 events per conversation at every scale factor).
EVENTS_PER_CONVERSATION = 50


def path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(path(sf_dir, name))


def comment_id() -> Column:
    """Unique for threads of any length."""
    return F.concat(F.col("conv_id").cast("string"), F.lit("_"), F.col("turn").cast("string"))


def comments(spark: SparkSession, sf_dir: str, with_time: bool = False) -> DataFrame:
    """Comments with the forum schema: id, body, link_id, created_utc?, author_flair_text, score."""
    conv = table(spark, sf_dir, "conversations").filter(F.col("turn") > 0)
    cols = [
        comment_id().alias("id"),
        F.col("text").alias("body"),
        F.concat(F.lit(T.LINK_PREFIX), F.col("conv_id").cast("string")).alias("link_id"),
        F.col("role").alias("author_flair_text"),
        F.length("text").cast("bigint").alias("score"),
    ]
    if not with_time:
        return conv.select(*cols)
    events = table(spark, sf_dir, "events").select(
        F.col("event_id"), T.timestamp_ntz_to_epoch("ts").alias("_epoch")
    )
    # Conversation c takes the time of event c * EVENTS_PER_CONVERSATION, which
    # spreads the threads over the event timeline at every scale factor. This
    # join exists only in the stand-in: forum comments carry created_utc.
    joined = conv.join(events, conv["conv_id"] * EVENTS_PER_CONVERSATION == events["event_id"], "left")
    return joined.select(*cols, (F.col("_epoch") + F.col("turn")).alias("created_utc"))


def comment_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narrow (comment_id, created_utc) table of the stand-in comments.

    Scoring plans attach it after scoring, so the event-time join of the
    stand-in moves ids and times only, never comment text.
    """
    conv = table(spark, sf_dir, "conversations").filter(F.col("turn") > 0).select("conv_id", "turn")
    events = table(spark, sf_dir, "events").select(
        F.col("event_id"), T.timestamp_ntz_to_epoch("ts").alias("_epoch")
    )
    joined = conv.join(events, conv["conv_id"] * EVENTS_PER_CONVERSATION == events["event_id"], "left")
    return joined.select(
        comment_id().alias("comment_id"),
        (F.col("_epoch") + F.col("turn")).alias("created_utc"),
    )


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = table(spark, sf_dir, "conversations").filter(F.col("turn") == 0)
    return conv.select(
        F.col("conv_id").cast("string").alias("id"),
        F.col("text").alias("title"),
        F.length("text").cast("bigint").alias("score"),
    )


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled set with the reference's columns id, dem, gop, djt."""
    lab = table(spark, sf_dir, "labels")
    djt = (
        F.when(F.col("toxic") == 1, F.lit(-1))
        .when(F.col("quality") == 1, F.lit(1))
        .otherwise(F.lit(0))
    )
    return lab.select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("quality").alias("dem"),
        F.col("toxic").alias("gop"),
        djt.cast("int").alias("djt"),
    )


def labelled_comment_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments that can carry labels: documents as id, body, flair (= source)."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("text").alias("body"),
        F.col("source").alias("author_flair_text"),
        F.col("n_chars"),
    )


def text_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All text of the driver tables as (id, body): documents, turns, pages."""
    docs = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), F.col("text").alias("body")
    )
    turns = table(spark, sf_dir, "conversations").select(
        F.concat(
            F.lit("c"), F.col("conv_id").cast("string"), F.lit("_"), F.col("turn").cast("string")
        ).alias("id"),
        F.col("text").alias("body"),
    )
    pages = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("id"),
        F.concat_ws(" ", F.col("url"), F.col("html")).alias("body"),
    )
    return docs.unionByName(turns).unionByName(pages)


def regional_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a region: (region, positive, negative) per event.

    positive = purchase, negative = error; the region is the nation of the
    user (events.user_id = customer.c_custkey).
    """
    ev = table(spark, sf_dir, "events").select("user_id", "event_type")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    users = cust.join(nat, cust["c_nationkey"] == nat["n_nationkey"]).select(
        F.col("c_custkey"), F.col("n_name").alias("author_flair_text")
    )
    # Left join: events of users without a customer row keep a NULL region,
    # which stays its own group downstream.
    return ev.join(users, ev["user_id"] == users["c_custkey"], "left").select(
        "author_flair_text",
        (F.col("event_type") == "purchase").cast("int").alias("pos"),
        (F.col("event_type") == "error").cast("int").alias("neg"),
    )


def regional_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``regional_activity`` summed per user before the join, so that a hot user (or
    the NULL one) is one row: (author_flair_text, pos, pos_n, neg, neg_n)."""
    ev = table(spark, sf_dir, "events").select(
        "user_id",
        (F.col("event_type") == "purchase").cast("int").alias("pos"),
        (F.col("event_type") == "error").cast("int").alias("neg"),
    )
    per_user = ev.groupBy("user_id").agg(
        F.sum("pos").alias("pos"), F.count("pos").alias("pos_n"), F.sum("neg").alias("neg"), F.count("neg").alias("neg_n")
    )
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("author_flair_text"))
    users = cust.join(nat, cust["c_nationkey"] == nat["n_nationkey"])
    joined = per_user.join(users, per_user["user_id"] == users["c_custkey"], "left")
    return joined.select("author_flair_text", "pos", "pos_n", "neg", "neg_n")


def daily_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as scored rows: (created_utc, pos, neg, c_score, s_score).

    c_score = floor(value) stands in for the comment score, user_id for the
    submission score.
    """
    ev = table(spark, sf_dir, "events")
    return ev.select(
        T.timestamp_ntz_to_epoch("ts").alias("created_utc"),
        (F.col("event_type") == "purchase").cast("int").alias("pos"),
        (F.col("event_type") == "error").cast("int").alias("neg"),
        F.floor("value").cast("bigint").alias("c_score"),
        F.col("user_id").alias("s_score"),
    )


def region_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The region dimension (nation names), standing in for the list of states."""
    return table(spark, sf_dir, "nation").select(F.col("n_name").alias("state"))
