"""Source/sink queries (S3-S6, S8, S9, S16) and title tables.

Each round trip writes Spark-derived data into a fresh folder under the
session's checkpoint directory (a shared folder on a cluster) and reads it
back with an explicit schema; the SQL twin is the query that produced it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxpop.operators import aggregates as G
from voxpop.operators import filters as P
from voxpop.plans import train
from voxpop.plans.registry import SQL_LABELLED, SQL_LABELS, labelled_targets, register
from voxpop.plans.model_queries import SQL_LABELLED_GRAMS
from voxpop.session import ensure_checkpoint_dir
from voxpop.sources import driver_tables as DT
from voxpop.sources import readers as R
from voxpop.sources import schemas
from voxpop.sources import sinks as W


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@register("csv_roundtrip", f"SELECT id, dem, gop, djt FROM ({SQL_LABELS}) l")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: labels written as CSV under the forum file's own header names, read
    back with the fixed schema (columns bind by position)."""
    path = _scratch(spark, "labels-csv")
    lab = DT.labels(spark, sf_dir).select(
        F.col("id").alias("Input_id"), F.col("dem").alias("labeldem"),
        F.col("gop").alias("labelgop"), F.col("djt").alias("labeldjt"),
    )
    lab.write.mode("overwrite").option("header", True).csv(path)
    return R.read_labels(spark, path)


@register(
    "parquet_roundtrip",
    f"SELECT id, author_flair_text, n_chars, dem, gop, djt, positive, negative FROM ({SQL_LABELLED}) t",
)
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 + S4: labelled rows materialised as Parquet once, then re-read."""
    path = _scratch(spark, "labelled-parquet")
    cols = ["id", "author_flair_text", "n_chars", "dem", "gop", "djt", "positive", "negative"]
    W.write_parquet(labelled_targets(spark, sf_dir).select(*cols), path)
    return R.read_parquet(spark, path)


SQL_TITLE_SHARES = f"""
    SELECT author_flair_text AS title, CAST(sum(positive) AS DOUBLE) / count(positive) AS percentage
    FROM ({SQL_LABELLED}) t GROUP BY author_flair_text"""


@register(
    "report_csv_roundtrip",
    f"SELECT title, percentage FROM ({SQL_TITLE_SHARES}) s ORDER BY percentage DESC, title ASC LIMIT 10",
)
def report_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 + S16 + S8: the top-title report as one CSV file with a header, read
    back as an aggregate table with an explicit schema."""
    from pyspark.sql import types as Ty

    path = _scratch(spark, "top-title-csv")
    shares = G.share_by(labelled_targets(spark, sf_dir), "author_flair_text", "positive", out_key="title")
    W.write_top_slice(shares, path, "percentage", 10, tie_col="title")
    schema = Ty.StructType([Ty.StructField("title", Ty.StringType()), Ty.StructField("percentage", Ty.DoubleType())])
    return R.read_aggregate_csv(spark, path, schema)


@register(
    "daily_csv_roundtrip",
    """
    SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date,
           avg(pos) AS Positive, avg(neg) AS Negative
    FROM (SELECT DATE '1970-01-01' + CAST(floor((datediff('day', DATE '1970-01-01', CAST(ts AS DATE)) * 86400
                   + hour(ts) * 3600 + minute(ts) * 60 + second(ts)) / 86400) AS INTEGER) AS d,
                 CAST(event_type = 'purchase' AS INTEGER) AS pos, CAST(event_type = 'error' AS INTEGER) AS neg
          FROM events) e
    GROUP BY 1""",
)
def daily_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 + S8: the daily series written as one CSV and read back with the
    ``date, Positive, Negative`` schema."""
    path = _scratch(spark, "time-data-csv")
    W.write_single_csv(G.sentiment_by_day(DT.daily_activity(spark, sf_dir)), path)
    return R.read_aggregate_csv(spark, path, schemas.DAILY_SCHEMA)


@register(
    "gram_export_roundtrip",
    f"""
    SELECT g.id, array_to_string(g.g, ' ') AS grams, len(g.g) AS n_grams, t.positive, t.negative
    FROM ({SQL_LABELLED_GRAMS}) g JOIN ({SQL_LABELLED}) t ON g.id = t.id""",
)
def gram_export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S9 + T13: grams exported as a bracketed string column, read back and split."""
    path = _scratch(spark, "gram-export-csv")
    grams = train.labelled_grams(spark, sf_dir)
    exported = grams.select(
        "id", F.concat(F.lit("["), F.array_join("grams", " "), F.lit("]")).alias("grams"), "positive", "negative"
    )
    exported.write.mode("overwrite").option("header", True).csv(path)
    parsed = R.read_gram_export(spark, path, key_columns=("id",)).withColumnRenamed("grams", "g")
    return parsed.select(
        "id", F.array_join("g", " ").alias("grams"), F.size("g").cast("bigint").alias("n_grams"),
        "positive", "negative",
    )


@register("title_shares", SQL_TITLE_SHARES)
def title_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean label per title, every title."""
    return G.share_by(labelled_targets(spark, sf_dir), "author_flair_text", "positive", out_key="title")


@register(
    "title_shares_null_perfect",
    f"SELECT title, NULLIF(percentage, CAST(1.0 AS DOUBLE)) AS percentage FROM ({SQL_TITLE_SHARES}) s",
)
def title_shares_null_perfect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A perfect share of 1.0 becomes NULL before ranking."""
    return P.null_perfect(title_shares(spark, sf_dir), "percentage")


SQL_COMMENT_ROWS = """
    SELECT CAST(conv_id AS VARCHAR) || '_' || CAST(turn AS VARCHAR) AS id, text AS body, 't3_' || CAST(conv_id AS VARCHAR) AS link_id,
           role AS author_flair_text, CAST(length(text) AS BIGINT) AS score
    FROM conversations WHERE turn > 0"""


def _comments_as_json_bz2(spark: SparkSession, sf_dir: str) -> str:
    path = _scratch(spark, "comments-json-bz2")
    DT.comments(spark, sf_dir).write.mode("overwrite").option("compression", "bzip2").json(path)
    return path


@register("json_bz2_scan", f"SELECT id, body, link_id, author_flair_text, score FROM ({SQL_COMMENT_ROWS}) c")
def json_bz2_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments as bz2 JSON lines, scanned with the declared schema."""
    path = _comments_as_json_bz2(spark, sf_dir)
    return R.read_comments(spark, path).select("id", "body", "link_id", "author_flair_text", "score")


def _clean_sql() -> str:
    from voxpop.plans.text_queries import SQL_BI, SQL_TRI, SQL_UNI, sql_words

    return f"""
    SELECT parsed, array_to_string({SQL_UNI}, ' ') AS unigrams, array_to_string({SQL_BI}, ' ') AS bigrams,
           array_to_string({SQL_TRI}, ' ') AS trigrams
    FROM ({sql_words(SQL_COMMENT_ROWS)}) t"""


@register("json_file_clean", _clean_sql())
def json_file_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stand-alone cleaner as a Spark job over a bz2 JSON-lines file."""
    path = _comments_as_json_bz2(spark, sf_dir)
    out = R.clean_json_file(spark, path + "/*.bz2")
    return out.select(
        "parsed",
        F.array_join("unigrams", " ").alias("unigrams"),
        F.array_join("bigrams", " ").alias("bigrams"),
        F.array_join("trigrams", " ").alias("trigrams"),
    )


SQL_SUBMISSION_ROWS = """
    SELECT CAST(conv_id AS VARCHAR) AS id, text AS title, CAST(length(text) AS BIGINT) AS score
    FROM conversations WHERE turn = 0"""


@register("json_submissions_scan", f"SELECT id, title, score FROM ({SQL_SUBMISSION_ROWS}) s")
def json_submissions_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submissions as bz2 JSON lines, scanned with the declared schema."""
    path = _scratch(spark, "submissions-json-bz2")
    DT.submissions(spark, sf_dir).write.mode("overwrite").option("compression", "bzip2").json(path)
    return R.read_submissions(spark, path)


@register(
    "json_malformed_lines",
    """
    SELECT 'comment' AS kind, count(*) AS read_lines, count(*) FILTER (WHERE conv_id % 10 <> 3) AS kept,
           count(*) FILTER (WHERE conv_id % 10 = 3) AS quarantined, true AS whole
    FROM conversations WHERE turn > 0""",
)
def json_malformed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments written as JSON lines, those of every tenth thread broken in one of
    three ways (cut short, a text for a number, no object at all); kept and quarantined
    lines are all lines, and every quarantined line is the broken one."""
    path, bad = _scratch(spark, "malformed-json"), _scratch(spark, "malformed-quarantine")
    rows = DT.comments(spark, sf_dir).withColumn("conv_id", F.element_at(F.split("id", "_"), 1).cast("long"))
    line = F.to_json(F.struct("id", "body", "link_id", "author_flair_text", "score"))
    torn = F.concat(F.lit('{"id": "'), F.col("id"), F.lit('", "body": "cut sho'))
    typed = F.to_json(F.struct("id", F.lit("many").alias("score")))
    ways = F.when(F.col("score") % 3 == 0, torn).when(F.col("score") % 3 == 1, typed).otherwise(F.concat(F.lit("[no object] "), F.col("id")))
    broken = F.col("conv_id") % 10 == 3
    rows.select(F.when(broken, ways).otherwise(line).alias("value")).write.mode("overwrite").text(path)
    kept = R.read_comments(spark, path, quarantine=bad)
    counted = kept.agg(F.count(F.lit(1)).alias("kept"), F.count_if(F.col("id").isNull() | F.col("link_id").isNull()).alias("odd"))
    lines = spark.read.text(path).agg(F.count(F.lit(1)).alias("read_lines"))
    quarantined = spark.read.text(bad)
    found = quarantined.agg(F.count(F.lit(1)).alias("quarantined"), F.count_if(~F.col("value").rlike('cut sho$|"many"|^\\[no object')).alias("wrong"))
    one = counted.crossJoin(lines).crossJoin(found)  # one row each
    return one.select(F.lit("comment").alias("kind"), "read_lines", "kept", "quarantined", ((F.col("odd") == 0) & (F.col("wrong") == 0)).alias("whole"))
