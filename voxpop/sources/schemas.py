"""Explicit schemas for every input; nothing is inferred on large files."""

from pyspark.sql import types as T

# Forum comments (JSON lines, often bz2). Only the fields the analysis uses.
COMMENT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("link_id", T.StringType()),
        T.StructField("created_utc", T.LongType()),
        T.StructField("author_flair_text", T.StringType()),
        T.StructField("score", T.LongType()),
    ]
)

SUBMISSION_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("score", T.LongType()),
    ]
)

# Hand-labelled comments. The CSV header names differ
# (Input_id,labeldem,labelgop,labeldjt); columns bind by position.
LABEL_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("dem", T.IntegerType()),
        T.StructField("gop", T.IntegerType()),
        T.StructField("djt", T.IntegerType()),
    ]
)

DAILY_SCHEMA = T.StructType(
    [
        T.StructField("date", T.IntegerType()),
        T.StructField("Positive", T.DoubleType()),
        T.StructField("Negative", T.DoubleType()),
    ]
)

GRAM_EXPORT_SCHEMA = T.StructType(
    [
        T.StructField("grams", T.StringType()),
        T.StructField("positive", T.IntegerType()),
        T.StructField("negative", T.IntegerType()),
    ]
)
