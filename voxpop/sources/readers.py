"""Scans: JSON lines (plain or bz2), CSV with explicit schema, Parquet.

Schemas are always declared: inferring a schema on a large bz2 JSON file costs
one extra full pass over the data. bz2 is splittable, so Spark parallelises a
single large file across tasks by itself; the codec is picked from the file
extension by Hadoop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from voxpop.functions import text as T
from voxpop.sources import schemas


#: Column that a line which isn't a JSON record of the schema is kept in, whole.
MALFORMED = "_malformed"


def read_json_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON lines with the text of malformed ones beside the fields. A line is malformed
    if it's no JSON object or a field can't be read as its type; then all that could
    be read is there, and the line itself in ``MALFORMED``. Blank lines are none."""
    wide = StructType([*schema.fields, StructField(MALFORMED, StringType())])
    # The JSON reader refuses a query for the malformed text alone, so lines are text here.
    record = F.from_json("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED})
    lines = spark.read.text(path).where(F.trim("value") != "").select("value", record.alias("r"))
    torn = F.when(F.col("r").isNull() | F.col("r")[MALFORMED].isNotNull(), F.col("value"))
    return lines.select(*[F.col("r")[c].alias(c) for c in schema.fieldNames()], torn.alias(MALFORMED))


def well_formed(raw: DataFrame, quarantine: str | None = None) -> DataFrame:
    """The records of ``read_json_lines`` that could be read whole. With ``quarantine``,
    a path, the other lines are written there as text, one a line, so that every line
    of the input is in one of the two."""
    if quarantine is not None:
        raw.where(F.col(MALFORMED).isNotNull()).select(F.col(MALFORMED).alias("value")).write.mode("overwrite").text(quarantine)
    return raw.where(F.col(MALFORMED).isNull()).drop(MALFORMED)


def read_comments(spark: SparkSession, path: str, schema: StructType | None = None, quarantine: str | None = None) -> DataFrame:
    """Comments from JSON lines (``.json``/``.json.bz2``). With ``quarantine``,
    malformed lines go to that path; without, they stay as rows of what could be read."""
    schema = schema or schemas.COMMENT_SCHEMA
    if quarantine is None:
        return spark.read.schema(schema).json(path)
    return well_formed(read_json_lines(spark, path, schema), quarantine)


def read_submissions(spark: SparkSession, path: str, schema: StructType | None = None, quarantine: str | None = None) -> DataFrame:
    """Submissions from JSON lines; ``quarantine`` as for comments."""
    return read_comments(spark, path, schema or schemas.SUBMISSION_SCHEMA, quarantine)


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """S3: labelled CSV with a header; columns bound by position, bad ints -> NULL."""
    return (
        spark.read.schema(schemas.LABEL_SCHEMA)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet scan (filters and projections are pushed into the reader)."""
    return spark.read.parquet(*paths)


def read_aggregate_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The small aggregate CSVs (daily, state, score tables).

    Titles and flairs may hold line breaks inside quoted fields, so records are
    read with ``multiLine`` (report files are small; splitting is not needed).
    """
    return spark.read.schema(schema).option("header", True).option("multiLine", True).csv(path)


def read_gram_export(spark: SparkSession, path: str, key_columns: tuple[str, ...] = ()) -> DataFrame:
    """Gram export ``grams,"[a b c]",label,label`` -> array column ``grams``;
    ``key_columns`` names text columns that stand before these."""
    keys = [StructField(k, StringType()) for k in key_columns]
    df = spark.read.schema(StructType(keys + list(schemas.GRAM_EXPORT_SCHEMA.fields))).option("header", True).csv(path)
    return df.withColumn("grams", T.parse_bracketed_grams("grams"))


def clean_json_file(spark: SparkSession, path: str, text_field: str = "body", quarantine: str | None = None) -> DataFrame:
    """JSON lines file -> cleaned records (parsed, unigrams, bigrams, trigrams).
    With ``quarantine``, malformed lines go to that path and give no record.

    The stand-alone cleaner becomes a Spark job: any ``.json``/``.bz2`` path is
    read by Spark (codec from the extension) and cleaned in the executors.
    """
    if not (path.endswith(".json") or path.endswith(".bz2")):
        raise ValueError("expected a .json or .bz2 file: " + path)
    from pyspark.sql import types as Ty

    schema = Ty.StructType([Ty.StructField(text_field, Ty.StringType())])
    raw = read_comments(spark, path, schema, quarantine)
    return T.with_grams(raw, text_field).select("parsed", "unigrams", "bigrams", "trigrams")
