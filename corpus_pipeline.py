"""Training-corpus pipeline: five stages, each one operator of ``voxpop.llm``.

A stage takes (spark, docs, sf_dir) and returns the documents that it keeps, with
the columns of ``documents``; the last returns packed pieces. Every stage works on
all that the one before it kept, and its result is written as Parquet and read
again, so a lost executor costs no more than the stage it was lost in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxpop.llm.common import documents, save
from voxpop.llm.line_dedup import dedup_lines
from voxpop.llm.mix_sources import mixed_corpus
from voxpop.llm.packing import pack
from voxpop.llm.quality import THRESHOLD, fit_quality, score_texts
from voxpop.llm.registry import register
from voxpop.llm.simhash import one_of_each_group

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts. It's fitted on labelled documents of
    this stage's input; where that has none, every document is accepted."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit_quality(docs.select("doc_id", "text"), labels)
    if not model.learned:
        return docs.select(*COLUMNS)
    return score_texts(docs, model, out="__score").where(F.col("__score") >= THRESHOLD).select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that a smaller id has; ``n_chars`` follows."""
    lines = dedup_lines(docs.select(*COLUMNS))
    return lines.withColumn("text", F.col("__kept")).withColumn("n_chars", F.length("__kept").cast("long")).select(*COLUMNS)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document a group, that with the smallest id."""
    return one_of_each_group(docs.select(*COLUMNS))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as it's taken."""
    return mixed_corpus(docs.select(*COLUMNS))


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces and their places in sequences."""
    return pack(docs.select("doc_id", "text"))


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("simhash near-dedup", near_stage),
    ("source mixing", mix_stage),
    ("packing", pack_stage),
]

#: SQL can't fit the classifier; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs


register("pipeline", ORACLE_SQL)(run)
