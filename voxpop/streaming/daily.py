"""Structured Streaming form of the scoring job and the daily sentiment report.

Comments arrive as files (JSON lines or Parquet). Each micro-batch:

* joins the comments to the static submissions (stream-static join),
* drops quoted comments,
* cleans and scores them with the fitted model.

The daily shares are an aggregate keyed by the day of the comment, without a
watermark: the state is one row per day, and comments may arrive in any order. It
runs in ``update`` mode and ``foreachBatch`` writes each batch's updated day rows
to its own ``batch_id=`` folder of a Parquet table. Readers take the newest row
per day (``latest_daily``). Checkpoints live under
``spark.checkpoint.dir`` (a shared folder on a cluster), so a restarted query
resumes where it stopped.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from voxpop.functions import text as T
from voxpop.plans import score
from voxpop.sources import schemas


def comment_stream(spark: SparkSession, path: str, fmt: str = "json", schema: StructType | None = None,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Comments arriving as files under ``path`` (explicit schema, no inference)."""
    reader = spark.readStream.schema(schema or schemas.COMMENT_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.format(fmt).load(path)


def scored_stream(comments: DataFrame, submissions: DataFrame, model: PipelineModel) -> DataFrame:
    """Stream-static join + quote filter + cleaning + both models (same plan as batch)."""
    return score.scored_from(comments, submissions, model)


def daily_shares(scored: DataFrame) -> DataFrame:
    """G6 over a stream: sums per day key; comments without a time are a group too."""
    return scored.groupBy(T.epoch_to_day("created_utc").alias("date")).agg(
        F.sum("pos").alias("pos_sum"), F.sum("neg").alias("neg_sum"), F.count(F.lit(1)).alias("n")
    )


def start_daily_report(scored: DataFrame, out_path: str, checkpoint_path: str,
                       available_now: bool = True) -> StreamingQuery:
    """Run the daily aggregate; every micro-batch appends its updated days to ``out_path``."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # One folder per batch, overwritten on replay: a retried batch is idempotent.
        batch.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch_id={batch_id}")

    writer = (
        daily_shares(scored)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint_path)
        .foreachBatch(write_batch)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def latest_daily(spark: SparkSession, out_path: str) -> DataFrame:
    """Current daily table: the newest update of every day, as (date, Positive, Negative)."""
    rows = spark.read.parquet(out_path)
    latest = rows.groupBy("date").agg(F.max_by(F.struct("pos_sum", "neg_sum", "n"), "batch_id").alias("v"))
    return latest.select(
        "date",
        (F.col("v.pos_sum") / F.col("v.n")).alias("Positive"),
        (F.col("v.neg_sum") / F.col("v.n")).alias("Negative"),
    )
