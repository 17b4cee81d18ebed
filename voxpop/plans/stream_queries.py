"""Streaming form of the scoring + daily report, as a catalog query (rows-only)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from voxpop.plans import train
from voxpop.plans.registry import register
from voxpop.session import ensure_checkpoint_dir
from voxpop.sources import driver_tables as DT
from voxpop.streaming import daily


@register("stream_daily_sentiment")
def stream_daily_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments of the driver tables land as Parquet files, a streaming query
    scores them (stream-static join to submissions) and keeps daily shares;
    the result is the latest value of every day."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    DT.comments(spark, sf_dir, with_time=True).write.mode("overwrite").parquet(f"{base}/landing")
    model = train.fitted_models(spark, sf_dir)
    comments = daily.comment_stream(spark, f"{base}/landing", fmt="parquet", max_files_per_trigger=4)
    scored = daily.scored_stream(comments, DT.submissions(spark, sf_dir), model)
    q = daily.start_daily_report(scored, f"{base}/daily", f"{base}/checkpoint")
    q.awaitTermination()
    return daily.latest_daily(spark, f"{base}/daily")
