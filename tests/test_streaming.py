"""The streaming daily report equals the batch daily report of the same model."""

from tests.conftest import SF_SMALL
from voxpop.plans import model_queries, stream_queries


def test_stream_daily_equals_batch(spark):
    stream = {r.date: (r.Positive, r.Negative) for r in stream_queries.stream_daily_sentiment(spark, SF_SMALL).collect()}
    batch = {r.date: (r.Positive, r.Negative) for r in model_queries.scored_sentiment_by_day(spark, SF_SMALL).collect()}
    assert stream.keys() == batch.keys() and len(stream) > 1
    for d in batch:
        assert abs(stream[d][0] - batch[d][0]) < 1e-12 and abs(stream[d][1] - batch[d][1]) < 1e-12


def test_late_files_are_counted(spark, tmp_path):
    """Twelve landing files, latest day first, a few per micro-batch: no day is lost."""
    from pyspark.sql import functions as F

    from voxpop.streaming import daily

    rows = [(1700000000 - d * 86400 * 3, float(d % 2), 1.0) for d in range(12)]
    for i, r in enumerate(rows):
        spark.createDataFrame([r, r], "created_utc long, pos double, neg double").coalesce(1).write.parquet(f"{tmp_path}/part{i:02}")
    spark.createDataFrame([(None, 1.0, 0.0)], "created_utc long, pos double, neg double").coalesce(1).write.parquet(f"{tmp_path}/part99")
    landing = spark.readStream.schema("created_utc long, pos double, neg double").option("maxFilesPerTrigger", 2).parquet(f"{tmp_path}/part*")
    q = daily.start_daily_report(landing, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    q.awaitTermination()
    batch = daily.daily_shares(spark.read.schema("created_utc long, pos double, neg double").parquet(*[f"{tmp_path}/part{i:02}" for i in range(12)], f"{tmp_path}/part99"))
    expected = batch.select("date", (F.col("pos_sum") / F.col("n")).alias("Positive"), (F.col("neg_sum") / F.col("n")).alias("Negative"))
    assert sorted(map(repr, daily.latest_daily(spark, f"{tmp_path}/out").collect())) == sorted(map(repr, expected.collect()))
    assert expected.count() == 13
