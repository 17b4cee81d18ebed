"""voxpop: forum-comment sentiment analytics expressed as Spark SQL / Spark ML jobs.

Layout
------
sources/    readers and writers (JSON, CSV, Parquet) and the driver-table adapters
functions/  Column-level helpers: text cleaning, n-grams, map intensities, SQL functions
operators/  DataFrame -> DataFrame operators: joins, filters, aggregates, features,
            models, evaluation
plans/      end-to-end jobs (train, score, report) and the query catalog
streaming/  Structured Streaming variant of the scoring and daily report
"""

from voxpop.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
