"""Scoring job: every comment scored by both models, then the topic reports.

    quote filter + ``/s`` removal (P5/T9) -> optional deterministic sample
    (P15) -> grams (T7/T8) -> vectorise once, both regressions (M2/M7), all
    map-side -> ⋈ submissions on the stripped link id (J3; AQE or explicit
    hot-key split for huge threads) -> scored table
    -> shares per title / day / region / score (G2-G10), top-k (K1-K3)

The scored table feeds several reports; ``report.py`` cuts its lineage into
the checkpoint folder once so the reports do not each recompute the join,
cleaning and scoring.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from voxpop.functions import text as T
from voxpop.operators import aggregates as G
from voxpop.operators import filters as P
from voxpop.operators import joins as J
from voxpop.operators import models as M
from voxpop.plans import train
from voxpop.sources import driver_tables as DT

SCORED_COLUMNS = [
    "id", "comment_id", "created_utc", "ts", "title", "author_flair_text",
    "c_score", "s_score", "pos", "neg", "pos_p1", "neg_p1",
]


def scored_from(comments: DataFrame, submissions: DataFrame, model: PipelineModel,
                sample_fraction: float | None = None, hot_key_fraction: float | None = None,
                prune: bool = False) -> DataFrame:
    """Score every kept comment, then attach its submission. With ``prune``, most
    comments without a submission go before they are cleaned.

    Filtering, cleaning and both models are per-row work and run map-side on
    the comment scan; only then is the (now small) scored row joined to its
    submission, so the comment text never crosses a shuffle.
    """
    if prune:
        comments = J.prune_unmatched(comments, submissions)
    kept = P.quote_filter(comments, "body")
    if sample_fraction is not None:
        kept = P.hash_sample(kept, "id", sample_fraction)
    grams = T.with_gram_list(kept, "body").drop("body")
    scored = M.score(model, grams).drop("grams")
    joined = J.comment_submission_join(scored, submissions, hot_key_fraction=hot_key_fraction)
    return joined.select(*[c for c in SCORED_COLUMNS if c in joined.columns])


def scored_comments(spark: SparkSession, sf_dir: str, model: PipelineModel | None = None,
                    sample_fraction: float | None = None, hot_key_fraction: float | None = None) -> DataFrame:
    """Scored stand-in comments. Forum comments carry ``created_utc``; the
    stand-in takes it from the events table, and attaches it after scoring
    (narrow join on the comment id) so no text crosses a shuffle."""
    from pyspark.sql import functions as F

    model = model or train.fitted_models(spark, sf_dir)
    scored = scored_from(
        DT.comments(spark, sf_dir),
        DT.submissions(spark, sf_dir),
        model,
        sample_fraction=sample_fraction,
        hot_key_fraction=hot_key_fraction,
    )
    timed = scored.join(DT.comment_times(spark, sf_dir), on="comment_id", how="left")
    timed = timed.withColumn("ts", T.epoch_to_day("created_utc"))
    return timed.select(*[F.col(c) for c in SCORED_COLUMNS])


def top_titles(scored: DataFrame, which: str = "pos", k: int = 10) -> DataFrame:
    """G2/G3 + K1/K2: titles with the highest predicted share."""
    shares = G.share_by(scored, "title", which, out_key="title", out_col="percentage")
    return G.top_k(shares, "percentage", k, tie_col="title")


def top_titles_scored(spark: SparkSession, sf_dir: str, which: str = "pos", k: int = 10) -> DataFrame:
    return top_titles(scored_comments(spark, sf_dir), which, k)
