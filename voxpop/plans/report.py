"""Report job: the scored table -> every sentiment table, written once each.

Inputs of the full job are the forum files (JSON comments and submissions,
CSV labels). Row-format inputs are materialised as Parquet once (S5). The
scored table is written as Parquet into the shared checkpoint folder (lineage
cut: a lost executor re-reads it instead of recomputing cleaning + scoring +
join). All reports come from one grouping-sets aggregate over it, written
partitioned by grouping set, so a report reads its own rows only. Both are
deleted once the reports are written. The numbers behind the regional maps follow
where a list of regions is given.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxpop.functions import scales as S
from voxpop.functions import text as T
from voxpop.operators import aggregates as G
from voxpop.operators import filters as P
from voxpop.operators import joins as J
from voxpop.plans import score
from voxpop.session import ensure_checkpoint_dir, materialize, remove_scratch
from voxpop.sources import readers as R
from voxpop.sources import sinks as W


def sentiment_reports(scored: DataFrame, k: int = 10, stage=None) -> dict[str, DataFrame]:
    """All topic tables of one scored table (pos/neg are 0/1 predictions),
    computed from a single grouping-sets aggregate (one scan of ``scored``)."""
    t = G.sentiment_tables(scored, stage=stage)
    return {
        "titles_positive": G.top_k(t["title_positive"], "percentage", k, tie_col="title"),
        "titles_negative": G.top_k(t["title_negative"], "percentage", k, tie_col="title"),
        "titles_positive_below_perfect": G.top_k_below_perfect(t["title_positive"], "percentage", k + 1, "title"),
        "titles_negative_below_perfect": G.top_k_below_perfect(t["title_negative"], "percentage", k + 1, "title"),
        "daily": t["daily"],
        "by_region": t["by_region"],
        "by_submission_score": t["by_submission_score"],
        "by_comment_score": t["by_comment_score"],
        "overall": t["overall"],
    }


def dated_series(daily: DataFrame, exclude_days: list[int] | None = None) -> DataFrame:
    """T12 + P10 + K4: the daily table as a series by DATE, less the listed days;
    comments without a time have no place in it."""
    kept = P.exclude_values(daily.filter(F.col("date").isNotNull()), "date", exclude_days or [])
    return kept.select(T.day_key_to_date("date").alias("date"), "Positive", "Negative").orderBy("date")


def map_tables(by_region: DataFrame, overall: DataFrame, regions: DataFrame, exclude: list[str] | None = None,
               map_overrides: dict | None = None, approval_overrides: dict | None = None) -> dict[str, DataFrame]:
    """Intensities and approval ratio of the listed regions.

    ``regions`` has one column ``state``. Manual values replace the positive share,
    on the positive map and in the approval ratio; the difference map takes the
    shares as they are. The ratio is scaled by the overall negative over the overall
    positive share, a scalar subquery; it's NULL without a positive row.
    """
    table = J.region_lookup(regions, by_region, exclude=exclude)
    shown = P.override_values(table.withColumn("shown", F.col("Positive")), "state", "shown", map_overrides or {})
    scale = overall.agg(F.max(F.col("Negative") / F.nullif(F.col("Positive"), F.lit(0.0)))).scalar()
    manual = P.override_values(table, "state", "Positive", approval_overrides or {})
    ratios = manual.select("state", S.approval_ratio("Positive", "Negative", scale).alias("ratio"))
    return {
        "map_intensity": shown.select(
            "state",
            S.positive_intensity("shown").alias("positive"),
            S.negative_intensity("Negative").alias("negative"),
            S.difference_intensity("Positive", "Negative").alias("difference"),
        ),
        "approval": ratios.withColumn("bucket", S.approval_bucket("ratio")),
    }


# Reports whose size is bounded by k, by the number of days or by the given list of
# regions: one CSV file.
BOUNDED = {
    "titles_positive", "titles_negative", "titles_positive_below_perfect", "titles_negative_below_perfect",
    "daily", "daily_by_date", "overall", "map_intensity", "approval",
}


def write_reports(reports: dict[str, DataFrame], out_dir: str) -> dict[str, str]:
    """Writes each report; returns its path."""
    paths = {name: f"{out_dir.rstrip('/')}/{name}.csv" for name in reports}
    for name, df in reports.items():
        if name in BOUNDED:
            W.write_single_csv(df, paths[name])
        else:  # one row per flair / score value: unbounded, written in parallel
            df.write.mode("overwrite").option("header", True).csv(paths[name])
    return paths


def run(spark: SparkSession, comments_path: str, submissions_path: str, model_path: str, out_dir: str,
        sample_fraction: float | None = None, exclude_days: list[int] | None = None, regions_path: str | None = None,
        exclude_regions: list[str] | None = None, map_overrides: dict | None = None,
        approval_overrides: dict | None = None) -> dict[str, str]:
    """Full scoring + reporting on the forum inputs; returns the path of each report.

    ``regions_path`` is a text file of region names, one a line, for the map tables.
    Lines that are no JSON records of the schema go to ``malformed/`` of ``out_dir``.
    """
    from voxpop.operators import models as M

    ensure_checkpoint_dir(spark)  # fails before any work where a cluster names none
    comments = R.read_comments(spark, comments_path, quarantine=f"{out_dir}/malformed/comments")
    submissions = R.read_submissions(spark, submissions_path, quarantine=f"{out_dir}/malformed/submissions")
    W.write_parquet(comments, f"{out_dir}/comments.parquet")
    W.write_parquet(submissions, f"{out_dir}/submissions.parquet")
    comments = R.read_parquet(spark, f"{out_dir}/comments.parquet")
    submissions = R.read_parquet(spark, f"{out_dir}/submissions.parquet")
    model = M.load_models(model_path)
    scratch = f"report-{uuid.uuid4().hex}"
    try:
        # The scored table is written once as Parquet in the shared checkpoint
        # folder (lineage cut, columnar re-read); the combined report aggregate
        # too, so the report writes reuse one scan.
        scored = materialize(score.scored_from(comments, submissions, model, sample_fraction=sample_fraction, prune=True), f"{scratch}/scored")
        reports = sentiment_reports(scored, stage=lambda agg: materialize(agg, f"{scratch}/aggregate", ("_gid",)))
        reports["daily_by_date"] = dated_series(reports["daily"], exclude_days)
        if regions_path:
            regions = spark.read.text(regions_path).select(F.trim("value").alias("state")).filter("state <> ''").distinct()
            reports |= map_tables(reports["by_region"], reports["overall"], regions, exclude_regions, map_overrides, approval_overrides)
        return write_reports(reports, out_dir)
    finally:
        remove_scratch(spark, scratch)
