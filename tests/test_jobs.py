"""End-to-end jobs on forum-format inputs derived from the driver tables:
JSON-lines comments/submissions + CSV labels -> train.run -> report.run."""

import glob
import math
import os
import tempfile

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from voxpop.operators import models as M
from voxpop.plans import report, score, train
from voxpop.session import ensure_checkpoint_dir
from voxpop.sources import driver_tables as DT
from voxpop.sources import readers


def test_train_and_report_jobs(spark):
    base = tempfile.mkdtemp(prefix="vp-job-", dir="/tmp")
    DT.comments(spark, SF_SMALL, with_time=True).write.option("compression", "bzip2").json(f"{base}/comments")
    # labelled comments travel with the comment dump, as in the forum data
    bodies = F.when(F.col("id") != "0", F.col("body")).alias("body")  # one labelled comment has none
    DT.labelled_comment_texts(spark, SF_SMALL).select(
        "id", bodies, F.lit(None).cast("string").alias("link_id"), F.lit(0).cast("bigint").alias("created_utc"),
        "author_flair_text", F.lit(0).cast("bigint").alias("score"),
    ).write.json(f"{base}/labelled_comments")
    DT.submissions(spark, SF_SMALL).write.json(f"{base}/submissions")
    DT.labels(spark, SF_SMALL).select(
        F.col("id").alias("Input_id"), F.col("dem").alias("labeldem"),
        F.col("gop").alias("labelgop"), F.col("djt").alias("labeldjt"),
    ).coalesce(1).write.option("header", True).csv(f"{base}/labels")

    model = train.run(spark, f"{base}/labels", f"{base}/labelled_comments", f"{base}/model", folds=3)
    assert os.path.isdir(f"{base}/model/stages")
    metrics = {(r.model, r.metric): float(r.value) for r in spark.read.option("header", True).csv(f"{base}/model_evaluation.csv").collect()}
    for prefix in ("pos", "neg"):
        assert 0 <= metrics[prefix, "held-out area under ROC"] <= 1
        assert 0 <= metrics[prefix, "cross-validated area under ROC"] <= 1
        assert metrics[prefix, "label 1 in test"] == metrics[prefix, "held-out rows with the label"]
    assert len(model.stages) == 3

    out = f"{base}/reports"
    flairs = [r[0] for r in DT.comments(spark, SF_SMALL).select("author_flair_text").distinct().collect()]
    listed = sorted(f for f in flairs if f)
    with open(f"{base}/regions.txt", "w") as f:
        f.write("\n".join([*(name.upper() for name in listed), "nowhere", ""]))
    paths = report.run(
        spark, f"{base}/comments", f"{base}/submissions", f"{base}/model", out, regions_path=f"{base}/regions.txt",
        exclude_regions=[listed[0].upper()], map_overrides={listed[1].upper(): 0.15},
    )
    scored = score.scored_from(DT.comments(spark, SF_SMALL, with_time=True), DT.submissions(spark, SF_SMALL), M.load_models(f"{base}/model"))
    expected = report.sentiment_reports(scored)
    for name, df in expected.items():
        read = readers.read_aggregate_csv(spark, paths[name], df.schema)
        assert not df.exceptAll(read).take(3) and not read.exceptAll(df).take(3), name
        assert name.endswith("below_perfect") or not read.isEmpty(), name
    assert spark.read.parquet(f"{out}/comments.parquet").count() > 0
    scratch = glob.glob(f"{ensure_checkpoint_dir(spark).removeprefix('file:')}/report-*")
    assert not scratch, "the scored table is deleted once the reports are written"

    # The series by date and the map tables, from the day and region tables by hand.
    days = {str(r.date): (r.Positive, r.Negative) for r in expected["daily"].where("date is not null").collect()}
    series = spark.read.option("header", True).csv(paths["daily_by_date"]).collect()
    assert {r.date.replace("-", ""): (float(r.Positive), float(r.Negative)) for r in series} == days
    assert [r.date for r in series] == sorted(r.date for r in series)
    shares = {r.state: (r.Positive, r.Negative) for r in expected["by_region"].collect()}
    overall = expected["overall"].first()
    shown = {r.state: r for r in spark.read.option("header", True).csv(paths["map_intensity"]).collect()}
    ratios = {r.state: r for r in spark.read.option("header", True).csv(paths["approval"]).collect()}
    assert set(shown) == set(ratios) == {name.upper() for name in listed[1:]}
    for name in listed[1:]:
        pos, neg = shares[name]
        by_hand = 0.15 if name == listed[1] else pos
        assert math.isclose(float(shown[name.upper()].positive), 1 - math.sqrt(by_hand / 0.6))
        assert math.isclose(float(shown[name.upper()].negative), 1 - math.sqrt(neg))
        ratio = ratios[name.upper()].ratio
        if overall.Positive and neg:
            assert math.isclose(float(ratio), overall.Negative / overall.Positive * pos / neg, abs_tol=1e-12)
        else:
            assert ratio is None


def test_command_line_values():
    from voxpop.__main__ import _named

    assert _named("Tennessee=0.3") == ("Tennessee", 0.3)
    assert _named("A=B=1") == ("A=B", 1.0)
