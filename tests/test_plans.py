"""Physical-plan properties the design relies on (checked on explain output)."""

import re

from tests.conftest import SF_SMALL
from voxpop.operators import aggregates as G
from voxpop.operators import filters as P
from voxpop.operators import joins as J
from voxpop.plans import score, train
from voxpop.session import materialize
from voxpop.sources import driver_tables as DT
from voxpop.sources import sinks as W


def _formatted(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_quote_predicate_reaches_the_scan(spark):
    df = P.quote_filter(DT.comments(spark, SF_SMALL))
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "conversations" in ln]
    assert scan, plan
    # evaluated on the scan output (DataFilters); turn > 0 pushed into the reader
    assert "DataFilters: [" in scan[0] and "RLIKE" in scan[0].split("DataFilters: [", 1)[1]
    assert "GreaterThan(turn,0)" in scan[0]


def test_label_join_is_broadcast(spark):
    plan = _formatted(J.label_join(DT.labels(spark, SF_SMALL), DT.labelled_comment_texts(spark, SF_SMALL)))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_scoring_shuffles_carry_no_text(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # force shuffle joins
    try:
        model = train.fitted_models(spark, SF_SMALL, folds=3)
        plan = _formatted(score.scored_comments(spark, SF_SMALL, model=model))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    blocks = [b for b in plan.split("\n\n") if re.match(r"\(\d+\) Exchange", b.strip())]
    assert any("hashpartitioning(link" in b for b in blocks), "expected a shuffle join on the link id"
    for b in blocks:
        cols = re.search(r"Input \[\d+\]: \[(.*)\]", b).group(1)
        names = {c.strip().split("#")[0] for c in cols.split(",")}
        assert not names & {"text", "body", "grams", "features", "parsed"}, names


def test_report_tables_come_from_one_aggregate(spark):
    model = train.fitted_models(spark, SF_SMALL, folds=3)
    scored = score.scored_comments(spark, SF_SMALL, model=model)
    plan = _formatted(G.sentiment_tables(scored)["daily"])
    assert "Expand" in plan


def test_staged_report_reads_its_own_rows(spark):
    rows = [("t", 20190101, "a", 1, 2, 1.0, 0.0), ("u", 20190102, None, 1, 3, 0.0, 1.0)]
    scored = spark.createDataFrame(rows, "title string, ts int, author_flair_text string, s_score long, c_score long, pos double, neg double")
    staged = G.sentiment_tables(scored, stage=lambda agg: materialize(agg, "staged", ("_gid",)))
    plain = G.sentiment_tables(scored)
    for name, df in plain.items():
        assert df.exceptAll(staged[name]).isEmpty() and staged[name].exceptAll(df).isEmpty(), name
        scan = staged[name]._jdf.queryExecution().executedPlan().toString()
        assert "_gid" in scan.split("PartitionFilters: [", 1)[1].split("]", 1)[0], name


def test_single_file_keeps_the_aggregate_parallel(spark):
    shares = G.share_by(spark.range(100).selectExpr("id % 7 AS k", "id % 2 AS v"), "k", "v")
    plan = W.single_file(shares)._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce" not in plan and plan.index("SinglePartition") < plan.index("HashAggregate")
