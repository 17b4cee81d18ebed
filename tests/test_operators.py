"""Joins, filters, evaluation helpers, sources and sinks against brute force."""

import bz2
import json
import os
import tempfile

import pandas as pd
from pyspark.sql import functions as F

from voxpop.operators import aggregates as G
from voxpop.operators import evaluate as E
from voxpop.operators import filters as P
from voxpop.operators import joins as J
from voxpop.sources import readers as R
from voxpop.sources import sinks as W


def test_hot_key_join_equals_plain_join(spark):
    # one key holds more than a third of the fact rows
    fact = spark.range(0, 3000).select(
        F.col("id").alias("fid"), F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50).alias("k")
    )
    dim = spark.range(0, 40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    a = sorted(tuple(r) for r in J.hot_key_join(fact, dim, "k", 0.05).select("fid", "k", "v").collect())
    b = sorted(tuple(r) for r in fact.join(dim, "k").select("fid", "k", "v").collect())
    assert a == b and len(a) > 0


def test_sized_broadcast_respects_bound(spark):
    small = spark.range(10)
    assert "broadcast" in str(J.sized_broadcast(small, 100)._jdf.queryExecution().logical()).lower()
    assert "broadcast" not in str(J.sized_broadcast(small, 5)._jdf.queryExecution().logical()).lower()


def test_region_lookup_case_insensitive_exact_wins(spark):
    regions = spark.createDataFrame([("District of Columbia",), ("Ohio",), ("Puerto Rico",)], "state string")
    sent = spark.createDataFrame(
        [("District Of Columbia", 0.1, 0.9), ("District of Columbia", 0.2, 0.8), ("ohio ", 0.5, 0.5)],
        "state string, Positive double, Negative double",
    )
    got = {r.state: (r.Positive, r.Negative) for r in J.region_lookup(regions, sent, exclude=["Puerto Rico"]).collect()}
    assert got == {"District of Columbia": (0.2, 0.8), "Ohio": (0.5, 0.5)}


def test_quote_filter_drops_quotes_and_nulls(spark):
    df = spark.createDataFrame([("1", "  &gt x"), ("2", "/s&gt"), ("3", "a /s b"), ("4", None)], "id string, body string")
    got = sorted((r.id, r.body) for r in P.quote_filter(df).collect())
    assert got == [("3", "a  b")]


def test_hash_split_is_deterministic_and_complete(spark):
    df = spark.range(0, 2000).select(F.col("id").cast("string").alias("id"))
    a = P.hash_split(df, "id", 0.5)
    b = P.hash_split(df, "id", 0.5)
    assert a.subtract(b).count() == 0
    counts = {r.split: r["count"] for r in a.groupBy("split").count().collect()}
    assert sum(counts.values()) == 2000 and 800 < counts["train"] < 1200


def test_running_totals_match_pandas(spark):
    import random

    rnd = random.Random(3)
    rows = [(float(rnd.randint(0, 300)), rnd.randint(0, 1)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "score double, label int")
    counts = E.score_label_counts(df, "score", "label")
    got = E.running_totals(counts, "score", ["pos", "neg"], buckets=7).orderBy("score").toPandas()
    pdf = pd.DataFrame(rows, columns=["score", "label"])
    g = pdf.groupby("score").label.agg(pos="sum", n="count").reset_index().sort_values("score")
    assert list(got.pos_cum) == list(g.pos.cumsum())
    assert list(got.neg_cum) == list((g.n - g.pos).cumsum())


def test_rank_auc_equals_evaluator_and_brute_force(spark):
    import random

    from pyspark.ml.functions import array_to_vector

    rnd = random.Random(5)
    rows = [(float(rnd.randint(0, 40)), int(rnd.random() < 0.4)) for _ in range(500)]
    df = spark.createDataFrame(rows, "score double, label int")
    auc = E.auc_rank(df, "score", "label", buckets=5).first().auc
    trap = E.auc_trapezoid(df, "score", "label", buckets=3).first().auc
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    brute = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    raw = df.select(array_to_vector(F.array(-F.col("score"), F.col("score"))).alias("raw"), F.col("label").cast("double"))
    ev = E.evaluator_auc(raw, "raw", "label")
    assert abs(auc - brute) < 1e-12 and abs(trap - brute) < 1e-12 and abs(ev - brute) < 1e-9


def test_roc_points_brute_force(spark):
    rows = [(0.1, 0), (0.4, 1), (0.4, 0), (0.8, 1), (0.9, 1), (0.2, 0)]
    df = spark.createDataFrame(rows, "score double, label int")
    got = {r.threshold: (r.fpr, r.tpr) for r in E.roc_points(df, "score", "label", buckets=2).collect()}
    P_, N_ = 3, 3
    for t in {s for s, _ in rows}:
        tp = sum(1 for s, y in rows if s >= t and y == 1)
        fp = sum(1 for s, y in rows if s >= t and y == 0)
        assert got[t] == (fp / N_, tp / P_)


def test_top_k_tie_break(spark):
    df = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", 0.9), ("d", 0.1)], "title string, percentage double")
    assert [r.title for r in G.top_k(df, "percentage", 3, "title").collect()] == ["c", "a", "b"]


def test_label_csv_binds_by_position_and_permissive(spark):
    d = tempfile.mkdtemp(prefix="vp-csv-", dir="/tmp")
    path = os.path.join(d, "labels.csv")
    with open(path, "w") as fh:
        fh.write("Input_id,labeldem,labelgop,labeldjt\nabc,0,1,-99\nxyz,1,-1,x\nabc,0,0,1\n")
    got = sorted((tuple(r) for r in R.read_labels(spark, path).collect()), key=str)
    assert got == sorted([("abc", 0, 1, -99), ("abc", 0, 0, 1), ("xyz", 1, -1, None)], key=str)
    targets = {(r.djt, r.positive, r.negative) for r in P.label_targets(R.read_labels(spark, path)).collect()}
    assert (-99, 0, 0) in targets and (None, 0, 0) in targets and (1, 1, 0) in targets


def test_json_and_bz2_cleaning_job(spark):
    d = tempfile.mkdtemp(prefix="vp-json-", dir="/tmp")
    lines = [json.dumps({"body": "Hello, World! http://x.y z", "id": "a"}), json.dumps({"body": "e . g fine", "id": "b"})]
    plain = os.path.join(d, "c.json")
    with open(plain, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    packed = os.path.join(d, "c.json.bz2")
    with bz2.open(packed, "wt") as fh:
        fh.write("\n".join(lines) + "\n")
    for p in (plain, packed):
        rows = sorted(r.parsed for r in R.clean_json_file(spark, p).collect())
        assert rows == ["e.g fine", "hello , world ! z"]


def test_single_csv_sink_and_parquet_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="vp-sink-", dir="/tmp")
    df = spark.createDataFrame([("t1", 0.5), ("t2", 1.0)], "title string, percentage double")
    W.write_single_csv(df, os.path.join(d, "top.csv"))
    parts = [f for f in os.listdir(os.path.join(d, "top.csv")) if f.endswith(".csv")]
    assert len(parts) == 1
    W.write_parquet(df, os.path.join(d, "t.parquet"))
    back = R.read_parquet(spark, os.path.join(d, "t.parquet"))
    assert sorted(tuple(r) for r in back.collect()) == [("t1", 0.5), ("t2", 1.0)]


def test_grouping_set_tables_equal_single_aggregates(spark):
    import random

    rnd = random.Random(9)
    rows = [
        (rnd.choice(["t1", "t2", "t3"]), rnd.choice([20240101, 20240102]), rnd.choice(["A", " A", "B", None]),
         rnd.randint(0, 3), rnd.randint(0, 5), float(rnd.randint(0, 1)), float(rnd.randint(0, 1)))
        for _ in range(400)
    ]
    df = spark.createDataFrame(
        rows, "title string, ts int, author_flair_text string, s_score bigint, c_score bigint, pos double, neg double"
    )
    t = G.sentiment_tables(df)

    def as_set(d):
        return {tuple(r) for r in d.collect()}

    assert as_set(t["title_positive"]) == as_set(G.share_by(df, "title", "pos"))
    assert as_set(t["title_negative"]) == as_set(G.share_by(df, "title", "neg"))
    assert as_set(t["daily"]) == as_set(G.sentiment_by(df, "ts", "date"))
    assert as_set(t["by_region"]) == as_set(G.sentiment_by_state(df))
    assert as_set(t["by_submission_score"]) == as_set(G.sentiment_by_score(df, "s_score", "submission_score"))
    assert as_set(t["by_comment_score"]) == as_set(G.sentiment_by_score(df, "c_score", "comment_score"))
    assert as_set(t["overall"]) == as_set(G.sentiment_overall(df))


def test_sample_and_split_are_independent(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("id"))
    rows = P.hash_split(P.hash_sample(df, "id", 0.2), "id").groupBy("split").count().collect()
    counts = {r["split"]: r["count"] for r in rows}
    assert 1700 < counts["train"] < 2300 and 1700 < counts["test"] < 2300
    few = P.hash_sample(spark.range(200000).select(F.col("id").cast("string").alias("id")), "id", 0.00004).count()
    assert 1 <= few <= 25


def test_rank_statistics_of_odd_input(spark):
    from voxpop.operators import evaluate as E

    rows = [(0.1, 0), (0.9, 1), (None, 1), (float("nan"), 0), (0.5, None), (0.3, 0)]
    df = spark.createDataFrame(rows, "s double, y int")
    assert E.auc_rank(df, "s", "y").first()[0] == 1.0 == E.auc_trapezoid(df, "s", "y").first()[0]
    for odd in (df.where("y = 1"), df.where("y = 0"), df.limit(0)):
        assert E.auc_rank(odd, "s", "y").first()[0] is None
        assert E.auc_trapezoid(odd, "s", "y").first()[0] is None
        assert all(r.tpr is None or r.fpr is None for r in E.roc_points(odd, "s", "y").collect())


def test_a_cut_vocabulary_raises(spark):
    import pytest

    from voxpop.operators import features as FE

    df = spark.createDataFrame([(["a", "b", "c"],), (["a", "b", "d"],)], "grams array<string>")
    assert len(FE.binary_vectorizer(df, min_df=1.0).vocabulary) == 4
    with pytest.raises(ValueError, match="bound"):
        FE.binary_vectorizer(df, min_df=1.0, vocab_size=3)


def test_tfidf_keeps_repeated_ids_apart(spark):
    from voxpop.operators import features as FE

    df = spark.createDataFrame([("1", ["a", "b"]), ("1", ["a"]), ("2", ["a", "c"])], "id string, grams array<string>")
    rows = FE.tfidf_weights(df, min_df=1, max_df=None).collect()
    assert sorted((r.id, r.gram) for r in rows) == [("1", "a"), ("1", "a"), ("1", "b"), ("2", "a"), ("2", "c")]
    assert any(r.weight == 1.0 for r in rows)


def test_single_csv_does_not_narrow_the_aggregate(spark, tmp_path):
    from voxpop.sources import sinks as W

    W.write_single_csv(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count(), str(tmp_path / "t"))
    assert len(list((tmp_path / "t").glob("part-*.csv"))) == 1
