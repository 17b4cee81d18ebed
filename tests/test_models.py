"""Model invariants on the small driver tables: thresholds, determinism,
persistence round trip, one-pass scoring."""

import os
import tempfile

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from voxpop.operators import evaluate as E
from voxpop.operators import models as M
from voxpop.plans import score, train


def _model(spark):
    return train.fitted_models(spark, SF_SMALL, folds=3)


def test_prediction_is_probability_above_threshold(spark):
    p = train.held_out_predictions(spark, SF_SMALL, model=_model(spark)).collect()
    assert p, "held-out half is empty"
    for r in p:
        assert r.pos == (1.0 if r.pos_p1 > M.POSITIVE_THRESHOLD else 0.0)
        assert r.neg == (1.0 if r.neg_p1 > M.NEGATIVE_THRESHOLD else 0.0)


def test_saved_model_scores_identically(spark):
    model = _model(spark)
    path = os.path.join(tempfile.mkdtemp(prefix="vp-model-", dir="/tmp"), "m")
    M.save_models(model, path)
    a = train.held_out_predictions(spark, SF_SMALL, model=model)
    b = train.held_out_predictions(spark, SF_SMALL, model=M.load_models(path))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_scoring_is_one_pass_and_complete(spark):
    model = _model(spark)
    scored = score.scored_comments(spark, SF_SMALL, model=model)
    assert {"pos", "neg", "pos_p1", "neg_p1"} <= set(scored.columns)
    # one output row per kept comment: no fan-out, and every kept comment scored
    n = scored.count()
    assert n == scored.select("comment_id").distinct().count()
    assert scored.filter("pos IS NULL OR neg IS NULL").count() == 0
    from voxpop.operators import filters as P
    from voxpop.operators import joins as J
    from voxpop.sources import driver_tables as DT

    kept = P.quote_filter(J.comment_submission_join(DT.comments(spark, SF_SMALL, with_time=True),
                                                    DT.submissions(spark, SF_SMALL)))
    assert n == kept.count()


def test_rank_auc_matches_spark_evaluator_on_model_scores(spark):
    from pyspark.ml.functions import array_to_vector

    p = train.held_out_predictions(spark, SF_SMALL, model=_model(spark))
    ours = E.auc_rank(p, "pos_p1", "positive").first().auc
    raw = p.select(array_to_vector(F.array(-F.col("pos_p1"), F.col("pos_p1"))).alias("raw"),
                   F.col("positive").cast("double").alias("label"))
    theirs = E.evaluator_auc(raw, "raw", "label")
    if ours is not None:
        assert abs(ours - theirs) < 1e-9


def test_fixed_seed_gives_equal_models(spark):
    grams = train.labelled_grams(spark, SF_SMALL)
    a = M.train_sentiment_models(grams, folds=3, seed=11)
    b = M.train_sentiment_models(grams, folds=3, seed=11)
    pa = train.held_out_predictions(spark, SF_SMALL, model=a)
    pb = train.held_out_predictions(spark, SF_SMALL, model=b)
    assert pa.exceptAll(pb).count() == 0 and pb.exceptAll(pa).count() == 0
    assert a.stages[0].vocabulary == b.stages[0].vocabulary


def test_ml_tfidf_vectors_agree_with_dataframe_form(spark):
    from voxpop.operators import features as FE
    from voxpop.plans import model_queries

    stats = {r.id: (r.nnz, r.norm) for r in model_queries.tfidf_vectors_nnz(spark, SF_SMALL).collect()}
    weights = FE.tfidf_weights(train.labelled_grams(spark, SF_SMALL))
    counts = {r.id: r["count"] for r in weights.groupBy("id").count().collect()}
    assert stats
    for doc, (nnz, norm) in stats.items():
        assert nnz == counts.get(doc, 0)
        assert (nnz == 0 and norm == 0.0) or abs(norm - 1.0) < 1e-9


def test_binary_model_equals_from_vocabulary(spark):
    from pyspark.ml.feature import CountVectorizerModel

    from voxpop.operators import features as FE

    df = spark.createDataFrame([(["b", "b", "é_x", "z", "c d"],), ([],)], "g array<string>")
    for grams in (["b", "é_x", "c d"], ["z", "with\nbreak", "b"]):
        plain = CountVectorizerModel.from_vocabulary(grams, "g", "f", binary=True)
        quick = FE._binary_model(grams, "g", "f")
        values = lambda m: {p.name: m.getOrDefault(p) for p in m.params if m.isDefined(p)}
        assert quick.vocabulary == plain.vocabulary and values(quick) == values(plain)
        assert quick.transform(df).collect() == plain.transform(df).collect()
