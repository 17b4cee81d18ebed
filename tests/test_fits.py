"""M3/M4 in tables: fits whose weights stay off the driver take Spark ML's steps."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from voxpop.operators import fits
from voxpop.operators import models as M
from voxpop.plans import train
from voxpop.session import drop_table, materialize, table_kept


def test_fits_of_tables_equal_spark_ml(spark, monkeypatch):
    monkeypatch.setattr(fits, "GROUP", 200)
    monkeypatch.setattr(fits, "CHUNK", 16)
    rng = np.random.default_rng(4)
    x = (rng.random((70, 30)) < 0.3).astype(float)
    x[:, 0], x[:, 1] = 1, 0  # features that all rows and none have
    y, fold = (x[:, 2] + rng.random(70) < 0.8).astype(int), rng.integers(0, 2, 70)
    rows = spark.createDataFrame([(i, int(y[i]), 0, int(fold[i])) for i in range(70)], "pos long, y int, none int, fold int")
    entries = spark.createDataFrame([(int(i), int(j)) for i, j in np.argwhere(x)], "pos long, idx int").repartition(3)
    plan = [fits.Fit("y", None, 1.0), fits.Fit("y", 1, 1.0), fits.Fit("none", None, 1.0)]
    got = fits.fit_all(rows, entries, plan, M.MAX_ITER)
    weights = {r.idx: r.weights for r in got.weights.collect()}
    dense = np.array([weights.get(j, [0.0] * 3) for j in range(30)])
    margins = np.array([r.margins for r in got.margins.orderBy("pos").collect()])
    for i, left_out in enumerate([None, 1]):
        data = [(float(t), Vectors.dense(r)) for t, r, f in zip(y, x, fold) if f != left_out]
        ml = M.logistic(0.5, "label", "p").fit(spark.createDataFrame(data, ["label", "features"]))
        assert dense[:, i] == pytest.approx(ml.coefficients.toArray(), abs=1e-9)
        assert got.intercepts[i] == pytest.approx(ml.intercept, abs=1e-9)
        assert plan[i].history == pytest.approx(list(ml.summary.objectiveHistory), abs=1e-12)
        assert margins[:, i] == pytest.approx(x @ dense[:, i] + got.intercepts[i], abs=1e-9)
    assert got.intercepts[2] == -np.inf and not dense[:, 2].any()


def test_sentiment_weights_stay_in_a_table(spark):
    rows = [(str(i), ["a", "b"] if i % 3 else ["a", "c"], int(i % 3 == 0), int(i % 5 == 0)) for i in range(80)]
    df = spark.createDataFrame([*rows, ("x", [], 0, 1), (None, ["c", "z"], 1, 0)], "id string, grams array<string>, positive int, negative int")
    model = M.train_sentiment_models(df, folds=2)
    assert isinstance(model, M.SentimentModel) and {r.gram for r in model.table.collect()} == {"a", "b", "c"}
    ml = M.PipelineModel(stages=model.stages)
    ours, theirs = (sorted(((r.id or "", r.pos, r.neg, round(r.pos_p1, 9), round(r.neg_p1, 9)) for r in M.score(m, df).collect())) for m in (model, ml))
    assert ours == theirs and len(ours) == 82


def _stub(spark):
    table = materialize(spark.createDataFrame([("a", 0, [1.0, -1.0], [1.0, -1.0])], "gram string, idx int, weights array<double>, fold_weights array<double>"), "train-weights")
    return M.SentimentModel(table, ("pos", "neg"), [0.0, 0.0], [0.0, 0.0], 1, {}, {})


def test_a_model_whose_table_is_gone_is_fitted_again(spark, monkeypatch):
    monkeypatch.setattr(train, "_FITTED", {})
    monkeypatch.setattr(train, "table_version", lambda *_: ())
    monkeypatch.setattr(train, "labelled_grams", lambda *_: None)
    monkeypatch.setattr(M, "train_sentiment_models", lambda *_, **__: _stub(spark))
    first = train.fitted_models(spark, "any")
    assert train.fitted_models(spark, "any") is first and table_kept(first.table)
    drop_table(first.table)
    again = train.fitted_models(spark, "any")
    assert again is not first and again.table.count() == 1


def test_the_held_out_half_is_scored_once(spark, monkeypatch):
    rows = spark.createDataFrame([(str(i), ["a", "b"] if i % 2 else [], i % 2, 0) for i in range(40)], "id string, grams array<string>, positive int, negative int")
    monkeypatch.setattr(train, "labelled_grams", lambda *_: rows)
    held = train.held_out_predictions(spark, "any", model=_stub(spark))
    plan = held._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
    assert sorted((r.id, r.pos_p1 > 0.7) for r in held.collect()) == sorted((r.id, r.positive == 1) for r in M.split_labelled(rows)[1].collect())
