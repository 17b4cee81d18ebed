"""The certificates of fitted models hold, and fail when a fitted number is disturbed."""

import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from voxpop.operators import factorize as FA
from voxpop.operators import features as FE
from voxpop.operators import models as M
from voxpop.plans import model_queries as Q
from voxpop.plans import train


def test_a_disturbed_weight_changes_the_loss(spark):
    model, grams = train.fitted_models(spark, SF_SMALL), train.labelled_grams(spark, SF_SMALL)
    assert all(r.same and r.lower and r.flatter for r in Q.certified(spark, model, grams).collect())
    assert not any(r.same for r in Q.certified(spark, model, grams, disturbed=1e-3).collect())


def test_gradient_by_numpy(spark):
    rng = np.random.default_rng(1)
    x = (rng.random((60, 7)) < 0.4).astype(float)
    x[:, 5], x[:, 6] = 0, 1  # features that none and all rows have
    y, w, b = (rng.random(60) < 0.5).astype(float), rng.normal(size=7), 0.3
    rows = spark.createDataFrame([(float(t), Vectors.sparse(7, [(int(j), 1.0) for j in np.flatnonzero(r)])) for r, t in zip(x, y)], ["label", "features"])
    weights = spark.createDataFrame(list(enumerate(map(float, w))), "idx int, weight double")
    got = M.loss_gradient(rows, "label", weights, b, reg=0.5).first()
    spread, z = x.std(axis=0, ddof=1), x @ w + b
    p, use = 1 / (1 + np.exp(-z)), x.std(axis=0) > 0
    slope = (x.T @ (p - y) / 60)[use] / spread[use] + 0.5 * (w * spread)[use]
    assert got.steepest == pytest.approx(np.abs(slope).max())
    assert got.at_intercept == pytest.approx(abs((p - y).mean()))
    assert got.loss == pytest.approx((np.log1p(np.exp(z)) - y * z).mean() + 0.25 * ((w * spread) ** 2).sum())


def test_gradient_vanishes_at_a_converged_fit(spark):
    grams = train.labelled_grams(spark, SF_SMALL)
    rows = M.training_rows(grams, train.fitted_models(spark, SF_SMALL))
    fit = M.logistic(0.2, "positive", "p").setMaxIter(300).setTol(1e-12).fit(rows)
    at = M.loss_gradient(rows, "positive", M.coefficient_table(spark, fit), fit.intercept).first()
    assert at.steepest < 1e-5 and at.at_intercept < 1e-5


def test_fold_areas(spark):
    assert all(r.same and r.n_folds == M.NUM_FOLDS for r in Q.fold_certificate(spark, SF_SMALL).collect())


def test_folds_are_the_same_however_rows_are_dealt(spark):
    ids = spark.range(500).select(F.col("id").cast("string").alias("id"))
    folds = lambda df: {r.id: r.f for r in df.select("id", M.fold_of("id", 5, 7).alias("f")).collect()}
    assert folds(ids.repartition(2)) == folds(ids.repartition(9))
    assert set(folds(ids).values()) == set(range(5))


# -- SVD -----------------------------------------------------------------------


def table(spark, a):
    rows = [(i, int(j), float(a[i, j])) for i in range(len(a)) for j in np.flatnonzero(a[i])]
    return spark.createDataFrame(rows, "row long, idx int, weight double"), spark.range(a.shape[1]).select(F.col("id").cast("int").alias("idx"))


def axes_of(factors):
    return np.stack(factors.axes.orderBy("idx").toPandas()["axes"].to_numpy())


def test_svd_by_numpy(spark):
    rng = np.random.default_rng(2)
    a = np.where(rng.random((80, 50)) < 0.2, rng.random((80, 50)), 0.0)
    entries, columns = table(spark, a)
    got = FA.truncated_svd(entries, columns, 4)
    _, s, vt = np.linalg.svd(a)
    v = axes_of(got)
    assert got.values == pytest.approx(s[:4], rel=1e-10)
    assert np.linalg.norm(v - vt[:4].T @ (vt[:4] @ v), 2) < 1e-6  # sine of the largest angle
    at = {r.row: r.at for r in got.project(entries).collect()}
    assert np.allclose([at.get(i, [0] * 4) for i in range(80)], a @ v)


def test_svd_that_uses_up_the_matrix(spark):
    rng = np.random.default_rng(3)
    a = rng.random((30, 3)) @ rng.random((3, 12))
    entries, columns = table(spark, a)
    assert FA.truncated_svd(entries, columns, 3).values == pytest.approx(np.linalg.svd(a)[1][:3], rel=1e-9)
    with pytest.raises(ValueError, match="rank"):
        FA.truncated_svd(entries, columns, 4)


def test_lsi_of_the_tables_and_a_disturbed_axis(spark):
    rows, entries, factors = Q.lsi_fit(spark, SF_SMALL)
    fitted = entries.join(rows.where("split = 'train'").select("row"), "row")
    pdf = fitted.toPandas()
    a = np.zeros((pdf["row"].nunique(), factors.axes.count()))
    a[np.unique(pdf["row"], return_inverse=True)[1], pdf["idx"]] = pdf["weight"]
    vt, v = np.linalg.svd(a, full_matrices=False)[2][: Q.LSI_RANK], axes_of(factors)
    assert np.linalg.norm(v - vt.T @ (vt @ v), 2) < 1e-6
    assert all(r.eigen and r.unit and r.ordered for r in Q.lsi_checked(fitted, factors).collect())
    bent = factors.axes.withColumn("axes", F.transform("axes", lambda x: x + F.when(F.col("idx") == 0, 1e-4).otherwise(0.0)))
    assert not any(r.eigen for r in Q.lsi_checked(fitted, replace(factors, axes=bent)).collect())
    vectors = Q.lsi_coordinates(rows, entries, factors).drop("lsi")
    model = Q.lsi_regression(vectors)
    weights = model.coefficients.toArray().tolist()
    assert Q.lsi_regression_checked(vectors, weights, model.intercept, model).first().stationary
    weights[0] += 0.05
    assert not Q.lsi_regression_checked(vectors, weights, model.intercept, model).first().stationary


# -- calibrated margins ----------------------------------------------------------


def test_platt_scaling_by_numpy(spark):
    rng = np.random.default_rng(5)
    margin = rng.normal(size=400) * 2
    y = (rng.random(400) < 1 / (1 + np.exp(-(0.7 * margin - 0.4)))).astype(float)
    df = spark.createDataFrame(list(zip(map(float, margin), map(float, y))), "margin double, y double")
    got = M.platt_scaling(df)
    k, n = y.sum(), 400
    t = np.where(y == 1, (k + 1) / (k + 2), 1 / (n - k + 2))
    a, b = 0.0, 0.0
    for _ in range(50):  # plain Newton
        p = 1 / (1 + np.exp(a * margin + b))
        g = np.array([((t - p) * margin).sum(), (t - p).sum()])
        w = p * (1 - p)
        h = np.array([[(w * margin**2).sum(), (w * margin).sum()], [(w * margin).sum(), w.sum()]])
        a, b = np.array([a, b]) - np.linalg.solve(h, g)
    assert (got.slope, got.shift) == pytest.approx((a, b), rel=1e-6)


@pytest.mark.parametrize("labels", [[1.0, 1.0, 0.0, 0.0], [1.0] * 4, [0.0] * 4])
def test_platt_scaling_of_few_separable_margins(spark, labels):
    df = spark.createDataFrame(list(zip([3.0, 2.0, -1.0, -2.0], labels)), "margin double, y double")
    s = M.platt_scaling(df)
    assert math.isfinite(s.slope) and math.isfinite(s.shift)


def test_svc_certificate_sees_a_disturbed_sigmoid(spark):
    fit_half, test = Q.svc_rows(spark, SF_SMALL)
    margins = M.held_out_margins(fit_half, M.linear_svc("positive", "svc"), "positive").persist()
    sigmoid = M.platt_scaling(margins)
    scored = M.linear_svc("positive", "svc").fit(fit_half).transform(test)
    good = Q.svc_checked(margins, sigmoid, M.with_probability(scored, "svc", sigmoid)).first()
    assert good.stationary and good.falling and good.better and good.n_wrong == 0
    bent = M.Sigmoid(sigmoid.slope * 1.01, sigmoid.shift)
    assert not Q.svc_checked(margins, bent, M.with_probability(scored, "svc", bent)).first().stationary


# -- vectors and model folders -----------------------------------------------------


def test_vectors_of_a_distributed_vocabulary(spark):
    rows = [("a", ["x", "y", "x"]), ("b", ["y"]), ("b", ["y", "z"]), ("c", []), (None, None)]
    df = spark.createDataFrame(rows, "id string, grams array<string>")
    vocab, out = FE.binary_vectors(df, min_df=1)
    assert [(r.gram, r.idx) for r in vocab.orderBy("idx").collect()] == [("y", 0), ("x", 1), ("z", 2)]
    assert sorted((r.id or "", r.features.indices.tolist(), r.features.size) for r in out.collect()) == [("", [], 3), ("a", [0, 1], 3), ("b", [0], 3), ("b", [0, 2], 3), ("c", [], 3)]
    space, weighted = FE.tfidf_vectors(df, min_df=1)
    a = next(r.tfidf for r in weighted.collect() if r.id == "a")
    idf = {"x": math.log(6 / 2) + 1, "y": math.log(6 / 4) + 1}
    norm = math.hypot(2 * idf["x"], idf["y"])
    assert space.size == 3 and a.values.tolist() == pytest.approx([idf["y"] / norm, 2 * idf["x"] / norm])


def test_numbers_without_gaps(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").cast("string").alias("s")).repartition(6)
    out = FE.number_rows(df, [F.desc("k"), F.col("s")], "n", "numbers").orderBy("n").collect()
    assert [r.n for r in out] == list(range(1000))
    assert [(r.k, r.s) for r in out] == sorted(((r.k, r.s) for r in out), key=lambda x: (-x[0], x[1]))


def test_both_kinds_of_model_folders(spark, tmp_path):
    model = train.fitted_models(spark, SF_SMALL, folds=3)
    M.save_models(model, str(tmp_path / "pipeline"))
    loaded = M.load_models(str(tmp_path / "pipeline"))
    assert loaded.cv_metrics == model.cv_metrics and len(loaded.stages) == 3
    rows = M.training_rows(train.labelled_grams(spark, SF_SMALL), model, folds=3)
    cv = M.cross_validator(M.logistic(0.2, "positive", "pos"), "positive", "pos_raw", 3, fold_col="fold").fit(rows)
    M.save_models(cv, str(tmp_path / "cv"))
    best = M.load_models(str(tmp_path / "cv"))
    assert best.cv_metrics == {"pos": list(cv.avgMetrics)}
    same = lambda m: [r.pos for r in m.transform(rows).orderBy("id").collect()]
    assert same(best) == same(cv.bestModel)
    with pytest.raises(ValueError, match="not a pipeline"):
        model.stages[1].write().overwrite().save(str(tmp_path / "lr"))
        M.load_models(str(tmp_path / "lr"))
