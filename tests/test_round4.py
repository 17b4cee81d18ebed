"""Round 3's findings: each test fails on the code before."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxpop.operators import factorize as FA
from voxpop.operators import features as FE



def test_centres_are_fitted_in_pieces():
    import tracemalloc

    from voxpop.llm import vector_search as V

    sample = np.random.default_rng(3).standard_normal((20_000, 8))
    sample /= V.lengths(sample)[:, None]
    tracemalloc.start()
    V.fit_centres(sample, 2_000, rounds=1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6  # all distances at once take 320 MB



def test_vocabulary_beyond_the_old_bound(spark):
    grams = 1 << 18
    df = spark.range(1).select(F.transform(F.sequence(F.lit(0), F.lit(grams)), lambda i: i.cast("string")).alias("grams"))
    assert len(FE.binary_vectorizer(df, min_df=1.0).vocabulary) == grams + 1



def test_svd_basis_has_a_row_a_text(spark, monkeypatch):
    """What each round writes follows the rows, not the far more columns."""
    written = {}
    keep = FA.materialize
    monkeypatch.setattr(FA, "materialize", lambda df, name, *a, **b: written.setdefault(name, keep(df, name, *a, **b)) if name == "svd-basis" else keep(df, name, *a, **b))
    monkeypatch.setattr(FA, "GROUP", 100)
    a = np.random.default_rng(5).standard_normal((6, 60))
    entries = spark.createDataFrame([(r, c, float(a[r, c])) for r in range(6) for c in range(60)], "row long, idx int, weight double")
    got = FA.truncated_svd(entries, entries.select("idx").distinct(), 3)
    assert got.values == pytest.approx(np.linalg.svd(a)[1][:3], rel=1e-9)
    assert written["svd-basis"].count() == 6
    axes = np.array([r.axes for r in got.axes.orderBy("idx").collect()])
    assert np.allclose(a.T @ (a @ axes), axes * np.array(got.values) ** 2)



def test_labelled_rows_a_task_are_bounded(spark):
    from voxpop.plans import train

    n = 9 * train.LABELLED_ROWS if hasattr(train, "LABELLED_ROWS") else 20_000
    ids = spark.range(n).select(F.col("id").cast("string").alias("id"))
    labels = ids.select("id", F.lit(1).alias("dem"), F.lit(0).alias("gop"), F.lit(1).alias("djt"))
    grams = train.labelled_grams_from(labels, ids.select("id", F.lit("a b").alias("body")))
    assert grams.rdd.getNumPartitions() > train.LABELLED_PARTS



def test_tfidf_counts_need_no_shuffle_of_their_own(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(FE, "materialize", lambda df, name: plans.append(df) or df)
    df = spark.createDataFrame([("1", ["a", "b"]), ("2", ["a"])], "id string, grams array<string>").repartition(4, "id")
    FE.tfidf_weights(df, min_df=1.0)
    assert plans[0]._jdf.queryExecution().sparkPlan().toString() and plans[0]._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1



def test_vectors_are_written_without_grams(spark):
    df = spark.createDataFrame([("1", ["a", "b"]), ("2", ["a"])], "id string, grams array<string>")
    assert FE.binary_vectors(df, min_df=1)[1].columns == ["id", "features"]
    assert FE.tfidf_vectors(df, min_df=1)[1].columns == ["id", "tfidf"]
