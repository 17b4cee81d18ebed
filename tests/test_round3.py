"""ROC curve, malformed lines and the training cache."""

import math

import numpy as np
import pytest

from tests.conftest import SF_SMALL
from voxpop.operators import evaluate as E
from voxpop.plans import train
from voxpop.sources import driver_tables as DT
from voxpop.sources import readers as R
from voxpop.sources import schemas


def curve_by_hand(rows):
    scores = sorted({s for s, _ in rows}, reverse=True)
    p, n = sum(y for _, y in rows), sum(1 - y for _, y in rows)
    step = {s: (sum(y for t, y in rows if t == s), sum(1 - y for t, y in rows if t == s)) for s in scores}
    out, tp, fp = [(math.inf, 0.0, 0.0)], 0, 0
    for i, s in enumerate(scores):
        tp, fp = tp + step[s][0], fp + step[s][1]
        if i in (0, len(scores) - 1) or step[s] != step[scores[i + 1]]:
            out.append((s, fp / n if n else None, tp / p if p else None))
    return out


@pytest.mark.parametrize("buckets", [2, 3, 7, 50])
@pytest.mark.parametrize("seed", [0, 1, 2])
def test_roc_curve_by_hand(spark, buckets, seed):
    rng = np.random.default_rng(seed)
    rows = [(float(rng.integers(0, 25)), int(rng.random() < 0.5)) for _ in range(60)]
    got = E.roc_curve(spark.createDataFrame(rows, "s double, y int"), "s", "y", buckets=buckets).collect()
    assert sorted((-r.threshold, r.fpr, r.tpr) for r in got) == sorted((-t, f, p) for t, f, p in curve_by_hand(rows))


def test_roc_curve_begins_at_the_origin(spark):
    rows = [(4.0, 1), (3.0, 0), (2.0, 1), (1.0, 0)]
    got = E.roc_curve(spark.createDataFrame(rows, "s double, y int"), "s", "y").orderBy(E.F.desc("threshold")).collect()
    assert [(r.fpr, r.tpr) for r in got] == [(0, 0), (0, 0.5), (0.5, 0.5), (0.5, 1), (1, 1)]


@pytest.mark.parametrize("rows", [[], [(1.0, 1), (2.0, 1)], [(1.0, 0)], [(None, 1), (2.0, None), (float("nan"), 0)]])
def test_roc_curve_of_one_class_or_nothing(spark, rows):
    got = E.roc_curve(spark.createDataFrame(rows, "s double, y int"), "s", "y").collect()
    assert got[0].threshold == math.inf and all(r.fpr is None or r.tpr is None for r in got[1:])


def test_malformed_lines_are_kept_apart(spark, tmp_path):
    good = ['{"id": "a", "title": "t", "score": 1}', '{"id": "b"}', "{}"]
    bad = ['{"id": "c", "tit', "no json", '{"id": "d", "score": "many"}', '["list"]']
    (tmp_path / "in.json").write_text("\n".join(good + bad + [""]))
    kept = R.read_submissions(spark, str(tmp_path / "in.json"), quarantine=str(tmp_path / "q"))
    assert kept.columns == schemas.SUBMISSION_SCHEMA.fieldNames()
    assert sorted(r.id or "" for r in kept.collect()) == ["", "a", "b"]
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "q")).collect()) == sorted(bad)
    assert R.read_submissions(spark, str(tmp_path / "in.json")).count() == 7


def test_cleaning_quarantines(spark, tmp_path):
    (tmp_path / "in.json").write_text('{"body": "Hello there."}\n{"body": \n')
    out = R.clean_json_file(spark, str(tmp_path / "in.json"), quarantine=str(tmp_path / "q"))
    assert out.count() == 1 and spark.read.text(str(tmp_path / "q")).count() == 1


def test_training_cache_reads_no_rows(spark, tmp_path, monkeypatch):
    made = []
    monkeypatch.setattr(train.M, "train_sentiment_models", lambda *a, **k: made.append(k) or len(made))
    monkeypatch.setattr(train, "_FITTED", {})
    sf = str(tmp_path / "sf")
    for name in ("labels", "documents"):
        spark.read.parquet(DT.path(SF_SMALL, name)).write.parquet(DT.path(sf, name))
    assert [train.fitted_models(spark, sf) for _ in range(3)] == [1, 1, 1]
    assert train.fitted_models(spark, sf + "/") == 1
    spark.read.parquet(DT.path(SF_SMALL, "labels")).limit(50).write.mode("overwrite").parquet(DT.path(sf, "labels"))
    assert train.fitted_models(spark, sf) == 2
    for seed in range(10, 20):
        train.fitted_models(spark, sf, seed=seed)
    assert len(train._FITTED) <= train.MODELS_KEPT
