"""Grams in blocks: frequencies, codes and bitmaps against plain counting."""

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from voxpop.operators import coded as C
from voxpop.operators import fits
from voxpop.operators import models as M

ROWS = [("a", ["x", "y", "x"]), ("a", ["x"]), (None, ["y", None, "é_z"]), ("d", []), ("e", None), *[(str(i), ["x", f"rare{i}"]) for i in range(20)]]


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(C, "BLOCK", 24)
    monkeypatch.setattr(C, "HASHES", 7)
    monkeypatch.setattr(C, "SENT", 3)


def test_blocks_count_and_keep_every_row(spark, small):
    df = spark.createDataFrame(ROWS, "id string, grams array<string>").coalesce(1)
    made = C.coded(df, "test-grams", kept=F.col("id") != "d")
    plain = Counter(g for _, grams in ROWS for g in {*(grams or [])} - {None})
    assert {r.gram: r.doc_freq for r in made.frequencies().collect()} == plain
    assert Counter(r.id for r in made.rows.collect()) == Counter(i for i, _ in ROWS)
    assert made.grams.select("block").distinct().count() > 3

    def each(cells, known):
        counts = cells.sums(cells.lookup(known["code"].to_numpy(np.int64), np.ones(len(known), np.int64), 0) * cells.counts)
        return pd.DataFrame({"row": cells.rows, "n": counts})

    found = made.each_block(made.grams, each, "row long, n long").join(made.rows, "row").collect()
    assert Counter((r.id, r.n) for r in found) == Counter((i, len([g for g in grams or [] if g])) for i, grams in ROWS if i not in (None, "d"))


def test_bitmap_leaves_out_rare_grams_only(spark, small):
    df = spark.createDataFrame(ROWS, "id string, grams array<string>")
    among = C.maybe_frequent(df, 2)
    made = {r.gram: r.doc_freq for r in C.coded(df, "test-grams", among=among).frequencies().collect()}
    assert made["x"] == 22 and made["y"] == 2 and len(made) < 10
    assert C.maybe_frequent(df, 1) is None


def test_hash_is_of_the_text_alone():
    texts = ["", "a", "b", "aa", "ab", "ba", "é", "a", None, *[f"w{i}_v{i % 7}" for i in range(500)]]
    whole = C.hashes_of(pa.array(texts))
    assert whole[1] == whole[7] and len(np.unique(whole)) == len({t or "" for t in texts})
    assert (C.hashes_of(pa.array(texts).slice(4, 40)) == whole[4:44]).all()


def test_written_scores_are_the_same_and_fits_go_in_parts(spark, monkeypatch):
    rows = [(str(i), ["a", "b"] if i % 3 else ["a", "c"], int(i % 3 == 0), int(i % 5 == 0)) for i in range(60)]
    df = spark.createDataFrame(rows, "id string, grams array<string>, positive int, negative int")
    whole = M.train_sentiment_models(df, folds=2)
    # Each fit by itself, the columns in several groups a task.
    monkeypatch.setattr(fits, "SENT", 1)
    monkeypatch.setattr(fits, "GROUP", 10)
    monkeypatch.setattr(fits, "TASKS", 2)
    parts = M.train_sentiment_models(df, folds=2)
    for a, b in zip(whole.table.orderBy("idx").collect(), parts.table.orderBy("idx").collect(), strict=True):
        assert a.gram == b.gram and a.weights == pytest.approx(b.weights, abs=1e-12) and a.fold_weights == pytest.approx(b.fold_weights, abs=1e-12)
    plain, written = M.score(parts, df), parts.score_written(df, keep_grams=True)
    assert plain.columns == written.columns and plain.exceptAll(written).isEmpty() and written.count() == len(rows)
    assert "grams" not in parts.score_written(df).columns
