"""Each pipeline stage against its brute-force meaning, on what the one before it kept."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as CP
from tests.conftest import SF_SMALL
from tests.llm.test_dedup import components_by_hand, lines_by_hand, simhash_by_hand
from tests.llm.test_operators import reference_ids, targets_by_hand


@pytest.fixture(scope="module")
def kept(spark):
    from voxpop.llm.common import documents, save

    docs, out = documents(spark, SF_SMALL), []
    for name, stage in CP.STAGES:
        out.append(docs)
        docs = save(stage(spark, docs, SF_SMALL), "test-stage")
    return [d.toPandas() for d in (*out, docs)]


def test_columns(kept):
    for pdf in kept[:-1]:
        assert list(pdf.columns) == CP.COLUMNS


def test_quality_stage_drops_label_0_and_keeps_label_1(spark, kept):
    before, after = kept[0], set(kept[1]["doc_id"])
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").toPandas().set_index("doc_id")["quality"]
    known = [i for i in before["doc_id"] if i in labels.index]
    assert after <= set(before["doc_id"])
    assert sum((i in after) == (labels[i] == 1) for i in known) / len(known) > 0.95


def test_line_stage(kept):
    wanted = {i: t for i, _, _, t in lines_by_hand(list(zip(kept[1]["doc_id"], kept[1]["text"])))}
    assert dict(zip(kept[2]["doc_id"], kept[2]["text"])) == wanted
    assert (kept[2]["n_chars"] == kept[2]["text"].map(len)).all()


def test_near_stage(kept):
    import numpy as np

    rows = kept[2].sort_values("doc_id")
    group = components_by_hand(np.array([simhash_by_hand(t) for t in rows["text"]], np.uint64), 4)
    assert sorted(kept[3]["doc_id"]) == [rows["doc_id"].iloc[i] for i in sorted(set(group))]


def test_mix_stage(kept):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    before, after = kept[3], kept[4]
    sizes = before.groupby("source")["text"].agg(lambda x: sum(map(size, x))).to_dict()
    target, largest = targets_by_hand(sizes), before["text"].map(size).groupby(before["source"]).max()
    taken = after["text"].map(size).groupby(after["source"]).sum()
    assert all(abs(taken.get(s, 0) - t) <= largest[s] for s, t in target.items())
    assert after.groupby("doc_id").size().max() <= 3


def test_pack_stage(kept):
    docs, pieces = kept[4], kept[5]
    total = sum(map(len, reference_ids(docs["text"])))
    assert pieces["length"].sum() == total and (pieces["piece"] == 0).sum() == len(docs)
    assert pieces["sequence_id"].nunique() <= 1.02 * total / 1024 + 2


def test_run_equals_the_stages(spark, kept):
    again = CP.run(spark, SF_SMALL).toPandas()
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    digest = lambda pdf: hashlib.sha256(repr(sorted(map(tuple, pdf[cols].to_numpy().tolist()))).encode()).hexdigest()
    assert digest(again) == digest(kept[-1])


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in CP.STAGES:
        assert stage(spark, docs, SF_SMALL).count() == 0


def test_stages_take_odd_rows(spark, odd_docs):
    for _, stage in CP.STAGES:
        out = stage(spark, odd_docs.withColumn("extra", F.lit(1)), SF_SMALL)
        assert out.count() >= 0
