"""Comments without a submission go before they're cleaned; none of the others do."""

import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from voxpop.operators import joins as J
from voxpop.plans import score, train
from voxpop.sources import driver_tables as DT

COMMENT = "id string, link_id string, body string"


@pytest.fixture
def comments(spark):
    return spark.range(4000).select(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") % 50 == 7, None).otherwise(F.concat(F.lit("t3_"), F.col("id"))).alias("link_id"),
        F.lit("x").alias("body"),
    )


@pytest.mark.parametrize("per_block", [1, 64, J.BLOOM_BLOCK])
def test_no_match_is_lost_and_few_others_stay(spark, comments, monkeypatch, per_block):
    monkeypatch.setattr(J, "BLOOM_BLOCK", per_block)
    ids = spark.range(0, 4000, 4).select(F.col("id").cast("string").alias("id"))
    ids = ids.unionByName(spark.createDataFrame([(None,), ("0",)], "id string"))
    kept = {int(r[0]) for r in J.prune_unmatched(comments, ids).select("id").collect()}
    wanted = {i for i in range(0, 4000, 4) if i % 50 != 7}
    assert wanted <= kept and len(kept - wanted) < 0.1 * (4000 - len(wanted))


def test_bits_are_those_of_the_ids(spark):
    ids = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "id string")
    table, bits = J.bloom_filter(ids, "id")
    words = [w for block in table.first()["words"] for w in block]
    assert len(words) * 64 == bits
    found = {64 * i + b for i, w in enumerate(words) for b in range(64) if w >> b & 1}
    rows = ids.where("id is not null").select(F.array(*J._bloom_positions(F.col("id"), bits))).collect()
    assert found == {p for r in rows for p in r[0]}


def test_empty_tables_and_the_bound(spark, comments):
    none = spark.createDataFrame([], "id string")
    assert J.prune_unmatched(comments, none).count() == 0
    assert J.prune_unmatched(comments.limit(0), none).count() == 0
    many = comments.select("id")
    assert J.bloom_filter(many, "id", max_bits=1000) is None
    assert J.prune_unmatched(comments, many, max_bits=1000).count() == comments.where("link_id is not null").count()


def test_filter_stands_above_the_scan_and_scores_stay(spark):
    model = train.fitted_models(spark, SF_SMALL, folds=3)
    comments = DT.comments(spark, SF_SMALL)
    some = DT.submissions(spark, SF_SMALL).where(F.col("id").cast("long") % 2 == 0)
    plain, pruned = (score.scored_from(comments, some, model, prune=p).drop("pos_p1", "neg_p1") for p in (False, True))
    assert plain.exceptAll(pruned).isEmpty() and pruned.exceptAll(plain).isEmpty() and not plain.isEmpty()
    lines = pruned._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at, column = next((i, line.index("Filter")) for i, line in enumerate(lines) if "scalar-subquery" in line and "Filter" in line)
    child = next(line[column:] for line in lines[at + 1 :] if line[column : column + 3] == "+- ")
    assert child.startswith("+- Relation") and "turn" in child
    # Built once, however many of its bits a comment is tested for.
    pruned.collect()
    final = pruned._jdf.queryExecution().executedPlan().toString()
    assert len(set(re.findall(r"ReusedSubquery Subquery subquery#(\d+)", final))) == 1
