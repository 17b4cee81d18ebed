"""Sharding by vector bin packing: bytes, tokens and rows balanced jointly.

Documents of equal text form a group. A group goes to the shard where the dot
product of its demand (bytes, tokens, rows) and the shard's residual capacity is
highest, large groups first. Groups that are large against a shard are few and
are placed first, in one task; then blocks of small groups are placed, each block
into its share of the capacity that is left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voxpop.llm.common import documents, hash128, join_few, number_within, save, text_or_empty, word_count
from voxpop.llm.registry import register

SHARDS = 16
#: A group above this part of a shard is dealt out to all of them: into as many
#: pieces as there are shards, or a multiple, so that each can take its share.
PIECE = 1 / 2
#: A group above this part of a shard is placed before the blocks; there are at
#: most 3 * SHARDS / HEAVY of them, whatever the table.
HEAVY = 1 / 256
#: Groups in a block.
BLOCK = 8192
DIMS = ["bytes", "tokens", "rows"]


def place(demand: np.ndarray, room: np.ndarray, first: int = 0) -> np.ndarray:
    """Shard of each demand row; ``room`` (shards x dims) is what each shard has
    left and is reduced in place. Rows come largest first; ties of the dot product
    go to the shard that follows ``first`` most closely."""
    turn = np.roll(np.arange(len(room)), -first)
    left = room[turn]
    out = np.empty(len(demand), dtype=np.int32)
    for i, d in enumerate(demand):
        at = int(np.argmax(left @ d))
        left[at] -= d
        out[i] = turn[at]
    room[turn] = left
    return out


def _in_order(pdf: pd.DataFrame) -> pd.DataFrame:
    largest = pdf[DIMS].max(axis=1)
    return pdf.assign(largest=largest).sort_values(["largest", "h1", "h2", "piece"], ascending=[False, True, True, True])


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """One row a row of ``docs``: doc_id, size, text_crc32, shard, slot.

    Size is the UTF-8 length plus 1, tokens are words. Rows of equal text share a
    shard unless they outweigh half of one; then their rows are dealt one by one to
    all shards, whatever their ids. Null texts are empty texts. Slots number a shard's
    rows from 0. Rows equal in id and text may swap shards and slots; other columns aren't read; an empty table
    gives an empty result.
    """
    text = text_or_empty(text_col)
    h1, h2 = hash128(text)
    rows = save(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + 1).cast("long").alias("size"),
            word_count(F.col(text_col)).alias("words"),
            F.crc32(text).alias("text_crc32"),
            h1.alias("h1"),
            h2.alias("h2"),
            # Tells equal rows apart; fixed once it's written.
            F.monotonically_increasing_id().alias("row"),
        ),
        "op5-rows",
    )
    sums = [F.sum("size").alias("bytes"), F.sum("words").alias("tokens"), F.count(F.lit(1)).alias("rows")]
    total = rows.agg(*sums).first()
    full = {c: max(total[c] or 0, 1) for c in DIMS}
    # Demands as parts of a shard, from here on.
    part = {c: F.col(c) * (shards / full[c]) for c in DIMS}
    groups = rows.groupBy("h1", "h2").agg(*sums)
    largest = F.greatest(*part.values())
    pieces = F.when(largest > PIECE, F.least(F.ceil(largest / shards) * shards, F.col("rows"))).otherwise(1).cast("int")
    # At most 3 * shards / PIECE groups are that large, so the table is small.
    large = save(
        groups.withColumn("pieces", pieces).where("pieces > 1").select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), "pieces"),
        "op5-large",
    )
    same = (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2"))
    dealt = rows.join(F.broadcast(large), same, "left").withColumn(
        "piece", F.coalesce(F.pmod(F.xxhash64("doc_id", "row"), F.col("pieces")), F.lit(0)).cast("int")
    )
    items = save(
        dealt.groupBy("h1", "h2", "piece").agg(*sums).select("h1", "h2", "piece", *[part[c].alias(c) for c in DIMS]), "op5-items"
    )
    key, placed_type = ["h1", "h2", "piece"], "h1 long, h2 long, piece int, shard int"
    heavy = F.greatest(*DIMS) > HEAVY

    def place_heavy(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = _in_order(pdf)
        return pdf[key].assign(shard=place(pdf[DIMS].to_numpy(), np.ones((shards, len(DIMS)))))

    first = items.where(heavy).withColumn("one", F.lit(0)).groupBy("one").applyInPandas(lambda pdf: place_heavy(pdf), placed_type)
    first = save(first, "op5-heavy")
    used = first.join(items.where(heavy), key).groupBy("shard").agg(*[F.sum(c).alias(c) for c in DIMS]).collect()
    room = np.ones((shards, len(DIMS)))
    for r in used:
        room[r["shard"]] -= [r[c] for c in DIMS]
    # What fills the shards evenly: their room less the mean that stays free.
    light = items.where(~heavy)
    blocks = max(1, -(-light.count() // BLOCK))
    mine = light.withColumn("block", F.pmod(F.xxhash64("h1", "h2", "piece"), F.lit(blocks)).cast("int"))

    def place_block(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = _in_order(pdf)
        demand, block = pdf[DIMS].to_numpy(), int(pdf["block"].iloc[0])
        lacking = np.maximum(room, 0)
        share = lacking / np.maximum(lacking.sum(axis=0), 1e-12) * demand.sum(axis=0)
        return pdf[key].assign(shard=place(demand, share, block % shards))

    rest = mine.groupBy("block").applyInPandas(lambda pdf: place_block(pdf), placed_type)
    shard_of = save(first.unionByName(rest), "op5-shards").select(
        F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("piece").alias("p3"), "shard"
    )
    in_shard = (F.col("h1") == F.col("p1")) & (F.col("h2") == F.col("p2")) & (F.col("piece") == F.col("p3"))
    assigned = save(dealt.join(shard_of, in_shard).select("doc_id", "size", "text_crc32", "row", "shard"), "op5-assigned")
    return number_within(assigned, "shard", ["doc_id", "text_crc32", "row"], "slot").drop("row")


@register("op5_sharding")
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(documents(spark, sf_dir)).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
