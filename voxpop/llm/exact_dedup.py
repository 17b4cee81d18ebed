"""Exact dedup over a persistent digest index.

The index holds one row a digest with the document that stays, in runs that are
bucketed and sorted by digest. New data is reduced to one candidate a digest,
joined against the index by a sort-merge anti-join, and what is new appended.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxpop.llm.common import LOWER, UPPER, cut_points, documents, lower_ascii, range_of, save, scratch_path, text_or_empty
from voxpop.llm.registry import register
from voxpop.llm.sorted_runs import SortedRuns, file_order


def text_digest(col: str = "text") -> Column:
    """SHA-256 of the UTF-8 text after lower-casing A-Z; null counts as empty."""
    return F.unhex(F.sha2(lower_ascii(text_or_empty(col)), 256))


class DigestIndex:
    """Digests seen so far. A second object, also in another session, opens the index
    that lies at ``path``; without a path a new one is made under ``spark.checkpoint.dir``.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = 0, fanout: int = 8):
        self.runs = SortedRuns(spark, path or scratch_path(spark, "digests"), {"digest": "binary"}, "keep_id", fanout, buckets)

    @property
    def path(self) -> str:
        return self.runs.path

    def read(self) -> DataFrame:
        return self.runs.files()

    def add(self, batch: DataFrame) -> None:
        """Store the digests of ``batch`` (id, digest) that the index lacks, each
        with the largest id that carries it in this batch."""
        self.runs.add(batch.groupBy("digest").agg(F.max("id").alias("keep_id")))

    def close(self) -> None:
        """Drop the session's names of the index; its files stay."""
        self.runs.close()


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = 2, index: DigestIndex | None = None
) -> DataFrame:
    """One row a row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    The documents come to the index in ``batches`` of falling id, so the first
    to bring a digest has its largest id. Null texts count as empty, texts may be of
    any length. Null ids sort below all others; ``keep_id`` is null where a group has
    no other. Of rows equal in id and text one is kept. Other columns aren't read; an
    empty table gives an empty result.

    With an ``index`` of earlier tables, a digest that it holds keeps its ``keep_id``
    and no other row stays; new digests are appended. ``group_size`` counts rows of
    ``docs`` alone. A row equal in id and text to the one held is that row, so a job
    that is run again after a failure gives the same result.
    """
    spark = docs.sparkSession
    # Equal rows are counted here, so that one of them can be kept; digests don't
    # compress, and doing without spares each writer its buffers outside the heap.
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_digest(text_col).alias("digest"))
    counted = rows.groupBy("id", "digest").agg(F.count(F.lit(1)).cast("int").alias("copies"))
    digests = save(counted, "op8-digests", compression="none")
    cuts = cut_points(digests, "id", batches)
    falling = F.when(F.col("id").isNull(), F.lit(-1)).otherwise(range_of(F.col("id"), cuts))
    used = index or DigestIndex(spark)
    for at in range(len(cuts), -2, -1):
        used.add(digests.where(falling == at))
    # Counts and index rows are one a digest; written, they can be joined to a
    # digest that a third of all rows share, which Spark then splits.
    sizes = digests.groupBy("digest").agg(F.sum("copies").alias("group_size"))
    with file_order(spark):
        groups = save(used.runs.found(sizes), "op8-groups", compression="none")
    if index is None:
        used.close()
    copies = digests.join(groups, "digest")
    return copies.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


ORACLE_SQL = f"""
WITH d AS (
    SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS digest FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, digest AS text_sha256
FROM d WINDOW w AS (PARTITION BY digest)"""


@register("op8_exact_dedup", ORACLE_SQL)
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))
