"""Line dedup over levelled sorted runs of line hashes.

The runs are Parquet tables, bucketed and sorted by line hash, each line with
the document that owns it. A batch's lines are merge-anti-joined with every run
and what is new becomes a run of level 0; a level that has ``fanout`` runs is
merged into one run of the next. Runs can be kept for later tables. All steps are
DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxpop.llm.common import (
    BLANKS,
    LOWER,
    UPPER,
    cut_points,
    documents,
    hash128,
    lower_ascii,
    range_of,
    save,
    scratch_path,
    text_or_empty,
)
from voxpop.llm.registry import register
from voxpop.llm.sorted_runs import SortedRuns, file_order

KEY = ["h1", "h2"]


class LineRuns(SortedRuns):
    """Levelled runs of (h1, h2, owner); ``levels[i]`` lists the runs of level i. A
    second object, also in another session, opens the runs that lie at ``path``."""

    def __init__(self, spark: SparkSession, fanout: int = 3, buckets: int = 0, path: str | None = None):
        super().__init__(spark, path or scratch_path(spark, "line-runs"), dict.fromkeys(KEY, "long"), "owner", fanout, buckets)

    def add(self, lines: DataFrame) -> None:
        """Take the lines (h1, h2, owner) of a batch that no run holds."""
        super().add(lines.groupBy(*KEY).agg(F.min("owner").alias("owner")))

    def owners(self) -> DataFrame:
        return self.files()


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def line_hashes(line: Column, min_chars: int) -> Column:
    """Hash pair of a line's key; null for keys that are too short."""
    key = line_key(line)
    return F.when(F.length(key) >= min_chars, F.struct(*[h.alias(n) for h, n in zip(hash128(key), KEY)]))


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 10,
    batches: int = 4,
    fanout: int = 3,
    runs: LineRuns | None = None,
) -> DataFrame:
    """``docs`` with __n_lines, __n_dropped and __kept (the lines that stay).

    A key of at least ``min_chars`` code points that several documents hold
    stays in the smallest id only; repeats inside that document stay. Batches
    are taken by rising id, so the first owner of a line is the smallest.
    A null or empty text is one empty line; texts may be of any length. Rows that
    share an id are one document; null ids are one document that sorts after all
    others. All columns of ``docs`` are kept; an empty table gives an empty result.

    With ``runs`` of earlier tables, a line that they hold stays only in the document
    that owns it there, and new lines are added. A job that is run again after a
    failure gives the same result.
    """
    spark = docs.sparkSession
    lines = F.split(text_or_empty(text_col), "\n")
    last = F.lit(2**63 - 1)
    # The ids and line hashes alone, written once: the steps below don't read texts.
    hashed = save(
        docs.select(
            F.coalesce(F.col(id_col).cast("long"), last).alias("owner"),
            F.explode(F.array_distinct(F.transform(lines, lambda x: line_hashes(x, min_chars)))).alias("h"),
        )
        .where("h is not null")
        .select("owner", "h.h1", "h.h2"),
        "op1-lines",
    )
    cuts = cut_points(docs.select(F.col(id_col).cast("long").alias("id")), "id", batches)
    used = runs or LineRuns(spark, fanout)
    for at in range(len(cuts) + 1):
        used.add(hashed.where(range_of(F.col("owner"), cuts) == at))
    if runs is None:
        owners = used.owners()
        used.close()
    else:
        # Of runs of earlier tables only what these documents hold is shuffled.
        with file_order(spark):
            owners = save(used.found(hashed.select(*KEY).distinct()), "op1-found")
    owners = owners.withColumnRenamed("owner", "first")
    lost = (
        hashed.join(owners, KEY)
        .where(F.col("owner") != F.col("first"))
        .groupBy(F.col("owner").alias("__owner"))
        .agg(F.collect_set(F.struct(*KEY)).alias("__lost"))
    )
    same = F.coalesce(F.col(id_col).cast("long"), last) == F.col("__owner")
    joined = docs.join(lost, same, "left").withColumn("__lines", lines)
    stays = lambda x: ~F.coalesce(F.array_contains(F.col("__lost"), line_hashes(x, min_chars)), F.lit(False))
    kept = F.when(F.col("__lost").isNull(), F.col("__lines")).otherwise(F.filter("__lines", stays))
    return (
        joined.withColumn("__stay", kept)
        .withColumn("__n_lines", F.size("__lines").cast("long"))
        .withColumn("__n_dropped", (F.size("__lines") - F.size("__stay")).cast("long"))
        .withColumn("__kept", F.array_join("__stay", "\n"))
        .drop("__owner", "__lost", "__lines", "__stay")
    )


ORACLE_SQL = rf"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents),
keyed AS (
    SELECT doc_id, line, pos,
           translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), '{UPPER}', '{LOWER}') AS key
    FROM lines),
owned AS (SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10 GROUP BY key),
marked AS (
    SELECT k.doc_id, k.line, k.pos, o.owner IS NOT NULL AND o.owner <> k.doc_id AS lost
    FROM keyed k LEFT JOIN owned o ON o.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""


@register("op1_line_dedup", ORACLE_SQL)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id",
        F.col("__n_lines").alias("n_lines"),
        F.col("__n_dropped").alias("n_dropped"),
        F.sha2("__kept", 256).alias("kept_sha256"),
    )
