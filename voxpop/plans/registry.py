"""Registry of catalog queries and the SQL fragments shared by their oracles.

Every query is a ``(spark, sf_dir) -> DataFrame`` over the driver tables; its
DuckDB twin (when SQL can express it) aliases every column identically.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from voxpop.operators import filters as P
from voxpop.operators import joins as J
from voxpop.sources import driver_tables as DT

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco


# ---------------------------------------------------------------------------
# Shared SQL fragments (DuckDB dialect) mirroring the driver-table adapters.
# ---------------------------------------------------------------------------
SQL_LABELS = """
    SELECT CAST(doc_id AS VARCHAR) AS id, quality AS dem, toxic AS gop,
           CAST(CASE WHEN toxic = 1 THEN -1 WHEN quality = 1 THEN 1 ELSE 0 END AS INTEGER) AS djt
    FROM labels"""
SQL_LABELLED_TEXTS = """
    SELECT CAST(doc_id AS VARCHAR) AS id, text AS body, source AS author_flair_text, n_chars
    FROM documents"""
SQL_LABELLED = f"""
    SELECT c.id, c.body, c.author_flair_text, c.n_chars, l.dem, l.gop, l.djt,
           CASE WHEN l.djt = 1 THEN 1 ELSE 0 END AS positive,
           CASE WHEN l.djt = -1 THEN 1 ELSE 0 END AS negative
    FROM ({SQL_LABELLED_TEXTS}) c JOIN ({SQL_LABELS}) l ON c.id = l.id"""


def labelled_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled comments with 0/1 positive/negative targets (J1 + P2)."""
    joined = J.label_join(DT.labels(spark, sf_dir), DT.labelled_comment_texts(spark, sf_dir))
    return P.label_targets(joined)


