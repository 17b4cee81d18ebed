"""Writers: Parquet materialisation, single-file CSV reports, sorted slices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Materialise a row-format input once as columnar Parquet.

    ``overwrite`` keeps reruns idempotent (and a retried job after a lost
    executor rewrites the same files through the output committer).
    """
    df.write.mode(mode).parquet(path)


def single_file(df: DataFrame) -> DataFrame:
    """``repartition(1)`` moves the finished rows to one writer; ``coalesce(1)`` would
    pull the stage above it, such as the last step of an aggregate, into one task."""
    return df.repartition(1)


def write_single_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One CSV file with a header, for small final reports only."""
    single_file(df).write.mode(mode).option("header", True).csv(path)


def top_slice(df: DataFrame, order_col: str, n: int, tie_col: str | None = None) -> DataFrame:
    """The first ``n`` rows by ``order_col`` descending (deterministic tie-break)."""
    keys = [F.desc(order_col)] + ([F.asc(tie_col)] if tie_col else [])
    return df.orderBy(*keys).limit(n)


def write_top_slice(df: DataFrame, path: str, order_col: str, n: int, tie_col: str | None = None) -> None:
    """Sorted slice written as one CSV."""
    write_single_csv(top_slice(df, order_col, n, tie_col), path)
