"""Row filters, label targets, deterministic sampling and splitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxpop.functions import text as T

# Deterministic sampling / splitting compares the first 15 hex digits (60 bits) of
# md5(salt:key) with the fraction of 2^60. The same rows are chosen in Spark and in
# plain SQL engines, and on every recomputation (no RNG state). Every purpose has
# a salt of its own, so that a sample holds rows of both halves of a split.
HASH_RANGE = 2**60
SAMPLE_SALT, SPLIT_SALT = "sample", "split"


def key_hash(key: Column | str, salt: str) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(F.lit(f"{salt}:"), k.cast("string")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def label_targets(df: DataFrame, label_col: str = "djt") -> DataFrame:
    """``positive = djt == 1``, ``negative = djt == -1`` (NULL, -99 -> 0)."""
    lab = F.col(label_col)
    return df.withColumn("positive", F.when(lab == 1, 1).otherwise(0)).withColumn(
        "negative", F.when(lab == -1, 1).otherwise(0)
    )


def nonzero_label(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Rows whose label is not 0."""
    return df.filter(F.col(label_col) != 0)


def quote_filter(df: DataFrame, body_col: str = "body", out_col: str = "body") -> DataFrame:
    """P5 + T9: drop quoted comments; the kept body has every ``/s`` removed.

    The rows are chosen by the quote rule alone; only kept bodies are rewritten.
    NULL bodies drop out.
    """
    kept = df.filter(T.mark_quotes_and_sarcasm(body_col) != F.lit(T.QUOTE_MARKER))
    return kept.withColumn(out_col, F.replace(F.col(body_col), F.lit(T.SARCASM_MARKER), F.lit("")))


def exclude_values(df: DataFrame, col: str, values: list) -> DataFrame:
    """Drop rows whose ``col`` is in a parameter list (NULL kept)."""
    if not values:
        return df
    return df.filter(~F.col(col).isin(*values) | F.col(col).isNull())


def override_values(df: DataFrame, key_col: str, value_col: str, overrides: dict) -> DataFrame:
    """Replace ``value_col`` for listed keys (a parameter map)."""
    if not overrides:
        return df
    expr = None
    for k, v in overrides.items():
        cond = F.col(key_col) == F.lit(k)
        expr = F.when(cond, F.lit(float(v))) if expr is None else expr.when(cond, F.lit(float(v)))
    return df.withColumn(value_col, expr.otherwise(F.col(value_col)))


def null_perfect(df: DataFrame, col: str) -> DataFrame:
    """A share of exactly 1.0 becomes NULL."""
    return df.withColumn(col, F.nullif(F.col(col), F.lit(1.0)))


def hash_sample(df: DataFrame, key: str, fraction: float) -> DataFrame:
    """Deterministic Bernoulli-like sample by key hash."""
    return df.filter(key_hash(key, SAMPLE_SALT) < int(fraction * HASH_RANGE))


def hash_split(df: DataFrame, key: str, train_fraction: float = 0.5, col: str = "split") -> DataFrame:
    """Deterministic train/test split by key hash (same rows every run)."""
    cut = int(train_fraction * HASH_RANGE)
    return df.withColumn(col, F.when(key_hash(key, SPLIT_SALT) < cut, F.lit("train")).otherwise(F.lit("test")))
