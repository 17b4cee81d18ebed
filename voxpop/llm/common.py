"""Helpers shared by the training-data operators of this subpackage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from voxpop.session import ensure_checkpoint_dir

#: ASCII blanks, in the form that Spark's and DuckDB's regular expressions share.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def save(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under ``spark.checkpoint.dir``."""
    import uuid

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of maximal runs of characters other than ASCII blanks (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else; ``lower`` does that for pure ASCII."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def hash128(col: Column) -> list[Column]:
    """Two 64-bit hashes with different seeds: together wide enough for a corpus."""
    return [F.xxhash64(col), F.xxhash64(F.lit(7), col)]


def cut_points(df: DataFrame, col: str, parts: int) -> list[int]:
    """Ascending values that cut a numeric column into about ``parts`` equal
    parts. At most ``parts - 1`` values come to the driver."""
    if parts < 2:
        return []
    shares = [i / parts for i in range(1, parts)]
    row = df.agg(F.percentile_approx(col, shares, 20 * parts).alias("cuts")).first()
    return sorted({int(x) for x in (row["cuts"] or [])})


def range_of(col: Column, cuts: Sequence[int]) -> Column:
    """Index of the range that a value falls into: the number of cut points
    below it, found by binary search. Nulls sort last."""
    if not cuts:
        return F.lit(0)
    table = F.lit(list(cuts)).cast(T.ArrayType(T.LongType()))
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(cuts).bit_length()))])

    def step(found: Column, width: Column) -> Column:
        ahead = found + width
        fits = (ahead <= len(cuts)) & (F.get(table, ahead - 1) < col)
        return F.when(fits, ahead).otherwise(found)

    return F.when(col.isNull(), F.lit(len(cuts))).otherwise(F.aggregate(steps, F.lit(0), step))


def number_within(df: DataFrame, group: str, order: Sequence[str], out: str) -> DataFrame:
    """Number the rows of each group from 0 without gaps.

    A group may hold any share of the rows, so it's dealt into hash buckets of
    ``order``; rows are numbered inside a bucket, and the buckets' counts, of
    which there are a bounded number a group, give each bucket's first number.
    ``df`` is read twice, so pass a written table. Equal rows may swap numbers.
    """
    buckets = 4 * shuffle_width(df.sparkSession)
    dealt = df.withColumn("__part", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    counts = dealt.groupBy(group, "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("__group").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select(F.col(group).alias("__group"), F.col("__part").alias("__at"), "__n").select(
        "__group", "__at", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first")
    )
    inside = Window.partitionBy(group, "__part").orderBy(*order)
    numbered = dealt.withColumn("__row", F.row_number().over(inside) - 1)
    same = F.col(group).eqNullSafe(F.col("__group")) & (F.col("__part") == F.col("__at"))
    return numbered.join(firsts, same).select(*df.columns, (F.col("__first") + F.col("__row")).alias(out))


def join_few(df: DataFrame, few: DataFrame, on: Column, bound: int, how: str = "inner") -> DataFrame:
    """Join a written table whose rows are counted first: sent to every task up
    to ``bound`` rows, shuffled beyond (skewed keys are then split at run time)."""
    return df.join(F.broadcast(few) if few.limit(bound + 1).count() <= bound else few, on, how)
