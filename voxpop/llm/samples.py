"""Bounded samples of labelled documents to fit a classifier on."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voxpop.llm.common import save


def id_remainder(id_col: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; -1 for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % parts, F.lit(-1)).cast("int")


#: Rows of each label that come into the sample first.
PER_LABEL = 20
#: Tasks whose first rows of a label are ranked together, before all are.
TASKS_TOGETHER = 16


def _first_of_each_label(known: DataFrame, order: list) -> DataFrame:
    """The first PER_LABEL rows of each label, ranked in two steps: a label's rows
    of a few tasks, then what is left of them. Each task sends at most PER_LABEL
    rows a label, so a label that half of all rows have is no larger than others."""
    few_tasks = F.floor(F.spark_partition_id() / TASKS_TOGETHER)
    for keys in (["label", "__tasks"], ["label"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        known = (known if len(keys) == 1 else known.withColumn("__tasks", few_tasks)).withColumn("__rank", rank)
        known = known.where(F.col("__rank") <= PER_LABEL).drop("__rank")
    return known.drop("__tasks")


def first_by_hash(known: DataFrame, draw: Column, order: list, rows: int) -> DataFrame:
    """The first ``rows`` rows by ``order``, which begins with the hash ``draw``.

    Hashes are even, so about 5/4 of ``rows`` lie below the bound that is set by the
    number of rows, and only these are sorted; where fewer than ``rows`` do, the bound
    is widened. Without it each task would send ``rows`` rows to the one that sorts.
    """
    total = known.count()
    share = 1.25 * rows / max(total, 1)
    while share < 1:
        below = known.where(draw < F.lit(int((share - 0.5) * 2**64)).cast("long"))
        if below.count() >= rows:
            return below.orderBy(*order).limit(rows)
        share *= 4
    return known.orderBy(*order).limit(rows)


#: The former name, which callers outside the package may still use.
_first_by_hash = first_by_hash


def labelled_sample(labelled: DataFrame, docs: DataFrame, rows: int, chars: int) -> pd.DataFrame:
    """Up to ``rows`` pairs (label, text) of ``labelled`` (doc_id, label) and
    ``docs`` (doc_id, text), whole texts of at most ``chars`` characters together.

    With a column ``key``, the xxhash64 of a text, a label goes to that text only;
    else to every text of its id. Rows equal in id, text and label count once, rows
    without id or label not at all; null texts are empty. The first PER_LABEL rows of
    each label come before all others; among those the hash of id (and key) decides
    alone, as it does on the order. Where not all texts fit, the longest are left out,
    and none of up to ``chars`` / ``rows`` characters is: lengths decide first, then
    the chosen texts are read. An empty table gives an empty sample; fails where there
    are labelled documents but none of them fits.
    """
    names = ["doc_id"] + ["key"] * ("key" in labelled.columns)
    known = labelled.where("doc_id is not null and label is not null").select(*names, "label").distinct()
    known = save(known, "sample-labelled")
    order = [F.xxhash64(*names), *map(F.col, names), F.col("label")]
    of_each = _first_of_each_label(known, order[:-1]).withColumn("turn", F.lit(0))
    hashed = first_by_hash(known, order[0], order, rows).withColumn("turn", F.lit(1))
    few = of_each.unionByName(hashed).groupBy(*names, "label").agg(F.min("turn").alias("turn")).orderBy("turn", *order).limit(rows)
    few = save(few, "sample-few")  # at most ``rows`` rows, without texts
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def texts_of(chosen: DataFrame, on: list[str]) -> DataFrame:
        return texts.withColumn("key", F.xxhash64("text")).join(F.broadcast(chosen), on)

    sized = texts_of(few, names).select("doc_id", "key", "label", "turn", F.length("text").alias("chars")).distinct()
    # At most ``rows`` rows meet here, unless ids repeat: again the first ones.
    order = [F.col("turn"), F.xxhash64(*names), F.col("doc_id"), F.col("key"), F.col("label")]
    by_length = Window.orderBy(F.greatest("chars", F.lit(chars // rows)), *order)
    running = by_length.rowsBetween(Window.unboundedPreceding, 0)
    fits = sized.orderBy(*order).limit(rows).withColumn("upto", F.sum("chars").over(running)).where(F.col("upto") <= chars)
    kept = save(fits.select("doc_id", "key", "label"), "sample-kept")
    found = texts_of(kept, ["doc_id", "key"]).groupBy("doc_id", "key", "label").agg(F.first("text").alias("text"))
    sample = found.orderBy(*order[1:]).select("doc_id", "label", "text").toPandas()
    if sample.empty and known.join(docs.select("doc_id"), "doc_id", "left_semi").limit(1).count():
        raise ValueError(f"no labelled document was sampled: none of those looked at has a text of at most {chars} characters")
    return sample
