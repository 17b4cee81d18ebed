"""Document fingerprints by winnowing, on DataFrame operations only.

A text is cut into units: runs of characters other than blanks, and the single code
points of runs longer than ``UNIT_CHARS``, so that where a run starts doesn't decide
how the text inside it is cut. Each gram of ``k`` units has a polynomial hash; of every
window of ``w`` grams the smallest hash is kept, the rightmost of equals, with
its position. Two texts that share a run of ``w + k - 1`` units share a mark: that
many short runs between blanks, or as many code points inside long runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voxpop.llm.common import cut_points, documents, range_of, save, shuffle_width, text_or_empty
from voxpop.llm.registry import register

K, WINDOW = 5, 4
UNIT_CHARS = 16
_INK = r"[^\x20\x09-\x0D]"
#: A whole run up to that length, else one code point.
UNIT = rf"(?<!{_INK}){_INK}{{1,{UNIT_CHARS}}}(?!{_INK})|{_INK}"
#: Hashes are taken modulo a prime below 2^31, so that products fit into a long.
PRIME, BASE = 2**31 - 1, 1_000_003
#: Positions take the low half of a packed (hash, position).
LOW = 2**32


def _joined(a: str, b: str, gap: int, n: Column, combine) -> Column:
    """combine(a[i], b[i + gap]) for the ``n`` places where both exist."""
    return F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(1 + gap), n), combine)


def _appended(shift: int):
    return lambda a, b: F.pmod(a * F.lit(shift) + b, F.lit(PRIME))


def _steps(width: int) -> list[int]:
    """Growth of a run from 1 to ``width`` by adding runs no longer than itself."""
    sizes = [1]
    while sizes[-1] < width:
        sizes.append(min(2 * sizes[-1], width))
    return sizes


def winnow(df: DataFrame, text: Column, out: str, k: int = K, w: int = WINDOW) -> DataFrame:
    """Add ``out``: the marks of ``text``, packed as hash * 2^32 + (2^32 - 1 - position).

    A text of fewer than ``k`` units has one gram, all of it; one of fewer than
    ``w`` grams one window; a text without units, empty or null, no mark.
    """
    units = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(UNIT), F.lit(0))
    df = df.withColumn("__units", units).withColumn(
        "__run", F.transform("__units", lambda u: F.pmod(F.xxhash64(u), F.lit(PRIME)))
    )
    n = F.size("__run")
    # Runs of 1, 2, 4 and at last k units: the run's hash shifted by as many
    # places as the run that follows it adds. Runs of 2 and 4 that the last step
    # needs overlap, so the added part is a run of its own length.
    kept = {1: "__run"}
    for size, grown in zip(_steps(k), _steps(k)[1:]):
        added = grown - size
        if added not in kept:
            raise ValueError(f"k = {k} must be a sum of two powers of two, or one")
        shift = pow(BASE, added, PRIME)
        name = f"__run{grown}"
        df = df.withColumn(
            name,
            _joined(kept[size], kept[added], size, F.greatest(n - (grown - 1), F.lit(0)), _appended(shift)),
        )
        kept[grown] = name
    whole = F.when(n > 0, F.array(F.pmod(F.xxhash64(F.array_join("__units", " ")), F.lit(PRIME)))).otherwise(
        F.array().cast("array<bigint>")
    )
    df = df.withColumn("__grams", F.when(n >= k, F.col(kept[k])).otherwise(whole))
    df = df.withColumn("__packed", F.transform("__grams", lambda h, i: h * F.lit(LOW) + (F.lit(LOW - 1) - i.cast("long"))))
    grams = F.size("__packed")
    least = "__packed"
    for size, grown in zip(_steps(w), _steps(w)[1:]):
        name = f"__least{grown}"
        places = F.greatest(grams - (grown - 1), F.lit(0))
        df = df.withColumn(name, _joined(least, least, grown - size, places, lambda a, b: F.least(a, b)))
        least = name
    only = F.when(grams > 0, F.array(F.array_min("__packed"))).otherwise(F.array().cast("array<bigint>"))
    marks = F.array_distinct(F.when(grams >= w, F.col(least)).otherwise(only))
    return df.withColumn(out, marks).drop(*[c for c in df.columns if c.startswith(("__run", "__least", "__units", "__grams", "__packed"))])


def mark_hashes(marks: Column) -> Column:
    return F.transform(marks, lambda m: F.shiftright(m, 32).cast("int"))


def mark_positions(marks: Column) -> Column:
    return F.transform(marks, lambda m: (F.lit(LOW - 1) - m.bitwiseAND(F.lit(LOW - 1))).cast("int"))


def mark_string(marks: Column) -> Column:
    """Marks as text, ``hash@position`` in order, hashes in 8 hexadecimal digits."""
    one = lambda m: F.concat(
        F.lpad(F.lower(F.hex(F.shiftright(m, 32))), 8, "0"),
        F.lit("@"),
        (F.lit(LOW - 1) - m.bitwiseAND(F.lit(LOW - 1))).cast("string"),
    )
    return F.array_join(F.transform(marks, one), " ")


def likeness(a: str, b: str) -> Column:
    """Jaccard index of two hash lists; 1 if both are empty."""
    both, one = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(one == 0, F.lit(1.0)).otherwise(both / one)


def next_in_order(docs: DataFrame, id_col: str, carry: list[str], widen=lambda df: df) -> DataFrame:
    """Add ``__next_<c>``: the columns ``carry`` of the next row by ascending id
    (nulls last, equal ids by text; after the last row the first).

    Rows go to many even ranges of the id, and the first row of each range also
    to the range before it, so one shuffle brings every row next to its follower.
    ``widen`` adds columns after that shuffle and before the window.
    """
    width = 4 * shuffle_width(docs.sparkSession)
    cuts = cut_points(docs, id_col, width)
    ranged = docs.withColumn("__range", range_of(F.col(id_col), cuts)).withColumn("__tail", F.lit(False))
    order = [F.col(id_col).asc_nulls_last(), F.col("text").asc()]
    # One row a range, at most ``width``: the range, its first id, the range before it.
    heads = save(
        ranged.groupBy("__range").agg(F.min(id_col).alias("__first")).select(F.col("__range").alias("__r"), "__first"), "op6-heads"
    )
    around = Window.orderBy("__r")
    last = F.max("__r").over(Window.partitionBy())
    heads = heads.withColumn("__before", F.coalesce(F.lag("__r").over(around), last))
    at_head = (F.col("__range") == F.col("__r")) & F.col(id_col).eqNullSafe(F.col("__first"))
    tails = ranged.join(F.broadcast(heads), at_head)
    # Of rows that share a range's first id, the one with the least text.
    by_range = Window.partitionBy("__before").orderBy("text")
    tails = (
        tails.withColumn("__at", F.row_number().over(by_range))
        .where("__at = 1")
        .select(*docs.columns, F.col("__before").alias("__range"), F.lit(True).alias("__tail"))
    )
    rows = ranged.unionByName(tails).repartition(shuffle_width(docs.sparkSession), "__range")
    within = Window.partitionBy("__range").orderBy(F.col("__tail"), *order)
    out = widen(rows)
    for c in carry:
        out = out.withColumn(f"__next_{c}", F.lead(c).over(within))
    return out.where(~F.col("__tail")).drop("__range", "__tail")


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, w: int = WINDOW) -> DataFrame:
    """Marks of every text, of its edited text (the last half of its code points
    replaced by the first as many of the next document) and their likeness.

    Columns: doc_id, text, edited, marks, edited_marks, near_edited, near_next.
    Null texts are empty; the only row of a table follows itself; an empty table
    gives an empty result; other columns aren't read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    marked = next_in_order(rows, "doc_id", ["text", "marks"], lambda df: winnow(df, F.col("text"), "marks", k, w))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("__next_text", F.lit(1), half))
    both = winnow(marked.withColumn("edited", edited), F.col("edited"), "edited_marks", k, w)
    both = both.withColumn("__own", mark_hashes(F.col("marks")))
    both = both.withColumn("__edited", mark_hashes(F.col("edited_marks"))).withColumn("__after", mark_hashes(F.col("__next_marks")))
    return both.select(
        "doc_id", "text", "edited", "marks", "edited_marks",
        likeness("__own", "__edited").alias("near_edited"),
        likeness("__own", "__after").alias("near_next"),
    )


@register("op6_fingerprints")
def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_edits(documents(spark, sf_dir)).select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        mark_string(F.col("marks")).alias("fingerprint"),
        mark_string(F.col("edited_marks")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
