"""Gram features: vocabulary, binary bag-of-grams, TF-IDF.

Two forms of each:

* DataFrame form (``vocabulary``, ``binary_pairs``, ``tfidf_weights``):
  explode -> groupBy -> join. Sparse (doc, gram, value) rows, no vocabulary
  cap, checkable in SQL, and the shape to use when the vocabulary itself is
  large.
* Spark ML form: ``tfidf_vectors`` and ``binary_vectors`` number the grams in a
  distributed table and put sparse vectors together from it, whatever the size of
  the vocabulary. ``binary_vectorizer`` is a ``CountVectorizerModel`` for a saved
  pipeline, whose vocabulary comes to the driver whole; a bound may be set, and a fit
  that reaches it fails.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from voxpop.session import materialize

# The feature settings of the reference models.
MIN_DF = 5.0
TFIDF_MAX_DF = 0.99


def explode_grams(df: DataFrame, arr_col: str) -> DataFrame:
    """One row per gram. ``explode_outer`` + a filter after the generator: a plain
    ``explode`` makes the optimiser infer ``size(arr) > 0`` and push it below the
    projection that computes the grams, evaluating the cleaning twice."""
    out = df.select("*", F.explode_outer(arr_col).alias("gram")).drop(arr_col)
    return out.filter(F.col("gram").isNotNull())


def doc_gram_pairs(df: DataFrame, id_col: str = "id", grams_col: str = "grams") -> DataFrame:
    """Distinct (id, gram) pairs: a document counts once per gram (binary)."""
    return explode_grams(df.select(F.col(id_col).alias("id"), F.array_distinct(grams_col).alias("_g")), "_g")


def doc_gram_counts(df: DataFrame, id_col: str = "id", grams_col: str = "grams") -> DataFrame:
    """(id, gram, tf) raw term counts per document."""
    exploded = explode_grams(df.select(F.col(id_col).alias("id"), F.col(grams_col).alias("_g")), "_g")
    return exploded.groupBy("id", "gram").agg(F.count(F.lit(1)).alias("tf"))


def _df_bounds(n_docs: F.Column, min_df: float, max_df: float | None):
    """Document-frequency bounds as Spark ML reads them: >= 1 means a count,
    < 1 a fraction of the documents."""
    lo = F.lit(min_df) if min_df >= 1 else F.lit(min_df) * n_docs
    hi = None
    if max_df is not None:
        hi = F.lit(max_df) if max_df >= 1 else F.lit(max_df) * n_docs
    return lo, hi


def vocabulary(df: DataFrame, id_col: str = "id", grams_col: str = "grams", min_df: float = MIN_DF,
               max_df: float | None = None) -> DataFrame:
    """(gram, doc_freq) for grams in at least ``min_df`` documents.

    A partial aggregate per task, then one shuffle on the gram. The document
    count for fractional bounds is a scalar subquery (no driver round trip).
    """
    pairs = doc_gram_pairs(df, id_col, grams_col)
    return frequent(pairs.groupBy("gram").agg(F.count(F.lit(1)).alias("doc_freq")), df, min_df, max_df)


def frequent(freq: DataFrame, df: DataFrame, min_df: float = MIN_DF, max_df: float | None = None) -> DataFrame:
    """The grams of ``freq`` (gram, doc_freq) within the bounds, of the documents ``df``."""
    if min_df >= 1 and (max_df is None or max_df >= 1):
        n_docs = F.lit(0)  # no bound is a share of them
    else:
        n_docs = df.select(F.count(F.lit(1))).scalar()
    lo, hi = _df_bounds(n_docs, min_df, max_df)
    cond = F.col("doc_freq") >= lo
    if hi is not None:
        cond = cond & (F.col("doc_freq") <= hi)
    return freq.filter(cond)


def binary_pairs(df: DataFrame, id_col: str = "id", grams_col: str = "grams", min_df: float = MIN_DF) -> DataFrame:
    """M1 (DataFrame form): non-zero entries of the binary feature matrix as (id, gram)."""
    vocab = vocabulary(df, id_col, grams_col, min_df).select("gram")
    return doc_gram_pairs(df, id_col, grams_col).join(vocab, on="gram", how="left_semi").select("id", "gram")


def tfidf_weights(df: DataFrame, id_col: str = "id", grams_col: str = "grams", min_df: float = MIN_DF,
                  max_df: float | None = TFIDF_MAX_DF) -> DataFrame:
    """M11 (DataFrame form): L2-normalised TF-IDF with smoothed idf
    ``ln((1 + n) / (1 + df)) + 1`` as (id, gram, weight).

    Per-document norms use a window partitioned by document: a group is one
    document's distinct grams, bounded by the document's length.
    """
    # Keyed by row, as an id may repeat, and by the id itself: rows that are dealt by it
    # are counted where they are. Written once, so that the text is cleaned once and
    # frequencies and weights read the same narrow table.
    rows = df.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), F.col(grams_col).alias("_g"))
    counts = materialize(explode_grams(rows, "_g").groupBy("id", "row", "gram").agg(F.count(F.lit(1)).alias("tf")), "tfidf-counts")
    n_docs = df.select(F.count(F.lit(1))).scalar()
    freq = counts.groupBy("gram").agg(F.count(F.lit(1)).alias("doc_freq"))
    lo, hi = _df_bounds(n_docs, min_df, max_df)
    cond = F.col("doc_freq") >= lo
    if hi is not None:
        cond = cond & (F.col("doc_freq") <= hi)
    idf = freq.filter(cond).select(
        "gram", (F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("doc_freq"))) + F.lit(1.0)).alias("idf")
    )
    raw = counts.join(idf, on="gram").select("id", "row", "gram", (F.col("tf") * F.col("idf")).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("row")))
    return raw.select("id", "gram", (F.col("w") / norm).alias("weight"))


# ---------------------------------------------------------------------------
# Spark ML stages
# ---------------------------------------------------------------------------
def binary_vectorizer(df: DataFrame, input_col: str = "grams", output_col: str = "features", min_df: float = MIN_DF,
                      vocab_size: int | None = None) -> CountVectorizerModel:
    """M1: binary bag-of-grams, fitted on the labelled rows only.

    The vocabulary is the DataFrame aggregate's, commonest grams first and equal
    counts by gram, so that the features don't depend on how the rows are dealt. All
    its grams come to the driver, and no gram is left out. With ``vocab_size`` at most
    so many come; a vocabulary that reaches this bound would be cut, so the fit fails.
    """
    found = vocabulary(df.select(F.lit(0).alias("id"), F.col(input_col).alias("grams")), min_df=min_df)
    found = found.orderBy(F.desc("doc_freq"), "gram").select("gram")
    grams = (found if vocab_size is None else found.limit(vocab_size)).toArrow().column("gram").to_pylist()
    if vocab_size is not None and len(grams) >= vocab_size:
        raise ValueError(f"the vocabulary reached its bound of {vocab_size} grams; raise vocab_size")
    if not grams:
        raise ValueError(f"no gram is in {min_df:g} labelled rows")
    return _binary_model(grams, input_col, output_col)


def _binary_model(grams: list[str], input_col: str, output_col: str) -> CountVectorizerModel:
    """``from_vocabulary``, which sends the grams one call each; here they go to the
    JVM in one string. A gram that holds the separator takes the plain way."""
    if any("\n" in g for g in grams):
        return CountVectorizerModel.from_vocabulary(grams, input_col, output_col, binary=True)
    lines = SparkSession.getActiveSession()._jvm.java.util.regex.Pattern.compile("\n").split("\n".join(grams))
    model = CountVectorizerModel._create_from_java_class("org.apache.spark.ml.feature.CountVectorizerModel", lines)
    return model.setInputCol(input_col).setOutputCol(output_col)._set(binary=True, vocabSize=len(grams))


def number_rows(df: DataFrame, order: list[Column], out: str, name: str) -> DataFrame:
    """``df`` with the numbers 0, 1, ... in ``order``, without gaps and without a global
    sort in one task: rows are dealt into ranges and written, numbered within their
    range, and each range starts where those before it end (one row a range)."""
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialize(df.repartitionByRange(width, *order).withColumn("_range", F.spark_partition_id()), name)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    firsts = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    firsts = firsts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    numbered = dealt.withColumn("_at", F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1)
    # At most ``width`` rows: a proven bound for the broadcast.
    return numbered.join(F.broadcast(firsts), "_range").select(*df.columns, (F.col("_first") + F.col("_at")).cast("int").alias(out))


def numbered_vocabulary(freq: DataFrame, name: str = "vocabulary") -> DataFrame:
    """(gram, doc_freq, idx) of a ``vocabulary``: a written table with gap-free numbers,
    commonest grams first and equal counts by gram. Nothing comes to the driver, so
    it may be of any size."""
    return materialize(number_rows(freq.select("gram", "doc_freq"), [F.desc("doc_freq"), F.col("gram")], "idx", f"{name}-ranges"), name)


def sparse_vectors(rows: DataFrame, entries: DataFrame, size: int, output_col: str, name: str = "vectors") -> DataFrame:
    """``rows`` with a sparse ML vector each, put together from ``entries`` (row, idx,
    weight); without any, the vector is empty. Both have the key ``row``. The vectors
    are written as the structure they're stored in and read again as vectors, so no
    Python worker makes them."""
    made = entries.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("idx", "weight"))).alias("_e"))
    listed = lambda field, kind: F.coalesce(F.transform("_e", lambda e: e[field]), F.array().cast(kind))
    vector = F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"), listed("idx", "array<int>").alias("indices"), listed("weight", "array<double>").alias("values")
    )
    out = rows.join(made, "row", "left").select(*rows.columns, vector.alias(output_col))
    schema = StructType([f if f.name != output_col else StructField(output_col, VectorUDT()) for f in out.schema.fields])
    return materialize(out, name, schema=schema)


@dataclass(frozen=True)
class TfidfSpace:
    """The fitted TF-IDF features: a written table (gram, doc_freq, idx, idf) and its
    number of grams."""

    vocab: DataFrame
    size: int

    def entries(self, rows: DataFrame, grams_col: str = "grams") -> DataFrame:
        """(row, idx, weight): the L2-normalised non-zeros of ``rows``, keyed by ``row``."""
        counts = doc_gram_counts(rows, "row", grams_col).withColumnRenamed("id", "row")
        raw = counts.join(self.vocab.select("gram", "idx", "idf"), "gram").select("row", "idx", (F.col("tf") * F.col("idf")).alias("w"))
        norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("row")))
        return raw.select("row", "idx", (F.col("w") / norm).alias("weight"))


def fit_tfidf(df: DataFrame, grams_col: str = "grams", min_df: float = MIN_DF, max_df: float | None = TFIDF_MAX_DF) -> TfidfSpace:
    """Vocabulary and smoothed idf of ``df``, each row a document. The vocabulary is
    numbered as a distributed table; only the numbers of rows and grams are counted."""
    rows = df.select(F.monotonically_increasing_id().alias("id"), F.col(grams_col).alias("grams"))
    n_docs = df.count()
    numbered = numbered_vocabulary(vocabulary(rows, min_df=min_df, max_df=max_df), "tfidf-vocabulary")
    idf = F.log(F.lit(1.0 + n_docs) / (F.lit(1.0) + F.col("doc_freq"))) + F.lit(1.0)
    return TfidfSpace(numbered.withColumn("idf", idf), numbered.count())


def tfidf_vectors(df: DataFrame, input_col: str = "grams", output_col: str = "tfidf",
                  min_df: float = MIN_DF, max_df: float = TFIDF_MAX_DF) -> tuple[TfidfSpace, DataFrame]:
    """M11 (ML form): the fitted space, and ``df`` with a sparse TF-IDF vector a row in
    the place of its grams."""
    space = fit_tfidf(df, input_col, min_df, max_df)
    rows = materialize(df.withColumn("row", F.monotonically_increasing_id()), "tfidf-rows")
    return space, sparse_vectors(rows.drop(input_col), space.entries(rows, input_col), space.size, output_col, "tfidf-vectors").drop("row")


def binary_vectors(df: DataFrame, input_col: str = "grams", output_col: str = "features", min_df: float = MIN_DF) -> tuple[DataFrame, DataFrame]:
    """M1 without a bound on the vocabulary: the numbered vocabulary and ``df`` with a
    sparse 0/1 vector a row in the place of its grams. ``binary_vectorizer`` is the form whose vocabulary travels
    with a saved model."""
    rows = materialize(df.withColumn("row", F.monotonically_increasing_id()), "binary-rows")
    numbered = numbered_vocabulary(vocabulary(rows, "row", input_col, min_df), "binary-vocabulary")
    pairs = doc_gram_pairs(rows, "row", input_col).withColumnRenamed("id", "row").join(numbered.select("gram", "idx"), "gram")
    entries = pairs.select("row", "idx", F.lit(1.0).alias("weight"))
    return numbered, sparse_vectors(rows.drop(input_col), entries, numbered.count(), output_col, "binary-vectors").drop("row")
