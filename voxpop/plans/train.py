"""Training job: labelled comments -> grams -> vocabulary + two CV'd regressions.

    labels ⋈ comments (J1, label side broadcast after a size check)
      -> clean + gram list (T1-T8, only for labelled rows: the join runs first)
      -> targets (P2/P3) -> numbered vocabulary (M1)
      -> deterministic half split (P16) -> cross-validation of both (M3-M6)
      -> one SentimentModel: a table of the vocabulary and both models' weights
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxpop.functions import text as T
from voxpop.operators import filters as P
from voxpop.operators import evaluate as E
from voxpop.operators import joins as J
from voxpop.operators import models as M
from voxpop.session import materialize, table_kept
from voxpop.sources import driver_tables as DT
from voxpop.sources import sinks as W

#: Fitted models that a session remembers.
MODELS_KEPT = 4
_FITTED: dict[tuple, M.SentimentModel] = {}


#: Tasks that clean the labelled rows and train on them, at least, as few rows may lie in
#: one file; and labels a task, so that what a task holds does not grow with their number.
LABELLED_PARTS = 8
LABELLED_ROWS = 2048


def labelled_grams_from(labels: DataFrame, comments: DataFrame, parts: int = LABELLED_PARTS) -> DataFrame:
    """(id, grams, dem, gop, djt, positive, negative) for labelled comments, dealt by
    id and sorted, so that folds and fits are the same on every run."""
    joined = J.label_join(labels, comments).filter(F.col("body").isNotNull())
    parts = max(parts, -(-labels.count() // LABELLED_ROWS))
    dealt = joined.select("id", "body", "dem", "gop", "djt").repartition(parts, "id")
    grams = T.with_gram_list(dealt.sortWithinPartitions("id", "dem", "gop", "djt", "body"), "body").drop("body")
    return P.label_targets(grams)


def labelled_grams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled_grams_from(DT.labels(spark, sf_dir), DT.labelled_comment_texts(spark, sf_dir))


def table_version(spark: SparkSession, path: str) -> tuple:
    """(name, length, modification time) of a table's files, as its store lists them: it
    changes when the table is written anew, and no row is read for it."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    files, found = store.listFiles(root, True), []
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


def fitted_models(spark: SparkSession, sf_dir: str, folds: int = M.NUM_FOLDS, seed: int = 7) -> M.SentimentModel:
    """Train once per (application, data, folds, seed) and reuse within the session.

    The fitted model (vocabulary, two coefficient vectors, those of the folds) is a
    written table; if it was deleted with the scratch folders, the training runs again.
    """
    version = tuple(table_version(spark, DT.path(sf_dir, name)) for name in ("labels", "documents"))
    key = (spark.sparkContext.applicationId, folds, seed, *version)
    table = getattr(_FITTED.get(key), "table", None)
    if table is not None and not table_kept(table):
        del _FITTED[key]
    if key not in _FITTED:
        while len(_FITTED) >= MODELS_KEPT:
            del _FITTED[next(iter(_FITTED))]  # the oldest
        _FITTED[key] = M.train_sentiment_models(labelled_grams(spark, sf_dir), folds=folds, seed=seed)
    return _FITTED[key]


def held_out_predictions(spark: SparkSession, sf_dir: str, model: M.SentimentModel | None = None) -> DataFrame:
    """The test half of the labelled rows, scored by both models. The narrow rows are
    written once, as most statistics read them several times and scoring cleans the texts."""
    model = model or fitted_models(spark, sf_dir)
    _, test = M.split_labelled(labelled_grams(spark, sf_dir))
    scored = model.score_written(test) if isinstance(model, M.SentimentModel) else M.score(model, test)
    return materialize(scored.select("id", "positive", "negative", "pos", "neg", "pos_p1", "neg_p1"), "held-out")


def run(spark: SparkSession, labels_path: str, comments_path: str, model_path: str,
        folds: int = M.NUM_FOLDS, seed: int = 7) -> M.SentimentModel:
    """Command-line form on the forum inputs: CSV labels + JSON comments -> saved model.
    Malformed lines of the comments go beside the model, to ``<model>_malformed``."""
    from voxpop.sources import readers as R

    labels = R.read_labels(spark, labels_path)
    comments = R.read_comments(spark, comments_path, quarantine=f"{model_path.rstrip('/')}_malformed").select("id", "body")
    grams = labelled_grams_from(labels, comments)
    model = M.train_sentiment_models(grams, folds=folds, seed=seed)
    M.save_models(model, model_path)
    W.write_single_csv(evaluation(grams, model), f"{model_path.rstrip('/')}_evaluation.csv")
    return model


def evaluation(grams: DataFrame, model: M.SentimentModel) -> DataFrame:
    """(model, metric, value): label counts of both halves, mean cross-validated and
    held-out area under ROC, and held-out rows with the label."""
    split = P.hash_split(grams, "id", 0.5).select("id", "split", "positive", "negative")
    _, test = M.split_labelled(grams)
    held = M.score(model, test)
    parts = []
    for prefix, label in (("pos", "positive"), ("neg", "negative")):
        rows = lambda metric, value: (F.lit(prefix).alias("model"), metric.alias("metric"), value.cast("double").alias("value"))  # noqa: E731,B023
        named = F.concat(F.lit("label "), F.col(label).cast("string"), F.lit(" in "), F.col("split"))
        parts.append(split.groupBy(named.alias("name")).count().select(*rows(F.col("name"), F.col("count"))))
        parts.append(E.auc_rank(held, f"{prefix}_p1", label).select(*rows(F.lit("held-out area under ROC"), F.col("auc"))))
        listed = held.filter(F.col(label) != 0).agg(F.count(F.lit(1)).alias("n"))
        parts.append(listed.select(*rows(F.lit("held-out rows with the label"), F.col("n"))))
        mean = getattr(model, "cv_metrics", {}).get(prefix, [None])[0]
        if mean is not None:
            parts.append(listed.select(*rows(F.lit("cross-validated area under ROC"), F.lit(mean))))
    return reduce(DataFrame.unionByName, parts)


def positive_label_listing(predictions: DataFrame) -> DataFrame:
    """Held-out rows whose positive label is not 0."""
    return P.nonzero_label(predictions, "positive")
