"""Sentiment models: binary bag-of-grams + two cross-validated logistic regressions.

The vocabulary and both regressions are kept together in one ``PipelineModel``
(vectoriser, positive model, negative model), so the feature indices a model
was trained on always travel with it. Scoring vectorises once and applies both
models in one pass (distinct output columns), instead of scoring twice and
joining the two results.
"""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import LinearSVC, LinearSVCModel, LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxpop.operators import features as FE
from voxpop.operators import filters as P
from voxpop.operators import fits
from voxpop.operators.coded import Cells, bitmap, coded, hashes_in, maybe_frequent
from voxpop.session import drop_table, materialize, release_shuffles

# Hyper-parameters of the reference models.
MAX_ITER = 10
REG_PARAMS = [1.0]
POSITIVE_THRESHOLD = 0.2
NEGATIVE_THRESHOLD = 0.25
NUM_FOLDS = 5


def logistic(threshold: float, label_col: str, prefix: str, features_col: str = "features") -> LogisticRegression:
    """M3/M4: predicts 1 iff P(1) > threshold; outputs ``<prefix>``,
    ``<prefix>_probability``, ``<prefix>_raw``."""
    return LogisticRegression(
        featuresCol=features_col,
        labelCol=label_col,
        maxIter=MAX_ITER,
        regParam=REG_PARAMS[0],
        threshold=threshold,
        predictionCol=prefix,
        probabilityCol=f"{prefix}_probability",
        rawPredictionCol=f"{prefix}_raw",
    )


def cross_validator(estimator, label_col: str, raw_col: str, folds: int = NUM_FOLDS, seed: int = 7,
                    parallelism: int = 2, fold_col: str | None = None) -> CrossValidator:
    """M5/M6: grid over regParam, k folds, exact area under ROC. ``fold_col`` names a
    column with the number of each row's fold; without it, folds are drawn by ``seed``.
    The models of the folds are kept, so that their areas can be checked."""
    grid = ParamGridBuilder().addGrid(estimator.regParam, REG_PARAMS).build()
    evaluator = BinaryClassificationEvaluator(rawPredictionCol=raw_col, labelCol=label_col, numBins=0)
    cv = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=grid,
        evaluator=evaluator,
        numFolds=folds,
        seed=seed,
        parallelism=parallelism,
        collectSubModels=True,
    )
    return cv.setFoldCol(fold_col) if fold_col else cv


def fold_of(id_col: str, folds: int, seed: int) -> Column:
    """P16 for folds: the fold of a row by a salted hash of its id, the same on every run."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col(id_col).cast("string")), F.lit(folds)).cast("int")


def split_labelled(labelled: DataFrame, train_fraction: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """Deterministic halves by id hash (same rows on every recomputation)."""
    s = P.hash_split(labelled, "id", train_fraction)
    return s.filter(F.col("split") == "train").drop("split"), s.filter(F.col("split") == "test").drop("split")


SPECS = {"pos": ("positive", POSITIVE_THRESHOLD), "neg": ("negative", NEGATIVE_THRESHOLD)}


@dataclass
class SentimentModel:
    """The vocabulary and the regressions of ``train_sentiment_models`` as a written table
    (gram, idx, weights, fold_weights): the weights of the models ``which``, and those
    of their folds' models, model by model. Only intercepts and figures are on the driver.
    """

    table: DataFrame
    which: tuple[str, ...]
    intercepts: list[float]
    fold_intercepts: list[float]
    folds: int
    cv_metrics: dict[str, list[float]]
    #: Where each regression's loss ended.
    objective: dict[str, float]

    def weights(self, prefix: str, fold: int | None = None) -> tuple[DataFrame, float]:
        """((idx, weight), intercept) of a model, or of the model that left a fold out."""
        at = self.which.index(prefix)
        if fold is None:
            return self.table.select("idx", F.col("weights")[at].alias("weight")), self.intercepts[at]
        at = at * self.folds + fold
        return self.table.select("idx", F.col("fold_weights")[at].alias("weight")), self.fold_intercepts[at]

    @cached_property
    def stages(self) -> list[Model]:
        """The same as Spark ML's stages, for jobs that need these, such as streams: the
        vocabulary and the weights come to the driver whole."""
        from pyspark.ml.common import _py2java
        from pyspark.ml.linalg import Vectors

        sc = SparkSession.getActiveSession().sparkContext
        held = self.table.select("gram", "idx", "weights").orderBy("idx").toArrow()
        grams, weights = held.column("gram").to_pylist(), held.column("weights").to_pylist()
        out: list[Model] = [FE._binary_model(grams, "grams", "features")]
        for i, prefix in enumerate(self.which):
            label, threshold = SPECS[prefix]
            lr = logistic(threshold, label, prefix)
            made = sc._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
                lr.uid, _py2java(sc, Vectors.dense([w[i] for w in weights])), float(self.intercepts[i])
            )
            out.append(lr._copyValues(LogisticRegressionModel(made)))
        return out

    @cached_property
    def units(self) -> float:
        """A power of 2 so large that 2^20 of the largest weight still add up in 64 bits."""
        largest = self.table.select(F.max(F.array_max(F.transform("weights", F.abs)))).first()[0]
        return 2.0 ** (42 - math.ceil(math.log2(largest))) if largest else 1.0

    @cached_property
    def known(self) -> np.ndarray:
        """A bitmap of the grams' hashes, of bounded size."""
        return bitmap(hashes_in(self.table))

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` with a prediction and P(1) a model, by a join with the table of weights.
        The sums are of whole numbers of a unit far below the weights' rounding, so they
        don't depend on how rows are dealt, and are added up before the shuffle by row."""
        # The other columns travel with a row's first gram only.
        others, grams = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_r"), F.array_distinct("grams")
        # Numbered before its grams are rows of their own.
        numbered = df.select(F.monotonically_increasing_id().alias("_row"), others, grams.alias("_g"))
        each = numbered.select("_row", "_r", F.posexplode_outer("_g").alias("_at", "_gram"))
        first = F.coalesce(F.col("_at") == 0, F.lit(True))
        each = each.select("_row", "_gram", first.alias("_first"), F.when(first, F.col("_r")).alias("_r"))
        units = [F.round(F.col("weights")[i] * F.lit(self.units)).cast("long").alias(f"_{prefix}") for i, prefix in enumerate(self.which)]
        known = self.table.select(F.col("gram").alias("_gram"), *units)
        found = each.join(known, "_gram", "left").where(f"_first OR _{self.which[0]} IS NOT NULL")
        sums = [F.coalesce(F.sum(f"_{prefix}"), F.lit(0)).alias(f"_{prefix}") for prefix in self.which]
        rows = found.groupBy("_row").agg(F.first("_r", ignorenulls=True).alias("_r"), *sums)
        margins = [(F.col(f"_{p}") / F.lit(self.units) + F.lit(b)).alias(f"_{p}") for p, b in zip(self.which, self.intercepts)]
        out = rows.select("_r.*", *margins)
        for prefix in self.which:
            out = out.withColumn(f"{prefix}_p1", F.lit(1.0) - F.lit(1.0) / (F.lit(1.0) + F.exp(f"_{prefix}")))
            out = out.withColumn(prefix, (F.col(f"{prefix}_p1") > SPECS[prefix][1]).cast("double")).drop(f"_{prefix}")
        return out

    def score_written(self, df: DataFrame, keep_grams: bool = False) -> DataFrame:
        """What ``score`` gives, as a written table, by a join of the table of weights with
        the distinct grams of each block of rows. The sums are of whole numbers of a unit
        far below the weights' rounding, so they don't depend on how rows are dealt. The
        scored rows are written, as the grams of a block go once they're added up."""
        made = coded(df, "score-grams", keep_grams=keep_grams, among=self.known)
        units = [F.round(F.col("weights")[i] * F.lit(self.units)).cast("long").alias(f"_{prefix}") for i, prefix in enumerate(self.which)]
        names = [f"_{prefix}" for prefix in self.which]
        known = made.grams.select("block", "code", "gram").join(self.table.select("gram", *units), "gram").select("block", "code", *names)

        def added(cells: Cells, found: pd.DataFrame) -> pd.DataFrame:
            codes = found["code"].to_numpy(np.int64)
            sums = {name: cells.sums(cells.lookup(codes, found[name].to_numpy(np.int64), 0)) for name in names}
            return pd.DataFrame({"row": cells.rows, **sums})

        sums = made.each_block(known, added, ", ".join(["row long", *[f"{name} long" for name in names]]))
        rows = made.table.where("other IS NOT NULL").select(F.col("other._row").alias("row"), F.col("other").alias("_r")).join(sums, "row")
        margins = [(F.col(f"_{p}") / F.lit(self.units) + F.lit(b)).alias(f"_{p}") for p, b in zip(self.which, self.intercepts)]
        out = rows.select(*[F.col(f"_r.`{c}`") for c in df.columns if keep_grams or c != "grams"], *margins)
        for prefix in self.which:
            out = out.withColumn(f"{prefix}_p1", F.lit(1.0) - F.lit(1.0) / (F.lit(1.0) + F.exp(f"_{prefix}")))
            out = out.withColumn(prefix, (F.col(f"{prefix}_p1") > SPECS[prefix][1]).cast("double")).drop(f"_{prefix}")
        out = materialize(out, "scored")
        made.drop()
        return out


def train_sentiment_models(labelled_grams: DataFrame, folds: int = NUM_FOLDS, seed: int = 7,
                           train_fraction: float = 0.5, which: tuple[str, ...] = ("pos", "neg"),
                           vocab_size: int | None = None) -> SentimentModel:
    """M1 + M3-M6: fit the vocabulary on all labelled rows, then cross-validate
    each regression on the training half.

    ``labelled_grams`` has ``id``, ``grams``, ``positive``, ``negative``. The grams are
    made twice, to count their hashes and to list those that may be frequent in blocks, and the training half's entries take the numbers of
    the vocabulary, a table. The fits of all models and folds share each pass over the entries
    (``fits.fit_all``). The mean areas under ROC are the result's ``cv_metrics``, one
    a model, as the grid has one point.
    """
    labelled = labelled_grams.select("id", "grams", "positive", "negative")
    halves = P.hash_split(labelled, "id", train_fraction)
    made = coded(halves, "train-grams", kept=F.col("split") == "train", among=maybe_frequent(labelled, FE.MIN_DF))
    vocab = FE.numbered_vocabulary(FE.frequent(made.frequencies(), labelled), "train-vocabulary")
    size = vocab.count()
    if vocab_size is not None and size >= vocab_size:
        raise ValueError(f"the vocabulary reached its bound of {vocab_size} grams; raise vocab_size")
    if not size:
        raise ValueError(f"no gram is in {FE.MIN_DF:g} labelled rows")
    labels = [SPECS[prefix][0] for prefix in which]
    train = made.rows.where("split = 'train'").withColumn("fold", fold_of("id", folds, seed))
    numbered = materialize(FE.number_rows(train.select("block", "row", *labels, "fold"), [F.col("row")], "pos", "train-ranges"), "train-numbers")
    # A block's rows are numbered on end, so its first number places them all.
    firsts = numbered.groupBy("block").agg(F.lit(-1).alias("code"), F.min("pos").alias("idx"))
    known = made.grams.select("block", "code", "gram").join(vocab.select("gram", "idx"), "gram").select("block", "code", "idx").unionByName(firsts)

    def numbers(cells: Cells, found: pd.DataFrame) -> pd.DataFrame:
        code, idx = found["code"].to_numpy(np.int64), found["idx"].to_numpy(np.int32)
        grams = code >= 0
        idx, first = cells.lookup(code[grams], idx[grams], -1), int(idx[~grams][0])
        pos = cells.by_code(np.arange(first, first + len(cells.rows)))
        return pd.DataFrame({"pos": pos[idx >= 0], "idx": idx[idx >= 0]})

    entries = materialize(made.each_block(known, numbers, "pos long, idx int"), "train-entries")
    made.drop()
    release_shuffles(vocab.sparkSession)
    plan = [fits.Fit(label, fold, REG_PARAMS[0]) for label in labels for fold in [None, *range(folds)]]
    fitted = fits.fit_all(numbered.select("pos", *labels, "fold"), entries, plan, MAX_ITER)
    whole = [i for i, f in enumerate(fitted.fits) if f.left_out is None]
    left = [i for i, f in enumerate(fitted.fits) if f.left_out is not None]
    pick = lambda at: F.array(*[F.coalesce(F.col("weights")[i], F.lit(0.0)) for i in at])
    # A feature that no training row has takes no part in any fit.
    table = vocab.select("gram", "idx").join(fitted.weights, "idx", "left").select("gram", "idx", pick(whole).alias("weights"), pick(left).alias("fold_weights"))
    table = materialize(table, "train-weights")
    held = numbered.join(fitted.margins, "pos")
    metrics = {}
    for i, (prefix, label) in enumerate(zip(which, labels)):
        own = F.array(*[F.col("margins")[at] for at in left[i * folds : (i + 1) * folds]])
        areas = fold_areas(held.select("fold", own[F.col("fold")].alias("margin"), F.col(label).alias("label")), folds)
        metrics[prefix] = [sum(areas) / folds]
    for old in (numbered, entries, fitted.margins):
        drop_table(old)
    release_shuffles(table.sparkSession)
    ended = {prefix: (fitted.fits[at].history or [math.nan])[-1] for prefix, at in zip(which, whole)}
    return SentimentModel(table, tuple(which), [fitted.intercepts[i] for i in whole], [fitted.intercepts[i] for i in left], folds, metrics, ended)


def fold_areas(held: DataFrame, folds: int) -> list[float]:
    """Exact area under ROC of each fold's (fold, margin, label)."""
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="margin", labelCol="label", numBins=0)
    rows = held.select("fold", F.col("margin"), F.col("label").cast("double").alias("label"))
    return [evaluator.evaluate(rows.where(F.col("fold") == fold)) for fold in range(folds)]


def training_rows(labelled_grams: DataFrame, model: SentimentModel, folds: int = NUM_FOLDS, seed: int = 7) -> DataFrame:
    """The rows that ``train_sentiment_models`` fits on: id, features, positive,
    negative, fold."""
    train, _ = split_labelled(labelled_grams.select("id", "grams", "positive", "negative"))
    rows = materialize(train.withColumn("row", F.monotonically_increasing_id()), "training-rows")
    entries = FE.doc_gram_pairs(rows, "row").withColumnRenamed("id", "row").join(model.table.select("gram", "idx"), "gram")
    made = FE.sparse_vectors(rows.drop("grams"), entries.select("row", "idx", F.lit(1.0).alias("weight")), model.table.count(), "features", "training-vectors")
    drop_table(rows)
    return made.select("id", "features", "positive", "negative", fold_of("id", folds, seed).alias("fold"))


def loss_gradient(rows: DataFrame, label_col: str, coefficients: DataFrame, intercept: float, reg: float = REG_PARAMS[0]) -> DataFrame:
    """M3/M4: the regularised ``loss`` at given weights and its gradient, one row:
    ``steepest`` (the largest component's size) and ``at_intercept``.

    ``rows`` has binary sparse ``features``, ``coefficients`` is (idx, weight). Spark ML
    regularises the weights of features scaled to standard deviation 1, and so does
    this gradient; a feature that all rows or none have takes no part. All sums run
    over (row, feature) entries, so neither rows nor features have a bound.
    """
    stored = F.unwrap_udt("features")
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), F.col(label_col).cast("double").alias("y"), stored["indices"].alias("idx"))
    numbered = materialize(numbered, "gradient-rows")
    n = numbered.select(F.count(F.lit(1)).cast("double")).scalar()
    entries = numbered.select("row", F.explode("idx").alias("idx"))
    sums = entries.join(coefficients, "idx").groupBy("row").agg(F.sum("weight").alias("sum"))
    margin = F.coalesce("sum", F.lit(0.0)) + F.lit(intercept)
    error = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin)) - F.col("y")
    # log(1 + exp(margin)) - y margin, without overflow
    loss = F.greatest(margin, F.lit(0.0)) + F.log1p(F.exp(-F.abs(margin))) - F.col("y") * margin
    errors = materialize(numbered.join(sums, "row", "left").select("row", error.alias("error"), loss.alias("loss")), "gradient-errors")
    each = entries.join(errors, "row").groupBy("idx").agg(F.sum("error").alias("error"), F.count(F.lit(1)).cast("double").alias("held"))
    spread = F.sqrt(F.col("held") * (n - F.col("held")) / (n * (n - 1)))
    each = each.join(coefficients, "idx").withColumn("spread", spread).where("spread > 0")
    slope = F.col("error") / (n * F.col("spread")) + F.lit(reg) * F.col("weight") * F.col("spread")
    penalty = F.lit(reg / 2) * F.sum(F.pow(F.col("weight") * F.col("spread"), 2))
    by_feature = each.agg(F.max(F.abs(slope)).alias("steepest"), F.coalesce(penalty, F.lit(0.0)).alias("penalty"))
    by_row = errors.agg(F.abs(F.avg("error")).alias("at_intercept"), F.avg("loss").alias("mean"))
    return by_feature.crossJoin(by_row).select((F.col("mean") + F.col("penalty")).alias("loss"), "steepest", "at_intercept")  # one row each


def coefficient_table(spark: SparkSession, model) -> DataFrame:
    """(idx, weight) of a fitted model of Spark ML, whose weights are on the driver."""
    return spark.createDataFrame([(i, float(w)) for i, w in enumerate(model.coefficients.toArray())], "idx int, weight double")


def score(model: SentimentModel | PipelineModel, df: DataFrame, keep_probability: bool = True) -> DataFrame:
    """M2 + M7: vectorise once, apply every regression; drops vectors, keeps
    ``pos``/``neg`` predictions and P(1) as plain doubles. A table is scored by a join; a
    stream, which has but one stateful step, by Spark ML's stages."""
    if isinstance(model, SentimentModel):
        if not df.isStreaming:
            out = model.score(df)
            return out if keep_probability else out.drop("pos_p1", "neg_p1")
        model = PipelineModel(stages=model.stages)
    out = model.transform(df)
    drop = ["features"]
    for prefix in ("pos", "neg"):
        if f"{prefix}_probability" in out.columns:
            if keep_probability:
                out = out.withColumn(f"{prefix}_p1", vector_to_array(f"{prefix}_probability")[1])
            drop += [f"{prefix}_probability", f"{prefix}_raw"]
    return out.drop(*drop)


#: Folder beside a saved pipeline's stages that holds its cross-validated areas.
METRICS = "cvMetrics"
#: The class that a saved ``SentimentModel`` names.
TABLES = "voxpop.operators.models.SentimentModel"


def save_models(model: SentimentModel | PipelineModel | CrossValidatorModel, path: str) -> None:
    """Write a fitted model's table with its figures, or a pipeline, or a whole
    cross-validator with its estimator, evaluator and average metrics (overwrite). The
    average metrics of a pipeline go into a folder of their own beside its stages."""
    spark = SparkSession.getActiveSession()
    path = path.rstrip("/")
    if isinstance(model, SentimentModel):
        # Written beside and then put in its place, as its own table may be there.
        beside = f"{path}-{uuid.uuid4().hex}"
        model.table.write.parquet(f"{beside}/stages/weights")
        kept = ("which", "intercepts", "fold_intercepts", "folds", "cv_metrics", "objective")
        meta = json.dumps({"class": TABLES, **{k: getattr(model, k) for k in kept}})
        spark.createDataFrame([(meta,)], "value string").coalesce(1).write.text(f"{beside}/metadata")
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        store = at.getFileSystem(spark._jsc.hadoopConfiguration())
        store.delete(at, True)
        if not store.rename(spark._jvm.org.apache.hadoop.fs.Path(beside), at):
            raise OSError(f"{beside} could not be put at {path}")
        return
    model.write().overwrite().save(path)
    metrics = [(prefix, float(m)) for prefix, listed in getattr(model, "cv_metrics", {}).items() for m in listed]
    if metrics:
        spark.createDataFrame(metrics, "model string, area double").coalesce(1).write.mode("overwrite").json(f"{path}/{METRICS}")


def load_models(path: str) -> SentimentModel | Model:
    """Load a model folder by the class that its metadata names: a fitted model's
    table, a pipeline, or the best model of a cross-validator. ``cv_metrics`` holds the
    average metrics saved with it, by model (a cross-validator has one, named after its
    prediction column)."""
    spark = SparkSession.getActiveSession()
    meta = json.loads(spark.read.text(f"{path.rstrip('/')}/metadata").first()["value"])
    kind = meta.pop("class")
    if kind == TABLES:
        meta["which"] = tuple(meta["which"])
        return SentimentModel(spark.read.parquet(f"{path.rstrip('/')}/stages/weights"), **meta)
    kind, named = kind.rsplit(".", 1)[1], kind
    if kind == "CrossValidatorModel":
        found = CrossValidatorModel.load(path)
        best = found.bestModel
        best.cv_metrics = {best.getPredictionCol() if hasattr(best, "getPredictionCol") else "model": list(found.avgMetrics)}
        return best
    if kind != "PipelineModel":
        raise ValueError(f"{path} holds a {named}, not a pipeline or a cross-validator")
    model = PipelineModel.load(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{METRICS}")
    model.cv_metrics = {}
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        for r in spark.read.schema("model string, area double").json(folder.toString()).collect():  # a row a grid point
            model.cv_metrics.setdefault(r["model"], []).append(r["area"])
    return model


def linear_svc(label_col: str, prefix: str, features_col: str = "features") -> LinearSVC:
    """Linear SVM; ``<prefix>_raw`` holds the margins (``calibrated_svc`` adds
    probabilities)."""
    return LinearSVC(
        featuresCol=features_col,
        labelCol=label_col,
        maxIter=MAX_ITER,
        regParam=REG_PARAMS[0],
        predictionCol=prefix,
        rawPredictionCol=f"{prefix}_raw",
    )


@dataclass(frozen=True)
class Sigmoid:
    """Platt scaling: P(1) = 1 / (1 + exp(slope * margin + shift))."""

    slope: float
    shift: float

    def probability(self, margin: Column) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(self.slope) * margin + F.lit(self.shift)))


def held_out_margins(rows: DataFrame, estimator: LinearSVC, label_col: str, folds: int = NUM_FOLDS) -> DataFrame:
    """(margin, y, fold) of ``rows``, each scored by a model fitted on the other folds
    (column ``fold``)."""
    out = None
    for fold in range(folds):
        model = estimator.fit(rows.where(F.col("fold") != fold))
        scored = model.transform(rows.where(F.col("fold") == fold))
        part = scored.select(vector_to_array(estimator.getRawPredictionCol())[1].alias("margin"), F.col(label_col).cast("double").alias("y"), "fold")
        out = part if out is None else out.unionByName(part)
    return out


def platt_scaling(margins: DataFrame, steps: int = 50) -> Sigmoid:
    """The sigmoid that maximises the likelihood of the labels at given margins
    (margin, y), by damped Newton steps.

    As Platt has it, the labels are softened to (N1 + 1) / (N1 + 2) and 1 / (N0 + 2).
    Each step is one aggregate of six sums over the margins; two numbers change.
    """
    counts = margins.agg(F.sum("y").alias("ones"), F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("y") == 1, 1)).alias("k")).first()
    ones, zeros = counts["k"], counts["n"] - counts["k"]
    target = F.when(F.col("y") == 1, (ones + 1.0) / (ones + 2.0)).otherwise(1.0 / (zeros + 2.0))
    known = margins.select("margin", target.alias("t"))

    def sums(a: float, b: float):
        z = F.lit(a) * F.col("margin") + F.lit(b)
        # log(1 + exp(z)), without overflow
        soft = F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z)))
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(z))
        gap, weight = F.col("t") - p, p * (F.lit(1.0) - p)
        m = F.col("margin")
        return known.agg(
            F.sum(soft - (F.lit(1.0) - F.col("t")) * z).alias("loss"), F.sum(gap * m).alias("ga"), F.sum(gap).alias("gb"),
            F.sum(weight * m * m).alias("aa"), F.sum(weight * m).alias("ab"), F.sum(weight).alias("bb"),
        ).first()

    a, b = 0.0, math.log((zeros + 1.0) / (ones + 1.0))
    now = sums(a, b)
    for _ in range(steps):
        if max(abs(now["ga"]), abs(now["gb"])) <= 1e-9 * counts["n"]:
            break
        aa, bb = now["aa"] + 1e-12, now["bb"] + 1e-12
        det = aa * bb - now["ab"] ** 2
        da, db = -(bb * now["ga"] - now["ab"] * now["gb"]) / det, -(aa * now["gb"] - now["ab"] * now["ga"]) / det
        slope, size = now["ga"] * da + now["gb"] * db, 1.0
        while size >= 1e-10:
            new = sums(a + size * da, b + size * db)
            # So near the optimum, a whole step is right and the loss is rounding.
            if -slope <= 1e-6 * counts["n"] or new["loss"] <= now["loss"] + 1e-4 * size * slope:
                break
            size /= 2
        else:
            break
        a, b, now = a + size * da, b + size * db, new
    return Sigmoid(a, b)


def calibrated_svc(rows: DataFrame, label_col: str, prefix: str, folds: int = NUM_FOLDS) -> tuple[LinearSVCModel, Sigmoid]:
    """M14 with probabilities: the margin classifier fitted on all of ``rows`` (features,
    label, fold), and the sigmoid fitted on margins of held-out folds."""
    estimator = linear_svc(label_col, prefix)
    margins = materialize(held_out_margins(rows, estimator, label_col, folds), "svc-margins")
    return estimator.fit(rows), platt_scaling(margins)


def with_probability(scored: DataFrame, prefix: str, sigmoid: Sigmoid) -> DataFrame:
    """``<prefix>_margin`` and ``<prefix>_p1`` beside the margin classifier's output."""
    margin = vector_to_array(f"{prefix}_raw")[1]
    return scored.withColumn(f"{prefix}_margin", margin).withColumn(f"{prefix}_p1", sigmoid.probability(F.col(f"{prefix}_margin")))
