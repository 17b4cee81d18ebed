"""Feature, model and evaluation queries.

Vocabulary, binary features, TF-IDF and the rank statistics have SQL twins.
The output of fitted models depends on the optimiser's iterations, which SQL cannot
restate; ``*_invariants`` queries hold what must be true of it against counts.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxpop.operators import aggregates as G
from voxpop.operators import evaluate as E
from voxpop.operators import factorize as FA
from voxpop.operators import features as FE
from voxpop.operators import filters as P
from voxpop.operators import models as M
from voxpop.plans import score, train
from voxpop.plans.registry import ORACLE, SQL_LABELLED, labelled_targets, register
from voxpop.plans.relational_queries import SQL_COMMENTS_RAW, SQL_IN_SAMPLE, SQL_LABEL_JOIN, SQL_SPLIT
from voxpop.plans.text_queries import SQL_BI, SQL_TRI, SQL_UNI, sql_words
from voxpop.session import materialize

SQL_LABELLED_GRAMS = f"""
    SELECT id, list_concat(list_concat({SQL_UNI}, {SQL_BI}), {SQL_TRI}) AS g
    FROM ({sql_words(SQL_LABEL_JOIN)}) t"""
SQL_PAIRS = f"SELECT id, unnest(list_distinct(g)) AS gram FROM ({SQL_LABELLED_GRAMS}) lg"
SQL_VOCAB = f"""
    SELECT gram, count(*) AS doc_freq FROM ({SQL_PAIRS}) p
    GROUP BY gram HAVING count(*) >= {FE.MIN_DF}"""


@register("vocabulary_min_df", SQL_VOCAB)
def vocabulary_min_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FE.vocabulary(train.labelled_grams(spark, sf_dir), min_df=FE.MIN_DF)


@register(
    "binary_features",
    f"SELECT p.id, p.gram FROM ({SQL_PAIRS}) p WHERE p.gram IN (SELECT gram FROM ({SQL_VOCAB}) v)",
)
def binary_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FE.binary_pairs(train.labelled_grams(spark, sf_dir), min_df=FE.MIN_DF)


@register(
    "tfidf_features",
    f"""
    WITH g AS (SELECT r, id, unnest(g) AS gram
               FROM (SELECT row_number() OVER () AS r, id, g FROM ({SQL_LABELLED_GRAMS}) lg) n),
         tf AS (SELECT r, id, gram, count(*) AS tf FROM g GROUP BY r, id, gram),
         n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM ({SQL_LABEL_JOIN}) j),
         dfq AS (SELECT gram, count(*) AS doc_freq FROM tf GROUP BY gram),
         idf AS (SELECT gram, ln((CAST(1 AS DOUBLE) + n) / (CAST(1 AS DOUBLE) + doc_freq)) + CAST(1 AS DOUBLE) AS idf
                 FROM dfq, n
                 WHERE doc_freq >= {FE.MIN_DF} AND doc_freq <= CAST({FE.TFIDF_MAX_DF} AS DOUBLE) * n),
         w AS (SELECT tf.r, tf.id, tf.gram, tf.tf * idf.idf AS w FROM tf JOIN idf ON tf.gram = idf.gram)
    SELECT id, gram, round(w / sqrt(sum(w * w) OVER (PARTITION BY r)), 6) AS weight FROM w""",
)
def tfidf_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = FE.tfidf_weights(train.labelled_grams(spark, sf_dir))
    return w.select("id", "gram", F.round("weight", 6).alias("weight"))


# ---------------------------------------------------------------------------
# Rank statistics on a fixed score: n_chars as the score of quality (= dem).
# ---------------------------------------------------------------------------
SQL_SCORE_COUNTS = f"""
    SELECT CAST(n_chars AS DOUBLE) AS score,
           sum(CASE WHEN dem = 1 THEN 1 ELSE 0 END) AS pos,
           sum(CASE WHEN dem = 1 THEN 0 ELSE 1 END) AS neg
    FROM ({SQL_LABELLED}) t GROUP BY 1"""
SQL_CUM = f"""
    SELECT score, pos, neg,
           sum(pos) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pos_cum,
           sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS neg_cum
    FROM ({SQL_SCORE_COUNTS}) a"""
CONFUSION_MIN_CHARS = 1000  # fixed-score classifier: predict 1 when n_chars >= 1000


def _fixed_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = labelled_targets(spark, sf_dir)
    return t.select(
        "id",
        F.col("n_chars").cast("double").alias("score"),
        F.col("dem").alias("label"),
        (F.col("n_chars") >= CONFUSION_MIN_CHARS).cast("int").alias("prediction"),
    )


@register(
    "auc_rank",
    f"""
    SELECT sum(pos * ((neg_cum - neg) + 0.5 * neg)) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc
    FROM ({SQL_CUM}) c""",
)
def auc_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.auc_rank(_fixed_scores(spark, sf_dir), "score", "label")


@register(
    "auc_trapezoid",
    f"""
    SELECT sum(neg * ((P - pos_cum) + 0.5 * pos)) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc
    FROM ({SQL_CUM}) c, (SELECT sum(pos) AS P FROM ({SQL_SCORE_COUNTS}) a) t""",
)
def auc_trapezoid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.auc_trapezoid(_fixed_scores(spark, sf_dir), "score", "label")


@register(
    "roc_points",
    f"""
    SELECT score AS threshold,
           CAST(N - (neg_cum - neg) AS DOUBLE) / N AS fpr,
           CAST(P - (pos_cum - pos) AS DOUBLE) / P AS tpr
    FROM ({SQL_CUM}) c,
         (SELECT CAST(sum(pos) AS DOUBLE) AS P, CAST(sum(neg) AS DOUBLE) AS N FROM ({SQL_SCORE_COUNTS}) a) t""",
)
def roc_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.roc_points(_fixed_scores(spark, sf_dir), "score", "label")


@register(
    "roc_curve",
    f"""
    WITH c AS (SELECT *, lag(pos) OVER o AS pos_next, lag(neg) OVER o AS neg_next, max(score) OVER () AS top
               FROM ({SQL_CUM}) x WINDOW o AS (ORDER BY score))
    SELECT CAST('inf' AS DOUBLE) AS threshold, CAST(0 AS DOUBLE) AS fpr, CAST(0 AS DOUBLE) AS tpr
    UNION ALL
    SELECT score, CAST(N - (neg_cum - neg) AS DOUBLE) / N, CAST(P - (pos_cum - pos) AS DOUBLE) / P
    FROM c, (SELECT CAST(sum(pos) AS DOUBLE) AS P, CAST(sum(neg) AS DOUBLE) AS N FROM ({SQL_SCORE_COUNTS}) a) t
    WHERE pos_next IS NULL OR pos_next <> pos OR neg_next <> neg OR score = top""",
)
def roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.roc_curve(_fixed_scores(spark, sf_dir), "score", "label")


@register("model_roc_curve")
def model_roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9: the curve of the positive model on the held-out half, ready to plot."""
    return E.roc_curve(train.held_out_predictions(spark, sf_dir), "pos_p1", "positive")


@register(
    "confusion_counts",
    f"""
    SELECT CAST(dem AS INTEGER) AS label, CAST(n_chars >= {CONFUSION_MIN_CHARS} AS INTEGER) AS prediction,
           count(*) AS count
    FROM ({SQL_LABELLED}) t GROUP BY 1, 2""",
)
def confusion_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.confusion_counts(_fixed_scores(spark, sf_dir), "label", "prediction")


@register(
    "binary_metrics",
    f"""
    SELECT CAST(sum(CASE WHEN y = p THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS accuracy,
           CAST(sum(CASE WHEN y = 1 AND p = 1 THEN 1 ELSE 0 END) AS DOUBLE)
             / NULLIF(sum(CASE WHEN p = 1 THEN 1 ELSE 0 END), 0) AS precision,
           CAST(sum(CASE WHEN y = 1 AND p = 1 THEN 1 ELSE 0 END) AS DOUBLE)
             / NULLIF(sum(CASE WHEN y = 1 THEN 1 ELSE 0 END), 0) AS recall
    FROM (SELECT dem AS y, CAST(n_chars >= {CONFUSION_MIN_CHARS} AS INTEGER) AS p FROM ({SQL_LABELLED}) t) x""",
)
def binary_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.binary_metrics(_fixed_scores(spark, sf_dir), "label", "prediction")


# ---------------------------------------------------------------------------
# Model fits and scoring (rows-only checks)
# ---------------------------------------------------------------------------
@register("train_positive")
def train_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 + M3 + M5/M6: held-out half scored by the positive model."""
    p = train.held_out_predictions(spark, sf_dir)
    return p.select("id", F.col("positive").alias("label"), F.col("pos").alias("prediction"),
                    F.col("pos_p1").alias("probability"))


@register("train_negative")
def train_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 + M4 + M5/M6: held-out half scored by the negative model."""
    p = train.held_out_predictions(spark, sf_dir)
    return p.select("id", F.col("negative").alias("label"), F.col("neg").alias("prediction"),
                    F.col("neg_p1").alias("probability"))


@register("positive_rows_listing")
def positive_rows_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out rows with a non-zero positive label."""
    return train.positive_label_listing(train.held_out_predictions(spark, sf_dir))


@register(
    "label_distribution_train",
    f"SELECT {SQL_SPLIT} AS split, positive AS label, count(*) AS count FROM ({SQL_LABELLED}) t GROUP BY 1, 2",
)
def label_distribution_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 on the model's own training half (feature rows)."""
    tr, te = M.split_labelled(train.labelled_grams(spark, sf_dir))
    a = G.label_distribution(tr.withColumn("split", F.lit("train")).withColumnRenamed("positive", "label"),
                             by=["split"])
    b = G.label_distribution(te.withColumn("split", F.lit("test")).withColumnRenamed("positive", "label"),
                             by=["split"])
    return a.unionByName(b)


@register("model_auc")
def model_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8: area under ROC of both models on the held-out half (rank statistic)."""
    p = train.held_out_predictions(spark, sf_dir)
    pos = E.auc_rank(p, "pos_p1", "positive").select(F.lit("pos").alias("model"), "auc")
    neg = E.auc_rank(p, "neg_p1", "negative").select(F.lit("neg").alias("model"), "auc")
    return pos.unionByName(neg)


@register("model_roc_points")
def model_roc_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9: ROC points of the positive model on the held-out half."""
    return E.roc_points(train.held_out_predictions(spark, sf_dir), "pos_p1", "positive")


@register("score_both")
def score_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2 + M7: every kept comment scored by both models in one pass."""
    return score.scored_comments(spark, sf_dir).select("comment_id", "id", "title", "ts", "pos", "neg")


@register("pos_neg_join")
def pos_neg_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 keyed on the comment id (1:1). The submission-id key would pair every
    comment of a thread with every other one; that fan-out is not rebuilt. One pass
    of scoring has both predictions in a row, so the join is a projection."""
    cols = ["comment_id", "id", "title", "ts", "author_flair_text", "c_score", "s_score", "pos", "neg"]
    return score.scored_comments(spark, sf_dir).select(*cols)


def _scored_report(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from voxpop.plans.report import sentiment_reports

    return sentiment_reports(score.scored_comments(spark, sf_dir))[name]


@register("scored_top_titles_pos")
def scored_top_titles_pos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score.top_titles_scored(spark, sf_dir, "pos")


@register("scored_top_titles_neg")
def scored_top_titles_neg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score.top_titles_scored(spark, sf_dir, "neg")


@register("scored_sentiment_by_day")
def scored_sentiment_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored_report(spark, sf_dir, "daily")


@register("scored_sentiment_by_state")
def scored_sentiment_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored_report(spark, sf_dir, "by_region")


@register("scored_sentiment_by_story_score")
def scored_sentiment_by_story_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored_report(spark, sf_dir, "by_submission_score")


@register("scored_sentiment_by_comment_score")
def scored_sentiment_by_comment_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored_report(spark, sf_dir, "by_comment_score")


@register("scored_sentiment_overall")
def scored_sentiment_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored_report(spark, sf_dir, "overall")


@register("scored_sample_top_titles")
def scored_sample_top_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P15 in the scoring path: 20 % deterministic sample, then the title ranking."""
    scored = score.scored_comments(spark, sf_dir, sample_fraction=0.2)
    return score.top_titles(scored, "pos")


@register("model_persistence_roundtrip")
def model_persistence_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Save vocabulary + models, load them back, score the held-out half."""
    import uuid

    from voxpop.session import ensure_checkpoint_dir

    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/models-{uuid.uuid4().hex}"
    M.save_models(train.fitted_models(spark, sf_dir), path)
    return train.held_out_predictions(spark, sf_dir, model=M.load_models(path))


@register(
    "tfidf_vectors_nnz",
    f"""
    SELECT j.id, CAST(count(w.gram) AS INTEGER) AS nnz,
           CASE WHEN count(w.gram) > 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS norm
    FROM ({SQL_LABEL_JOIN}) j LEFT JOIN ({ORACLE['tfidf_features']}) w ON w.id = j.id GROUP BY j.id""",
)
def tfidf_vectors_nnz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M11 in ML form: non-zeros and L2 norm per labelled document, from the stored
    values of the sparse vectors."""
    _, out = FE.tfidf_vectors(train.labelled_grams(spark, sf_dir))
    stored = F.filter(F.unwrap_udt("tfidf")["values"], lambda x: x != 0)
    out = out.select("id", stored.alias("v"))
    squares = F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x)
    return out.select("id", F.size("v").alias("nnz"), F.round(F.sqrt(squares), 9).alias("norm"))


@register(
    "binary_vectors_nnz",
    f"""
    SELECT j.id, CAST(count(b.gram) AS INTEGER) AS nnz FROM ({SQL_LABEL_JOIN}) j
    LEFT JOIN ({ORACLE['binary_features']}) b ON b.id = j.id GROUP BY j.id""",
)
def binary_vectors_nnz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 with a vocabulary of any size: non-zeros per labelled document."""
    _, out = FE.binary_vectors(train.labelled_grams(spark, sf_dir))
    return out.select("id", F.size(F.unwrap_udt("features")["indices"]).alias("nnz"))


@register(
    "vocabulary_numbers",
    f"SELECT gram, doc_freq, CAST(row_number() OVER (ORDER BY doc_freq DESC, gram) - 1 AS INTEGER) AS idx FROM ({SQL_VOCAB}) v",
)
def vocabulary_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gap-free gram numbers from a distributed table."""
    return FE.numbered_vocabulary(FE.vocabulary(train.labelled_grams(spark, sf_dir), min_df=FE.MIN_DF))


def svc_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Training and test half with sparse binary features and folds."""
    _, feats = FE.binary_vectors(train.labelled_grams(spark, sf_dir))
    fit_half, test = M.split_labelled(feats.drop("grams").withColumn("fold", M.fold_of("id", M.NUM_FOLDS, 7)))
    return fit_half, test


@register("linear_svc_scores")
def linear_svc_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linear SVM on the binary features; margins of the test half and their
    probabilities by a sigmoid fitted on held-out folds."""
    fit_half, test = svc_rows(spark, sf_dir)
    model, sigmoid = M.calibrated_svc(fit_half, "positive", "svc")
    out = M.with_probability(model.transform(test), "svc", sigmoid)
    return out.select("id", F.col("positive").alias("label"), "svc", F.col("svc_margin").alias("margin"), F.col("svc_p1").alias("probability"))


LSI_RANK = 10
# A little shrinkage, as the default of the reference's library has: 1 / rows at C = 1
# would follow the table's size, so a fixed small value stands for it.
LSI_REG = 0.001


_FACTORS: dict[tuple, tuple[DataFrame, DataFrame, FA.Factors]] = {}


def lsi_fit(spark: SparkSession, sf_dir: str, k: int = LSI_RANK) -> tuple[DataFrame, DataFrame, FA.Factors]:
    """All labelled rows (row, id, split, positive), their TF-IDF entries, and the rank-k
    factors of the training half's matrix: written tables, which the queries of a session
    share as long as the labelled tables' files are the same. Vocabulary and idf are of
    the training half."""
    version = tuple(train.table_version(spark, train.DT.path(sf_dir, name)) for name in ("labels", "documents"))
    key = (spark.sparkContext.applicationId, k, *version)
    if key not in _FACTORS:
        _FACTORS.clear()  # only the last one is kept
        _FACTORS[key] = _lsi_fit(spark, sf_dir, k)
    return _FACTORS[key]


def _lsi_fit(spark: SparkSession, sf_dir: str, k: int) -> tuple[DataFrame, DataFrame, FA.Factors]:
    grams = P.hash_split(train.labelled_grams(spark, sf_dir), "id", 0.5)
    rows = materialize(grams.withColumn("row", F.monotonically_increasing_id()), "lsi-rows")
    space = FE.fit_tfidf(rows.where("split = 'train'"))
    entries = materialize(space.entries(rows), "lsi-entries")
    fitted_on = entries.join(rows.where("split = 'train'").select("row"), "row")
    return rows.drop("grams"), entries, FA.truncated_svd(fitted_on, space.vocab.select("idx"), k)


def lsi_coordinates(rows: DataFrame, entries: DataFrame, factors: FA.Factors) -> DataFrame:
    """``rows`` with their coordinates as the vector ``lsi``; rows without any known
    gram are at the origin."""
    from pyspark.ml.functions import array_to_vector

    placed = rows.join(factors.project(entries), "row", "left")
    origin = F.array_repeat(F.lit(0.0), len(factors.values))
    return placed.withColumn("at", F.coalesce("at", origin)).withColumn("lsi", array_to_vector("at"))


@register("lsi_projection")
def lsi_projection(spark: SparkSession, sf_dir: str, k: int = LSI_RANK) -> DataFrame:
    """Rank-k LSI (truncated SVD) of the training half's TF-IDF matrix, then a
    logistic regression on the coordinates (M12); the test half is predicted."""
    vectors = materialize(lsi_coordinates(*lsi_fit(spark, sf_dir, k)).drop("lsi"), "lsi-vectors")
    scored = lsi_predictions(vectors)
    return scored.select("id", F.col("positive").alias("label"), "prediction", vector_to_array("p")[1].alias("probability"))


def lsi_regression(vectors: DataFrame):
    """M12 on the training half's coordinates (array ``at``), to convergence."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    lr = LogisticRegression(featuresCol="lsi", labelCol="positive", maxIter=200, tol=1e-12, regParam=LSI_REG, standardization=False,
                            probabilityCol="p", rawPredictionCol="raw", predictionCol="prediction")
    return lr.fit(vectors.where("split = 'train'").withColumn("lsi", array_to_vector("at")))


def lsi_predictions(vectors: DataFrame) -> DataFrame:
    from pyspark.ml.functions import array_to_vector

    return lsi_regression(vectors).transform(vectors.where("split = 'test'").withColumn("lsi", array_to_vector("at")))


# ---------------------------------------------------------------------------
# Invariants of fitted models
# ---------------------------------------------------------------------------
SQL_TEST_HALF = f"SELECT * FROM (SELECT *, {SQL_SPLIT} AS split FROM ({SQL_LABELLED}) t) s WHERE split = 'test' AND body IS NOT NULL"


def _violations(df: DataFrame) -> DataFrame:
    """Rows, missing predictions, and predictions that aren't probability > threshold."""
    wrong = lambda prefix, threshold: (F.col(prefix) == 1.0) != (F.col(f"{prefix}_p1") > threshold)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("pos").isNull() | F.col("neg").isNull() | F.col("pos_p1").isNull() | F.col("neg_p1").isNull()).alias("n_missing"),
        F.count_if(wrong("pos", M.POSITIVE_THRESHOLD) | wrong("neg", M.NEGATIVE_THRESHOLD)).alias("n_wrong"),
    )


_NO_VIOLATION = "CAST(0 AS BIGINT) AS n_missing, CAST(0 AS BIGINT) AS n_wrong"


@register("train_invariants", f"SELECT count(*) AS n_rows, {_NO_VIOLATION} FROM ({SQL_TEST_HALF}) h")
def train_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1-M7 on the held-out half."""
    return _violations(train.held_out_predictions(spark, sf_dir))


@register("positive_rows_ids", f"SELECT id, positive FROM ({SQL_TEST_HALF}) h WHERE positive <> 0")
def positive_rows_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The held-out rows with a non-zero label, whatever is predicted for them."""
    return train.positive_label_listing(train.held_out_predictions(spark, sf_dir)).select("id", "positive")


SQL_KEPT_COMMENTS = f"""
    SELECT c.id FROM ({SQL_COMMENTS_RAW}) c
    WHERE c.body IS NOT NULL AND NOT starts_with(replace(trim(c.body, ' ' || chr(9) || chr(10) || chr(13)), '/s', ''), '&gt')
      AND EXISTS (SELECT 1 FROM conversations s WHERE s.turn = 0 AND 't3_' || CAST(s.conv_id AS VARCHAR) = c.link_id)"""


@register("score_invariants", f"SELECT count(*) AS n_rows, {_NO_VIOLATION} FROM ({SQL_KEPT_COMMENTS}) k")
def score_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2 + M7 + P8: every kept comment of a known thread has both predictions."""
    return _violations(score.scored_comments(spark, sf_dir))


@register("sample_score_invariants", f"SELECT count(*) AS n_rows, {_NO_VIOLATION} FROM ({SQL_KEPT_COMMENTS} AND {SQL_IN_SAMPLE.replace('CAST(id', 'CAST(c.id')}) k")
def sample_score_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P15 in the scoring path."""
    return _violations(score.scored_comments(spark, sf_dir, sample_fraction=0.2))


@register(
    "persistence_invariants",
    f"SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_different FROM ({SQL_TEST_HALF}) h",
)
def persistence_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded models predict what the saved ones do."""
    cols = ["id", "pos", "neg", "pos_p1", "neg_p1"]
    before = train.held_out_predictions(spark, sf_dir).select(cols)
    after = model_persistence_roundtrip(spark, sf_dir).select(cols)
    different = before.exceptAll(after).agg(F.count(F.lit(1))).scalar()
    return after.agg(F.count(F.lit(1)).alias("n_rows"), F.max(different).alias("n_different"))


@register("auc_invariants", "SELECT unnest(['neg', 'pos']) AS model, true AS same, true AS within")
def auc_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8: the rank statistic equals Spark ML's evaluator and lies in [0, 1]."""
    from pyspark.ml.functions import array_to_vector

    held = train.held_out_predictions(spark, sf_dir)
    parts = []
    for prefix, label in (("neg", "negative"), ("pos", "positive")):
        raw = held.select(F.col(label).cast("double").alias("label"), array_to_vector(F.array(1 - F.col(f"{prefix}_p1"), F.col(f"{prefix}_p1"))).alias("rawPrediction"))
        area = E.evaluator_auc(raw)
        auc = E.auc_rank(held, f"{prefix}_p1", label)
        parts.append(auc.select(F.lit(prefix).alias("model"), (F.abs(F.col("auc") - area) < 1e-9).alias("same"), F.col("auc").between(0, 1).alias("within")))
    return parts[0].unionByName(parts[1])


@register("loss_certificate", "SELECT unnest(['neg', 'pos']) AS model, true AS same, true AS lower, true AS flatter")
def loss_certificate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3/M4: the regularised loss at the fitted weights, summed anew over (row, gram)
    entries, is what the fit ended at, and both it and its slope are below those of the
    model without weights. The fits stop after ``MAX_ITER`` steps, short of the optimum,
    so a disturbed weight changes the loss in the first order."""
    return certified(spark, train.fitted_models(spark, sf_dir), train.labelled_grams(spark, sf_dir))


def certified(spark: SparkSession, model, grams: DataFrame, disturbed: float = 0.0) -> DataFrame:
    """(model, same, lower, flatter) of both regressions on their training rows;
    ``disturbed`` is added to the largest weight (tests)."""
    rows = M.training_rows(grams, model).drop("id")
    parts = []
    for prefix, label in (("neg", "negative"), ("pos", "positive")):
        weights, intercept = model.weights(prefix)
        if disturbed:
            largest = weights.orderBy(F.desc(F.abs("weight")), "idx").first()["idx"]
            weights = weights.withColumn("weight", F.col("weight") + F.when(F.col("idx") == largest, disturbed).otherwise(0.0))
        here = M.loss_gradient(rows, label, weights, intercept)
        none = M.loss_gradient(rows, label, weights.withColumn("weight", F.lit(0.0)), 0.0).select(F.col("loss").alias("loss0"), F.col("steepest").alias("steepest0"))
        parts.append(here.crossJoin(none).select(  # one row each
            F.lit(prefix).alias("model"), (F.abs(F.col("loss") - model.objective[prefix]) < 1e-9).alias("same"),
            (F.col("loss") < F.col("loss0")).alias("lower"), (F.col("steepest") < F.col("steepest0")).alias("flatter"),
        ))
    return parts[0].unionByName(parts[1])


@register("fold_certificate", f"SELECT unnest(['neg', 'pos']) AS model, CAST({M.NUM_FOLDS} AS BIGINT) AS n_folds, true AS same")
def fold_certificate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5/M6: the cross-validated area is the mean over the folds of the rank statistic,
    worked out anew for each fold's rows with the model that has not seen them."""
    model = train.fitted_models(spark, sf_dir)
    rows = M.training_rows(train.labelled_grams(spark, sf_dir), model)
    held = materialize(rows.select("fold", "positive", "negative", F.monotonically_increasing_id().alias("row"), F.unwrap_udt("features")["indices"].alias("idx")), "fold-rows")
    # Each row's margins by the models that have not seen it, summed in its features' order.
    table = model.table.select("idx", "fold_weights")
    found = held.select("row", "fold", F.explode("idx").alias("idx")).join(table, "idx")
    own = [F.col("fold_weights")[F.col("fold") + i * model.folds].alias(prefix) for i, prefix in enumerate(model.which)]
    sums = found.select("row", F.struct("idx", *own).alias("w")).groupBy("row").agg(F.sort_array(F.collect_list("w")).alias("w"))
    held = materialize(held.drop("idx").join(sums, "row", "left"), "fold-sums")
    parts = []
    for prefix, label in (("neg", "negative"), ("pos", "positive")):
        areas = None
        first = model.which.index(prefix) * model.folds
        intercept = F.array(*[F.lit(b) for b in model.fold_intercepts[first : first + model.folds]])[F.col("fold")]
        margin = F.coalesce(F.aggregate("w", F.lit(0.0), lambda total, w: total + w[prefix]), F.lit(0.0)) + intercept  # noqa: B023
        for fold in range(model.folds):
            raw = held.where(F.col("fold") == fold).select(margin.alias("margin"), F.col(label).alias("label"))
            # Of a fold with one class only, Spark ML's curve has area 1 (no 0) or 0 (no 1).
            one_class = raw.agg(F.when(F.min("label") == 1, 1.0).otherwise(0.0).alias("a")).scalar()
            one = E.auc_rank(raw, "margin", "label").select(F.coalesce("auc", one_class).alias("auc"))
            areas = one if areas is None else areas.unionByName(one)
        mean = model.cv_metrics[prefix][0]
        same = F.abs(F.avg("auc") - F.lit(mean)) < 1e-9
        parts.append(areas.agg(F.lit(prefix).alias("model"), F.count(F.lit(1)).alias("n_folds"), same.alias("same")))
    return parts[0].unionByName(parts[1])


@register("lsi_certificate", f"SELECT unnest(range({LSI_RANK})) AS axis, true AS eigen, true AS unit, true AS ordered")
def lsi_certificate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each axis v of the training half's matrix A is a unit vector with A^T A v =
    s^2 v, in falling order of s; checked by two products over the entries."""
    rows, entries, factors = lsi_fit(spark, sf_dir)
    return lsi_checked(entries.join(rows.where("split = 'train'").select("row"), "row"), factors)


def lsi_checked(entries: DataFrame, factors: FA.Factors) -> DataFrame:
    k = len(factors.values)
    by_row = FA.summed(entries.join(factors.axes, "idx"), "row", F.col("axes"), k, "y")
    again = FA.summed(entries.join(by_row, "row"), "idx", F.col("y"), k, "z")
    both = factors.axes.join(again, "idx", "left").withColumn("z", F.coalesce("z", F.array_repeat(F.lit(0.0), k)))
    checks = []
    for i, value in enumerate(factors.values):
        miss = F.sqrt(F.sum(F.pow(F.col("z")[i] - F.lit(value**2) * F.col("axes")[i], 2)))
        length = F.sum(F.col("axes")[i] * F.col("axes")[i])
        ordered = i == 0 or value <= factors.values[i - 1]
        checks.append(F.struct(F.lit(i).cast("bigint").alias("axis"), (miss < 1e-7 * factors.values[0] ** 2).alias("eigen"), (F.abs(length - 1) < 1e-9).alias("unit"), F.lit(ordered).alias("ordered")))
    return both.agg(F.array(*checks).alias("c")).select(F.explode("c").alias("c")).select("c.*")


@register("lsi_regression_certificate", f"SELECT count(*) AS n_rows, true AS stationary, CAST(0 AS BIGINT) AS n_wrong FROM ({SQL_TEST_HALF}) h")
def lsi_regression_certificate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The regression on the coordinates has no slope at its weights, and every test
    row's prediction follows from them."""
    vectors = materialize(lsi_coordinates(*lsi_fit(spark, sf_dir)).drop("lsi"), "lsi-vectors")
    model = lsi_regression(vectors)
    return lsi_regression_checked(vectors, model.coefficients.toArray().tolist(), model.intercept, model)


def lsi_regression_checked(vectors: DataFrame, weights: list[float], intercept: float, model) -> DataFrame:
    from pyspark.ml.functions import array_to_vector

    z = sum((F.col("at")[i] * F.lit(float(w)) for i, w in enumerate(weights)), F.lit(float(intercept)))
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    fitted = vectors.where("split = 'train'").withColumn("e", p - F.col("positive"))
    slopes = [F.abs(F.avg(F.col("e") * F.col("at")[i]) + F.lit(LSI_REG * float(w))) for i, w in enumerate(weights)]
    flat = fitted.agg((F.greatest(F.abs(F.avg("e")), *slopes) < 1e-6).alias("stationary"))
    test = model.transform(vectors.where("split = 'test'").withColumn("lsi", array_to_vector("at")))
    wrong = (F.col("prediction") == 1.0) != (p > 0.5)
    counted = test.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.coalesce(wrong, F.lit(True))).alias("n_wrong"))
    return counted.crossJoin(flat).select("n_rows", "stationary", "n_wrong")


@register("svc_certificate", "SELECT true AS stationary, true AS falling, true AS better, CAST(0 AS BIGINT) AS n_wrong")
def svc_certificate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sigmoid is the most likely one for the held-out margins (no slope), its
    probability rises with the margin, it beats the uncalibrated probability of the
    margin, and every class is the margin's sign."""
    fit_half, test = svc_rows(spark, sf_dir)
    margins = materialize(M.held_out_margins(fit_half, M.linear_svc("positive", "svc"), "positive"), "svc-margins")
    sigmoid = M.platt_scaling(margins)
    scored = M.linear_svc("positive", "svc").fit(fit_half).transform(test)
    return svc_checked(margins, sigmoid, M.with_probability(scored, "svc", sigmoid))


def svc_checked(margins: DataFrame, sigmoid: M.Sigmoid, scored: DataFrame) -> DataFrame:
    counts = margins.agg(F.count_if(F.col("y") == 1).alias("k"), F.count_if(F.col("y") == 0).alias("m"))
    known = margins.crossJoin(counts)  # one row: a third column of every margin
    target = F.when(F.col("y") == 1, (F.col("k") + 1) / (F.col("k") + 2)).otherwise(F.lit(1.0) / (F.col("m") + 2))
    p, plain = sigmoid.probability(F.col("margin")), M.Sigmoid(-1.0, 0.0).probability(F.col("margin"))
    gap = target - p
    loss = lambda q: -F.avg(F.col("y") * F.log(q) + (F.lit(1.0) - F.col("y")) * F.log(F.lit(1.0) - q))
    fit = known.agg(
        (F.greatest(F.abs(F.avg(gap)), F.abs(F.avg(gap * F.col("margin")))) < 1e-6).alias("stationary"),
        F.lit(sigmoid.slope < 0).alias("falling"),
        (loss(p) < loss(plain)).alias("better"),
    )
    wrong = (F.col("svc") == 1.0) != (F.col("svc_margin") > 0)
    return fit.crossJoin(scored.agg(F.count_if(F.coalesce(wrong | (F.col("svc_p1") != sigmoid.probability(F.col("svc_margin"))), F.lit(True))).alias("n_wrong")))


# What any model must fulfil; the certificates above fail for all but the fitted one.
@register("cv_invariants", "SELECT unnest(['neg', 'pos']) AS model, CAST(1 AS BIGINT) AS n_points, true AS within")
def cv_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5/M6: one mean area under ROC a grid point, in [0, 1]."""
    metrics = train.fitted_models(spark, sf_dir).cv_metrics
    rows = labelled_targets(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))
    listed = rows.select(F.explode(F.array(*[F.struct(F.lit(p).alias("model"), F.array(*map(F.lit, m)).alias("m")) for p, m in sorted(metrics.items())])).alias("x"))
    return listed.select("x.model", F.size("x.m").cast("bigint").alias("n_points"), F.forall("x.m", lambda v: v.between(0, 1)).alias("within"))


@register("lsi_invariants", f"SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_wrong FROM ({SQL_TEST_HALF}) h")
def lsi_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M12 + M13: every held-out row is predicted, by its probability."""
    p = lsi_projection(spark, sf_dir)
    wrong = (F.col("prediction") == 1.0) != (F.col("probability") > 0.5)
    return p.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.coalesce(wrong, F.lit(True))).alias("n_wrong"))


@register("svc_invariants", f"SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_wrong FROM ({SQL_TEST_HALF}) h")
def svc_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every held-out row has the class of its margin's sign."""
    wrong = (F.col("svc") == 1.0) != (F.col("margin") > 0)
    return linear_svc_scores(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.coalesce(wrong, F.lit(True))).alias("n_wrong")
    )
