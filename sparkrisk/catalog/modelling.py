"""Scoring with a fixed logistic model, and models fitted on the events table."""

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from sparkrisk.catalog.tables import DISTINCT, LABELLED, TIED, distinct_scores, labelled, modelling, rounded
from sparkrisk.catalog import evaluation
from sparkrisk.catalog.sampling import _FOLDS
from sparkrisk.operators import metrics
from sparkrisk.operators.fixed import ClassMeans, LogisticScorer
from sparkrisk.operators.models import register_model
from sparkrisk.operators.sample import holdout_split
from sparkrisk.plans import score, train
from sparkrisk.plans.features import feature_pipeline
from sparkrisk.sources.files import predictions_table
from sparkrisk.spec import FeatureSpec

SPEC = FeatureSpec(
    numeric=("value", "k"), ordinal=("hour",), nominal=("weekday", "region"), target="bought",
    rules={"region": [0, 1, 2, 3]}, outlier_columns=("value", "k"),
)
COEFFICIENTS = {"value": 0.0625, "visitor": -0.03125}
INTERCEPT = -0.25


def fixed_model():
    """A fitted pipeline whose scores SQL can state."""
    return PipelineModel([LogisticScorer.of(COEFFICIENTS, INTERCEPT)])


def scored(spark, folder):
    return score.predict_proba(fixed_model(), labelled(spark, folder))


def _parts(spark, folder):
    df = holdout_split(modelling(spark, folder), "event_id", SPEC.target)
    return df.where(F.col("split") == "train").drop("split"), df.where(F.col("split") == "test").drop("split")


def trained(model, sampler=None):
    """Fit on the train part, metrics of the test part."""
    def run(spark, folder):
        fit_rows, test_rows = _parts(spark, folder)
        fitted, _ = train.train(fit_rows, "event_id", SPEC, model, sampler=sampler, evaluate=False)
        table = predictions_table(score.predict(fitted, test_rows), SPEC.target)
        return metrics.tidy(metrics.evaluate(table))
    return run


def batch_score(spark, folder):
    found = score.batch_predict(fixed_model(), labelled(spark, folder), proba=True)
    return rounded(found.select("event_id", "y_pred", "y_proba"))


# An own learner, resampler and scorers, all of which SQL can state.
register_model("class_means", "Class Means", lambda n_rows, n_features: ClassMeans(feature=0))
MEANS_SPEC = FeatureSpec(numeric=("value",), ordinal=(), nominal=(), target="y", rules={}, outlier_columns=())


def only_odd(df, names, target, key):
    """An own resampler: class 0 is thinned to odd ids."""
    return df.where((F.col(target) == 1) | (F.col(key) % 2 == 1))


def _means_pipeline():
    return train.TrainingPipeline(
        model="class_means", key="event_id", spec=MEANS_SPEC, sampler=only_odd,
        preprocessor=feature_pipeline(MEANS_SPEC, include_illegal=False, include_outliers=False))


def cross_validate_own_parts(spark, folder):
    """Cross-validation of an own learner with an own resampler inside each fold and an own scorer."""
    found = train.cross_validate(
        labelled(spark, folder).select("event_id", "value", "y"), _means_pipeline(),
        metric_names=["accuracy", "recall", "f1"], scorers={"bought_share": F.avg(F.col("y_pred").cast("double"))})
    return rounded(found)


def train_class_means(spark, folder):
    """Confusion counts over all rows of the own learner fitted on all rows."""
    rows = labelled(spark, folder).select("event_id", "value", "y")
    fitted = _means_pipeline().fit(rows)
    table = score.predict(fitted, rows).select(F.col("y").alias("y_true"), "y_pred")
    return metrics.confusion(table)


def cross_validate(spark, folder):
    """All defaults: five folds, three repeats, BorderlineSMOTE inside each fold."""
    pipeline = train.TrainingPipeline(key="event_id", spec=SPEC)
    return train.cross_validate(modelling(spark, folder), pipeline)


def report_bundle(spark, folder):
    """The four report tables in long form."""
    parts = score.report_bundle(distinct_scores(spark, folder))

    def at(threshold):
        finite = F.when(threshold < 1e6, threshold).cast("decimal(12,6)").cast("string")
        return F.coalesce(finite, F.when(threshold.isNull(), "none").otherwise("above"))

    return rounded(
        parts["confusion"].select(F.lit("confusion").alias("report"), F.concat_ws("/", "true_label", "predicted_label").alias("item"), F.col("n").cast("double").alias("value"))
        .unionByName(parts["classes"].select(F.lit("classes").alias("report"), F.col("label").alias("item"), F.col("pct").alias("value")))
        .unionByName(parts["roc"].select(F.lit("roc").alias("report"), at(F.col("threshold")).alias("item"), F.col("tpr").alias("value")))
        .unionByName(parts["precision_recall"].select(F.lit("precision_recall").alias("report"), at(F.col("threshold")).alias("item"), F.col("precision").alias("value")))
    )


QUERIES = {
    "score_class": lambda s, d: scored(s, d).select("event_id", "y_pred"),
    "score_proba": lambda s, d: rounded(scored(s, d).select("event_id", "y_proba")),
    "predictions_table": lambda s, d: rounded(predictions_table(scored(s, d), "y")),
    "batch_score": batch_score,
    "train_lr": trained("logistic_regression"),
    "train_lr_borderline": trained("logistic_regression", "BorderlineSMOTE"),
    "train_dt": trained("decision_tree"),
    "train_rf": trained("random_forest"),
    "train_svm": trained("svm"),
    "train_gbt": trained("xgboost"),
    "train_mlp": trained("mlp"),
    "cross_validate": cross_validate,
    "cross_validate_own_parts": cross_validate_own_parts,
    "train_class_means": train_class_means,
    "report_bundle": report_bundle,
}

# The encoder scales the value by the range of the rows it was fitted on; halfway between means scales along.
_MEANS_ALL = """means AS (SELECT AVG(CASE WHEN y = 0 THEN value END) AS low, AVG(CASE WHEN y = 1 THEN value END) AS high
    FROM labelled WHERE y = 1 OR event_id % 2 = 1),
  predicted AS (SELECT y, CASE WHEN (value - (low + high) / 2) * (CASE WHEN high >= low THEN 1 ELSE -1 END) > 0 THEN 1 ELSE 0 END AS p
    FROM labelled, means)"""
_MEANS_FOLDS = """sided AS (
    SELECT f.repeat, CAST(g.fold AS INTEGER) AS fold, f.fold = g.fold AS held, l.event_id, l.value, l.y
    FROM folds f JOIN labelled l ON f.event_id = l.event_id, (VALUES (0), (1), (2), (3), (4)) g(fold)),
  means AS (
    SELECT repeat, fold, AVG(CASE WHEN y = 0 THEN value END) AS low, AVG(CASE WHEN y = 1 THEN value END) AS high
    FROM sided WHERE NOT held AND (y = 1 OR event_id % 2 = 1) GROUP BY repeat, fold),
  predicted AS (
    SELECT s.repeat, s.fold, held, y, CASE WHEN (value - (low + high) / 2) * (CASE WHEN high >= low THEN 1 ELSE -1 END) > 0 THEN 1 ELSE 0 END AS p
    FROM sided s JOIN means m ON s.repeat = m.repeat AND s.fold = m.fold),
  cells AS (
    SELECT repeat, fold, held, CAST(COUNT(*) AS DOUBLE) AS n, SUM(y * p) AS tp, SUM((1 - y) * p) AS fp, SUM(y * (1 - p)) AS fn FROM predicted
    GROUP BY repeat, fold, held),
  scores AS (
    SELECT repeat, fold, held, UNNEST(['accuracy', 'recall', 'f1', 'bought_share']) AS metric, UNNEST([
      (n - fp - fn) / n, COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0), 0.0),
      COALESCE(CAST(2 * tp AS DOUBLE) / NULLIF(2 * tp + fp + fn, 0), 0.0), (tp + fp) / n]) AS score FROM cells)"""
_MEANS_SUMMARY = ", ".join(
    f"ROUND({f}(CASE WHEN {'' if s == 'test' else 'NOT '}held THEN score END), 6) AS {s}_{n}"
    for s in ("test", "train") for f, n in (("AVG", "mean"), ("STDDEV_POP", "std")))
_PROBA = "1.0 / (1.0 + EXP(-(-0.25::DOUBLE + 0.0625::DOUBLE * value + -0.03125::DOUBLE * visitor)))"
SQL = {
    "score_class": f"WITH {LABELLED} SELECT event_id, CASE WHEN {_PROBA} > 0.5 THEN 1 ELSE 0 END AS y_pred FROM labelled",
    "score_proba": f"WITH {LABELLED} SELECT event_id, ROUND({_PROBA}, 6) AS y_proba FROM labelled",
    "predictions_table": f"""WITH {LABELLED} SELECT y AS y_true, CASE WHEN {_PROBA} > 0.5 THEN 1 ELSE 0 END AS y_pred,
      ROUND({_PROBA}, 6) AS y_proba FROM labelled""",
    "batch_score": f"""WITH {LABELLED} SELECT event_id, CASE WHEN {_PROBA} > 0.5 THEN 1 ELSE 0 END AS y_pred,
      ROUND({_PROBA}, 6) AS y_proba FROM labelled""",
    "cross_validate_own_parts": f"""WITH {LABELLED}, {_FOLDS},
      {_MEANS_FOLDS} SELECT 'class_means' AS model, metric, {_MEANS_SUMMARY} FROM scores GROUP BY metric""",
    "report_bundle": f"""WITH confusion AS ({evaluation.SQL["confusion_table"].replace(TIED, DISTINCT)}),
      roc AS ({evaluation.SQL["roc_points"]}), pr AS ({evaluation.SQL["pr_points"]}), {DISTINCT}
      SELECT 'confusion' AS report, true_label || '/' || predicted_label AS item, CAST(n AS DOUBLE) AS value FROM confusion
      UNION ALL SELECT 'classes', CASE WHEN y_true = 0 THEN 'Malo' ELSE 'Bueno' END,
        ROUND(100.0 * COUNT(*) / CAST(SUM(COUNT(*)) OVER () AS DOUBLE), 6) FROM scored GROUP BY y_true
      UNION ALL SELECT 'roc', CASE WHEN isinf(threshold) THEN 'above' ELSE CAST(CAST(threshold AS DECIMAL(12,6)) AS VARCHAR) END, tpr FROM roc
      UNION ALL SELECT 'precision_recall', COALESCE(CAST(CAST(threshold AS DECIMAL(12,6)) AS VARCHAR), 'none'), "precision" FROM pr""",
    "train_class_means": f"""WITH {LABELLED}, {_MEANS_ALL} SELECT
      COUNT(CASE WHEN y = 0 AND p = 0 THEN 1 END) AS true_negatives, COUNT(CASE WHEN y = 0 AND p = 1 THEN 1 END) AS false_positives,
      COUNT(CASE WHEN y = 1 AND p = 0 THEN 1 END) AS false_negatives, COUNT(CASE WHEN y = 1 AND p = 1 THEN 1 END) AS true_positives
      FROM predicted""",
}
