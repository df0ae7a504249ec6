"""Metrics, curves, fold summaries and result tables."""

from pyspark.sql import functions as F

from sparkrisk.catalog.sampling import _FOLDS
from sparkrisk.catalog.tables import DISTINCT, LABELLED, TIED, distinct_scores, labelled, load, rounded, tied_scores
from sparkrisk.operators import metrics, sample


def _tidy_metrics(spark, folder):
    return rounded(metrics.tidy(metrics.evaluate(tied_scores(spark, folder))))


def _fold_metrics(spark, folder):
    """Metrics per repeat, fold and side of a fixed rule: bought when the value is above 25."""
    folds = sample.fold_table(labelled(spark, folder).withColumn("y_pred", (F.col("value") > 25).cast("int")),
                              "event_id", "y")
    rows = folds.join(
        labelled(spark, folder).select("event_id", "y", (F.col("value") > 25).cast("int").alias("y_pred")), "event_id")
    sided = rows.select(
        "repeat", "y", "y_pred", F.col("fold").alias("own"), F.explode(F.sequence(F.lit(0), F.lit(4))).alias("fold"),
    ).withColumn("side", F.when(F.col("own") == F.col("fold"), "test").otherwise("train"))
    return metrics.class_metrics(sided, "y", "y_pred", by=["repeat", "fold", "side"])


_RATIOS = ["accuracy", "precision", "recall", "f1", "geometric_mean"]


def cv_summary(spark, folder):
    return rounded(metrics.fold_summary(_fold_metrics(spark, folder), _RATIOS))


def leaderboard(spark, folder):
    """Every line number as one experiment: how well the discount ranks returned lines."""
    scored = load(spark, folder, "lineitem").select(
        F.col("l_linenumber").cast("string").alias("experiment"),
        (F.col("l_returnflag") == "R").cast("int").alias("y_true"), F.col("l_discount").alias("y_proba"))
    results = metrics.rank_metrics(scored, by=["experiment"]).select(
        "experiment", F.lit("roc_auc").alias("metric"), F.col("roc_auc").alias("test_mean"))
    return rounded(metrics.leaderboard(results))


def top_features(spark, folder):
    """Absolute correlation with the returned flag as importance of every numeric column."""
    lines = load(spark, folder, "lineitem")
    y = (F.col("l_returnflag") == "R").cast("double")
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
    importance = lines.agg(*[F.abs(F.corr(F.col(c).cast("double"), y)).alias(c) for c in names]).select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("importance")) for c in names])))
    return rounded(metrics.top_features(importance, 3))


QUERIES = {
    "confusion_matrix": lambda s, d: metrics.confusion(tied_scores(s, d)),
    "classification_metrics": lambda s, d: rounded(metrics.class_metrics(tied_scores(s, d))),
    "metrics_by_group": lambda s, d: rounded(_fold_metrics(s, d)),
    "roc_auc": lambda s, d: rounded(metrics.rank_metrics(distinct_scores(s, d)).select("roc_auc")),
    "average_precision": lambda s, d: rounded(metrics.rank_metrics(distinct_scores(s, d)).select("average_precision")),
    "rank_metrics_tied": lambda s, d: rounded(metrics.rank_metrics(tied_scores(s, d))),
    "metric_report": _tidy_metrics,
    "cv_summary": cv_summary,
    "leaderboard": leaderboard,
    "confusion_table": lambda s, d: metrics.confusion_table(tied_scores(s, d)),
    "roc_points": lambda s, d: rounded(metrics.roc_points(distinct_scores(s, d))),
    "roc_points_all": lambda s, d: rounded(metrics.roc_points(tied_scores(s, d), drop_collinear=False)),
    "pr_points": lambda s, d: rounded(metrics.precision_recall_points(distinct_scores(s, d))),
    "top_features": top_features,
    "class_distribution": lambda s, d: rounded(metrics.class_distribution(
        labelled(s, d), "y", {0: "Malo", 1: "Bueno"})),
}

_CELLS = """COUNT(CASE WHEN y_true = 0 AND y_pred = 0 THEN 1 END) AS true_negatives,
  COUNT(CASE WHEN y_true = 0 AND y_pred = 1 THEN 1 END) AS false_positives,
  COUNT(CASE WHEN y_true = 1 AND y_pred = 0 THEN 1 END) AS false_negatives,
  COUNT(CASE WHEN y_true = 1 AND y_pred = 1 THEN 1 END) AS true_positives"""


def _ratio(top, bottom):
    return f"COALESCE(CAST({top} AS DOUBLE) / NULLIF({bottom}, 0), 0.0)"


_RECALL = _ratio("true_positives", "true_positives + false_negatives")
_SPECIFICITY = _ratio("true_negatives", "true_negatives + false_positives")
_EXACT = f"""CAST(true_positives + true_negatives AS DOUBLE)
    / (true_positives + true_negatives + false_positives + false_negatives) AS accuracy,
  {_ratio('true_positives', 'true_positives + false_positives')} AS "precision",
  {_RECALL} AS recall,
  {_ratio('2 * true_positives', '2 * true_positives + false_positives + false_negatives')} AS f1,
  SQRT({_RECALL} * {_SPECIFICITY}) AS geometric_mean"""
_ROUNDED = ", ".join(f'ROUND("{c}", 6) AS "{c}"' for c in _RATIOS)

_STEPS = """counts AS (SELECT y_proba AS score, COUNT(CASE WHEN y_true = 1 THEN 1 END) AS pos,
    COUNT(CASE WHEN y_true = 0 THEN 1 END) AS neg FROM scored GROUP BY y_proba),
  steps AS (SELECT *, CAST(SUM(pos) OVER (ORDER BY score DESC) AS BIGINT) AS tp,
                   CAST(SUM(neg) OVER (ORDER BY score DESC) AS BIGINT) AS fp,
                   CAST(SUM(pos) OVER () AS BIGINT) AS p, CAST(SUM(neg) OVER () AS BIGINT) AS n,
                   LEAD(pos) OVER (ORDER BY score DESC) AS next_pos, LEAD(neg) OVER (ORDER BY score DESC) AS next_neg,
                   ROW_NUMBER() OVER (ORDER BY score DESC) AS place FROM counts)"""
_AUC = "ROUND(SUM(pos * ((n - fp) + 0.5::DOUBLE * neg)) / (CAST(MAX(p) AS DOUBLE) * MAX(n)), 6) AS roc_auc"
_AP = "ROUND(SUM(CAST(pos AS DOUBLE) * tp / (tp + fp)) / MAX(p), 6) AS average_precision"
_POINT = "ROUND(CAST(fp AS DOUBLE) / n, 6) AS fpr, ROUND(CAST(tp AS DOUBLE) / p, 6) AS tpr, ROUND(score, 6) AS threshold"
_START = "SELECT 0.0::DOUBLE, 0.0::DOUBLE, CAST('inf' AS DOUBLE)"

_FOLD_METRICS = f"""{_FOLDS},
  sided AS (SELECT f.repeat, CAST(g.fold AS INTEGER) AS fold, CASE WHEN f.fold = g.fold THEN 'test' ELSE 'train' END AS side,
                   l.y AS y_true, CASE WHEN l.value > 25 THEN 1 ELSE 0 END AS y_pred
            FROM folds f JOIN labelled l ON f.event_id = l.event_id,
                 (VALUES (0), (1), (2), (3), (4)) g(fold)),
  cells AS (SELECT repeat, fold, side, {_CELLS} FROM sided GROUP BY repeat, fold, side),
  fold_metrics AS (SELECT *, {_EXACT} FROM cells)"""


def _summary(metric):
    def side(s):
        return (f'ROUND(AVG(CASE WHEN side = \'{s}\' THEN "{metric}" END), 6) AS {s}_mean, '
                f'ROUND(STDDEV_POP(CASE WHEN side = \'{s}\' THEN "{metric}" END), 6) AS {s}_std')
    return f"SELECT '{metric}' AS metric, {side('test')}, {side('train')} FROM fold_metrics"


_IMPORTANCE = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, ABS(CORR(CAST({c} AS DOUBLE), CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END)) "
    "AS importance FROM lineitem" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"))

SQL = {
    "confusion_matrix": f"WITH {TIED} SELECT {_CELLS} FROM scored",
    "classification_metrics": f"""WITH {TIED}, c AS (SELECT {_CELLS} FROM scored), m AS (SELECT *, {_EXACT} FROM c)
      SELECT true_negatives, false_positives, false_negatives, true_positives, {_ROUNDED} FROM m""",
    "metrics_by_group": f"""WITH {LABELLED}, {_FOLD_METRICS} SELECT repeat, fold, side, true_negatives, false_positives,
      false_negatives, true_positives, {_ROUNDED} FROM fold_metrics""",
    "roc_auc": f"WITH {DISTINCT}, {_STEPS} SELECT {_AUC} FROM steps",
    "average_precision": f"WITH {DISTINCT}, {_STEPS} SELECT {_AP} FROM steps",
    "rank_metrics_tied": f"WITH {TIED}, {_STEPS} SELECT {_AUC}, {_AP} FROM steps",
    "metric_report": f"""WITH {TIED}, {_STEPS}, c AS (SELECT {_CELLS} FROM scored), m AS (SELECT *, {_EXACT} FROM c),
      r AS (SELECT {_AUC}, {_AP} FROM steps) """ + " UNION ALL ".join(
        f"""SELECT '{c}' AS metric, ROUND(CAST("{c}" AS DOUBLE), 6) AS value FROM m, r""" for c in (
            "true_negatives", "false_positives", "false_negatives", "true_positives", *_RATIOS,
            "roc_auc", "average_precision")),
    "cv_summary": f"WITH {LABELLED}, {_FOLD_METRICS} " + " UNION ALL ".join(_summary(m) for m in _RATIOS),
    "leaderboard": """WITH counts AS (SELECT CAST(l_linenumber AS VARCHAR) AS experiment, l_discount AS score,
        COUNT(CASE WHEN l_returnflag = 'R' THEN 1 END) AS pos, COUNT(CASE WHEN l_returnflag <> 'R' THEN 1 END) AS neg
        FROM lineitem GROUP BY ALL),
      steps AS (SELECT *, SUM(neg) OVER (PARTITION BY experiment ORDER BY score DESC) AS fp,
        SUM(pos) OVER (PARTITION BY experiment) AS p, SUM(neg) OVER (PARTITION BY experiment) AS n FROM counts),
      scores AS (SELECT experiment, CAST(SUM(pos * ((n - fp) + 0.5 * neg)) AS DOUBLE) / CAST(MAX(p) * MAX(n) AS DOUBLE) AS score
        FROM steps GROUP BY experiment)
      SELECT CAST(ROW_NUMBER() OVER (ORDER BY score DESC, experiment) AS INTEGER) AS place, experiment,
             ROUND(score, 6) AS score FROM scores""",
    "confusion_table": f"""WITH {TIED}, c AS (SELECT {_CELLS} FROM scored)
      SELECT 'Malo' AS true_label, 'Malo' AS predicted_label, true_negatives AS n FROM c
      UNION ALL SELECT 'Malo', 'Bueno', false_positives FROM c
      UNION ALL SELECT 'Bueno', 'Malo', false_negatives FROM c
      UNION ALL SELECT 'Bueno', 'Bueno', true_positives FROM c""",
    "roc_points": f"""WITH {DISTINCT}, {_STEPS} SELECT {_POINT} FROM steps
      WHERE place = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg UNION ALL {_START}""",
    "roc_points_all": f"WITH {TIED}, {_STEPS} SELECT {_POINT} FROM steps UNION ALL {_START}",
    "pr_points": f"""WITH {DISTINCT}, {_STEPS} SELECT ROUND(CAST(tp AS DOUBLE) / (tp + fp), 6) AS "precision",
      ROUND(CAST(tp AS DOUBLE) / p, 6) AS recall, ROUND(score, 6) AS threshold FROM steps
      UNION ALL SELECT 1.0::DOUBLE, 0.0::DOUBLE, NULL""",
    "top_features": f"""WITH i AS ({_IMPORTANCE}) SELECT feature, ROUND(importance, 6) AS importance
      FROM i ORDER BY i.importance DESC, feature LIMIT 3""",
    "class_distribution": f"""WITH {LABELLED} SELECT y AS class, CASE WHEN y = 0 THEN 'Malo' ELSE 'Bueno' END AS label,
      COUNT(*) AS n, ROUND(100.0 * COUNT(*) / CAST(SUM(COUNT(*)) OVER () AS DOUBLE), 6) AS pct FROM labelled GROUP BY y""",
}
