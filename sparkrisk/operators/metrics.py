"""Classification metrics and curves.

Curves need running sums over all distinct scores. Rows are first added up per
score and written in falling order; running sums are taken inside blocks of that
table, and the totals of the blocks and parts above are added. No window ever
covers the whole table, and one such table serves every curve.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkrisk.functions import ident
from sparkrisk.operators.prefixes import BLOCK_BITS, running_sums, written
from sparkrisk.operators.profile import value_counts
from sparkrisk.spec import CLASS_LABELS, METRICS


def _hits(truth: Column, predicted: Column) -> dict[str, Column]:
    return {
        "true_negatives": F.count_if((truth == 0) & (predicted == 0)),
        "false_positives": F.count_if((truth == 0) & (predicted == 1)),
        "false_negatives": F.count_if((truth == 1) & (predicted == 0)),
        "true_positives": F.count_if((truth == 1) & (predicted == 1)),
    }


def confusion(
    df: DataFrame, truth: str = "y_true", predicted: str = "y_pred", by: Sequence[str] = (),
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """The four cells as columns, also where a class never occurs, and own aggregates."""
    cells = [c.alias(n) for n, c in {**_hits(ident(truth), ident(predicted)), **(extra or {})}.items()]
    return df.groupBy(*by).agg(*cells) if by else df.agg(*cells)


def _ratios() -> dict[str, Column]:
    tn, fp, fn, tp = (F.col(c) for c in _hits(F.lit(0), F.lit(0)))
    zero = F.lit(0.0)
    recall = F.coalesce(F.try_divide(tp, tp + fn), zero)
    return {
        "accuracy": F.try_divide(tp + tn, tn + fp + fn + tp),
        "precision": F.coalesce(F.try_divide(tp, tp + fp), zero),
        "recall": recall,
        "f1": F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), zero),
        "geometric_mean": F.sqrt(recall * F.coalesce(F.try_divide(tn, tn + fp), zero)),
    }


def class_metrics(
    df: DataFrame, truth: str = "y_true", predicted: str = "y_pred", by: Sequence[str] = (),
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Cells, accuracy, precision, recall, F1 and geometric mean; undefined ratios are 0."""
    return confusion(df, truth, predicted, by, extra).withColumns(_ratios())


def score_steps(
    df: DataFrame, truth: str = "y_true", score: str = "y_proba", by: Sequence[str] = (), block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """One row per distinct score: ``score, pos, neg`` at it, ``tp, fp`` at or above it,
    class totals ``P, N``, and whether the next lower score has the same counts.

    The scores are read once and their counts are written; the result may feed several curves.
    """
    by = list(by)
    scored = df.select(
        *[ident(c) for c in by], ident(score).cast("double").alias("score"), ident(truth).alias("y")
    ).where(F.col("score").isNotNull() & F.col("y").isNotNull())
    counts = scored.groupBy(*[ident(c) for c in by], "score").agg(
        F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg"))
    falling = written(counts, "scores", [*[ident(c) for c in by], F.desc("score")])
    return running_sums(falling, by, ["pos", "neg"], block_bits).select(
        *[ident(c) for c in by], "score", "pos", "neg", F.col("pos_all").alias("P"), F.col("neg_all").alias("N"),
        (F.col("pos_before") + F.col("pos")).alias("tp"), (F.col("neg_before") + F.col("neg")).alias("fp"),
        F.coalesce(F.col("following") == F.struct("pos", "neg"), F.lit(False)).alias("repeats_next"),
        F.col("following").isNull().alias("is_last"))


def rank_metrics(
    df: DataFrame, truth: str = "y_true", score: str = "y_proba",
    by: Sequence[str] = (), block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """``roc_auc`` (ties count half) and ``average_precision``; NULL with one class only."""
    steps = score_steps(df, truth, score, by, block_bits)
    pos, neg, pos_here = (F.col(c).cast("double") for c in ("P", "N", "pos"))
    outranked = pos_here * ((F.col("N") - F.col("fp")) + 0.5 * F.col("neg"))
    precision = pos_here * F.col("tp") / (F.col("tp") + F.col("fp"))
    cells = [
        F.try_divide(F.sum(outranked), F.max(pos) * F.max(neg)).alias("roc_auc"),
        F.when(F.max(neg) > 0, F.try_divide(F.sum(precision), F.max(pos))).alias("average_precision"),
    ]
    return steps.groupBy(*by).agg(*cells) if by else steps.agg(*cells)


def evaluate(
    df: DataFrame, truth: str = "y_true", predicted: str = "y_pred", score: str | None = "y_proba",
    by: Sequence[str] = (), extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """All metrics of a prediction table in one row (one per group with ``by``)."""
    by = list(by)
    out = class_metrics(df, truth, predicted, by, extra)
    if score is None or score not in df.columns:
        return out
    ranked = rank_metrics(df, truth, score, by)
    if by:
        return out.join(ranked, by)
    both = ranked.select(F.struct("roc_auc", "average_precision")).scalar()
    return out.withColumn("ranked", both).select("*", "ranked.roc_auc", "ranked.average_precision").drop("ranked")


def metrics_document(metrics: DataFrame) -> DataFrame:
    """Metric columns beside a nested ``confusion_matrix``."""
    cells = list(_hits(F.lit(0), F.lit(0)))
    values = [c for c in metrics.columns if c not in cells]
    return metrics.select(*values, F.struct(*cells).alias("confusion_matrix"))


def tidy(metrics: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """``(metric, value)`` rows of a one-row metric table."""
    have = [c for c in metrics.columns if names is None or c in names]
    return metrics.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("metric"), ident(c).cast("double").alias("value")) for c in have
    ])))


def confusion_table(
    df: DataFrame, truth: str = "y_true", predicted: str = "y_pred", labels: Sequence[str] = CLASS_LABELS
) -> DataFrame:
    """``(true_label, predicted_label, n)`` for the full grid of classes."""
    cells = []
    for (t, p), name in zip(((0, 0), (0, 1), (1, 0), (1, 1)), _hits(F.lit(0), F.lit(0))):
        cells.append(F.struct(F.lit(labels[t]).alias("true_label"), F.lit(labels[p]).alias("predicted_label"),
                              F.col(name).alias("n")))
    return confusion(df, truth, predicted).select(F.inline(F.array(*cells)))


def roc_points(
    df: DataFrame, truth: str = "y_true", score: str = "y_proba", drop_collinear: bool = True, block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """``(fpr, tpr, threshold)`` per distinct score, starting at (0, 0, infinity).

    A point between two equal steps lies on their line and is left out on demand.
    """
    return roc_of_steps(score_steps(df, truth, score, block_bits=block_bits), drop_collinear)


def roc_of_steps(steps: DataFrame, drop_collinear: bool = True) -> DataFrame:
    """The points of :func:`roc_points` from a table of :func:`score_steps`."""
    if drop_collinear:
        # The point of the highest score is always kept: it has no step before it
        # to be collinear with.
        steps = steps.where(~F.col("repeats_next") | F.col("is_last") | (F.col("tp") + F.col("fp") == F.col("pos") + F.col("neg")))
    points = steps.select(
        F.try_divide("fp", "N").alias("fpr"), F.try_divide("tp", "P").alias("tpr"), F.col("score").alias("threshold")
    )
    start = steps.sparkSession.range(1).select(
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), F.lit(math.inf).alias("threshold")
    )
    return points.unionByName(start)


def precision_recall_points(
    df: DataFrame, truth: str = "y_true", score: str = "y_proba", block_bits: int = BLOCK_BITS
) -> DataFrame:
    """``(precision, recall, threshold)`` per distinct score, ending at (1, 0)."""
    return precision_recall_of_steps(score_steps(df, truth, score, block_bits=block_bits))


def precision_recall_of_steps(steps: DataFrame) -> DataFrame:
    """The points of :func:`precision_recall_points` from a table of :func:`score_steps`."""
    points = steps.select(
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.coalesce(F.try_divide("tp", "P"), F.lit(1.0)).alias("recall"),
        F.col("score").alias("threshold"),
    )
    end = steps.sparkSession.range(1).select(
        F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"), F.lit(None).cast("double").alias("threshold")
    )
    return points.unionByName(end)


def top_features(importances: DataFrame, n: int = 20) -> DataFrame:
    """First ``n`` rows of ``(feature, importance)``, largest first, names on ties."""
    return importances.orderBy(F.desc("importance"), F.asc("feature")).limit(n)


def class_distribution(df: DataFrame, target: str, labels: Mapping | None = None) -> DataFrame:
    """``(class, label, n, pct)``; order by class when displayed."""
    counts = value_counts(df, target)
    total = df.agg(F.count(ident(target)).alias("total"))
    label = F.col("value").cast("string")
    for value, text in (labels or {}).items():
        label = F.when(F.col("value") == value, text).otherwise(label)
    return counts.select(
        F.col("value").alias("class"), label.alias("label"), "n",
        (100.0 * F.try_divide(F.col("n"), total.scalar())).alias("pct"),
    )


def fold_summary(folds: DataFrame, metrics: Sequence[str] = METRICS, by: Sequence[str] = ()) -> DataFrame:
    """``(by.., metric, test_mean, test_std, train_mean, train_std)`` from one row per
    fit and side (``side`` = ``test`` or ``train``); population deviation, NaN left out."""
    sides = {}
    for side in ("test", "train"):
        v = F.when(F.col("side") == side, F.nanvl(F.col("value"), F.lit(None).cast("double")))
        sides[f"{side}_mean"] = F.avg(v)
        sides[f"{side}_std"] = F.stddev_pop(v)
    long = folds.select(*by, "side", F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), ident(m).cast("double").alias("value"))
        for m in metrics if m in folds.columns
    ])))
    return long.groupBy(*by, "metric").agg(*[c.alias(n) for n, c in sides.items()])


def leaderboard(results: DataFrame, metric: str = "roc_auc") -> DataFrame:
    """``(place, experiment, score)``: experiments by mean test score, failed ones last.

    Experiments are few (one row per training run), so one window over them is fine.
    """
    best = results.where(F.col("metric") == metric).select("experiment", F.col("test_mean").alias("score"))
    order = Window.orderBy(F.desc_nulls_last("score"), F.asc("experiment"))
    return best.select(F.row_number().over(order).alias("place"), "experiment", "score")
