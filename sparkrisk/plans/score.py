"""Scoring jobs: classes, probabilities, evaluation, sinks, report bundle."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from sparkrisk.functions import ident
from sparkrisk.operators import metrics
from sparkrisk.sources.files import predictions_table, write_json, write_table
from sparkrisk.spec import CLASS_LABELS

def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """The table with ``y_pred`` (and ``y_proba`` where the model has probabilities)."""
    return model.transform(df)


def predict_proba(model: PipelineModel, df: DataFrame) -> DataFrame:
    """As :func:`predict`, for models that have probabilities."""
    scored = model.transform(df)
    if "y_proba" not in scored.columns:
        raise AttributeError("the model has no probabilities")
    return scored


def batch_predict(
    model: PipelineModel, df: DataFrame, batch_rows: int | None = None, proba: bool = False
) -> DataFrame:
    """Scores partition by partition, which are the batches; same result as :func:`predict`.

    ``batch_rows`` deals the rows into partitions of about that many, for a count and a shuffle;
    without it the partitions stay as they are.
    """
    if batch_rows is not None:
        df = df.repartition(max(1, -(-df.count() // batch_rows)))
    return predict_proba(model, df) if proba else predict(model, df)


def predict_and_evaluate(
    model: PipelineModel, df: DataFrame, truth: str, save_to: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(scored rows, one-row metrics)``.

    The metrics are those of the written predictions; without ``save_to`` the three prediction
    columns are kept while they are computed.
    """
    scored = predict(model, df)
    table = predictions_table(scored, truth)
    score = "y_proba" if "y_proba" in table.columns else None
    if save_to:
        write_table(table, save_to)
        return scored, metrics.evaluate(df.sparkSession.read.schema(table.schema).parquet(save_to), score=score)
    table.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        result = metrics.evaluate(table, score=score)
        row = df.sparkSession.createDataFrame([result.first()], result.schema)  # one row
    finally:
        table.unpersist()
    return scored, row


def score_job(
    model: PipelineModel, df: DataFrame, output: str, truth: str | None = None, proba: bool = False,
) -> DataFrame | None:
    """Writes ``<output>/predictions`` and, where the truth is known, ``<output>/metrics``.

    Returns the metrics, or ``None`` without truth.
    """
    if truth is None:
        scored = batch_predict(model, df, proba=proba)
        wanted = {"prediction": None} if proba else {"probability": None}
        write_table(predictions_table(scored, None, **wanted), f"{output}/predictions")
        return None
    _, result = predict_and_evaluate(model, df, truth, f"{output}/predictions")
    write_json(metrics.metrics_document(result), f"{output}/metrics")
    return df.sparkSession.read.json(f"{output}/metrics")


def report_bundle(scored: DataFrame, truth: str = "y_true", labels=CLASS_LABELS) -> dict[str, DataFrame]:
    """Confusion table, ROC points, precision-recall points and class distribution."""
    table = scored.select(ident(truth).alias("y_true"), "y_pred", "y_proba")
    steps = metrics.score_steps(table)  # one for both curves
    return {
        "confusion": metrics.confusion_table(table, labels=labels),
        "roc": metrics.roc_of_steps(steps),
        "precision_recall": metrics.precision_recall_of_steps(steps),
        "classes": metrics.class_distribution(table, "y_true", dict(enumerate(labels))),
    }
