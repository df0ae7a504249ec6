"""Training: preprocessor, optional resampling, model; cross-validation; sweeps."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target, keyword_only
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkrisk.functions import ident
from sparkrisk.operators import metrics
from sparkrisk.operators.encode import widths
from sparkrisk.operators.models import FEATURES, LABEL, ScoreColumns, get_model, model_entry
from sparkrisk.operators.oversample import get_sampler
from sparkrisk.operators.sample import repeated_folds
from sparkrisk.plans import folds as folds_together
from sparkrisk.plans.features import feature_names, feature_pipeline
from sparkrisk.session import learning_rows, materialize
from sparkrisk.sources.files import path_exists, results_document, write_json
from sparkrisk.spec import (
    BORDERLINE_NEIGHBOURS, CV_FOLDS, CV_REPEATS, DEFAULT_SPEC, METRICS, SEED, SMOTE_NEIGHBOURS, FeatureSpec,
)

def result_config(
    folds: int = CV_FOLDS, repeats: int = CV_REPEATS, sampler: str | Callable | None = "BorderlineSMOTE", seed: int = SEED,
) -> dict:
    """The settings stored next to the results; without a sampler there is no ``smote_config``."""
    config: dict = {"cv_folds": folds, "cv_repeats": repeats, "random_seed": seed}
    if sampler is not None:
        own = sampler if isinstance(sampler, str) else getattr(sampler, "__name__", type(sampler).__name__)
        config["smote_config"] = {"method": own, "random_state": seed, "k_neighbors": SMOTE_NEIGHBOURS}
        if own == "BorderlineSMOTE":
            config["smote_config"]["m_neighbors"] = BORDERLINE_NEIGHBOURS
    return config


class TrainingPipeline(Estimator):
    """Preprocess, resample (only here, never when scoring), fit the model.

    ``sampler`` is ``None``, the name of a sampler, or a function
    ``(encoded table, features, target, key) -> table``.
    """

    @keyword_only
    def __init__(self, *, model="logistic_regression", key="row_id", spec=DEFAULT_SPEC,
                 preprocessor=None, sampler="BorderlineSMOTE"):
        super().__init__()
        self.entry = model_entry(model)
        self.model, self.key, self.spec = model, key, spec
        self.preprocessor = preprocessor or feature_pipeline(spec)
        self.sampler = sampler if sampler is None or callable(sampler) else get_sampler(sampler)

    @property
    def steps(self) -> list[str]:
        return ["preprocessor", *(["sampler"] if self.sampler else []), "model"]

    def _fit(self, df: DataFrame) -> PipelineModel:
        prepared = self.preprocessor.fit(df)
        names = feature_names(prepared)
        encoded = prepared.transform(df)
        if self.sampler is not None:
            encoded = self.sampler(encoded, names, self.spec.target, self.key)
        assembler = VectorAssembler(inputCols=names, outputCol=FEATURES, handleInvalid="error")
        ready = assembler.transform(encoded).select(FEATURES, ident(self.spec.target).cast("double").alias(LABEL))
        with learning_rows(ready) as (rows, n):
            fitted = get_model(self.model, n, sum(widths(encoded, names))).fit(rows)
        return PipelineModel([prepared, assembler, fitted, ScoreColumns()])


def fold_scores(
    labelled: DataFrame, pipeline: TrainingPipeline, folds: int, repeats: int, parallelism: int = 4,
    scorers: Mapping[str, Column] | None = None,
) -> list[dict]:
    """One entry per fit and side. ``labelled`` has ``fold_0 ..``.

    Fits that use the library's own steps share the jobs that prepare them; others are fitted one by one. A
    few models are fitted at once, and one evaluation covers all of them.
    """
    points = [(r, f) for r in range(repeats) for f in range(folds)]
    target = pipeline.spec.target
    masks = {g: F.col(f"fold_{r}") != f for g, (r, f) in enumerate(points)}
    # Folds are long expressions, which each fit would compute again in every pass.
    labelled = materialize(labelled, "fold-labels")
    if folds_together.can_share(pipeline.preprocessor, pipeline.sampler):
        scored = folds_together.scores_together(
            labelled, pipeline.preprocessor, pipeline.sampler, pipeline.model, masks, pipeline.key, target, parallelism)
    else:
        scored = _scores_apart(labelled, pipeline, masks, [f"fold_{r}" for r in range(repeats)], parallelism)
    rows = metrics.evaluate(scored, score="y_score", by=["grp", "side"], extra=scorers).collect()
    return [{"repeat": points[row["grp"]][0], "fold": points[row["grp"]][1], **row.asDict()} for row in rows]


def _scores_apart(
    labelled: DataFrame, pipeline: TrainingPipeline, masks: Mapping[int, Column], sides: Sequence[str], parallelism: int,
) -> DataFrame:
    """The table of ``folds.scores_together`` for pipelines with parts of their own."""

    def one(g: int) -> DataFrame:
        fitted = pipeline.fit(labelled.where(masks[g]).drop(*sides))
        scored = fitted.transform(labelled.withColumn("side", F.when(masks[g], "train").otherwise("test")))
        return scored.select(F.lit(g).alias("grp"), "side", ident(pipeline.spec.target).alias("y_true"), "y_pred", "y_score")

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        run = inheritable_thread_target(labelled.sparkSession)(one)
        tables = [job.result() for job in [pool.submit(run, g) for g in masks]]
    union = tables[0]
    for more in tables[1:]:
        union = union.unionByName(more)
    return materialize(union, "fold-scores")


def cross_validate(
    df: DataFrame,
    pipeline: TrainingPipeline,
    folds: int = CV_FOLDS,
    repeats: int = CV_REPEATS,
    seed: int = SEED,
    metric_names: Sequence[str] = METRICS,
    parallelism: int = 4,
    scorers: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``(model, metric, test_mean, test_std, train_mean, train_std)``.

    Everything that learns is fitted again on the train part of each fold. ``scorers``
    adds own metrics: aggregates over ``y_true``, ``y_pred`` and ``y_score``. The
    summary is computed from 2 x folds x repeats score rows.
    """
    metric_names = [*metric_names, *(scorers or {})]
    spark = df.sparkSession
    labelled = repeated_folds(df, pipeline.key, pipeline.spec.target, folds, repeats, seed)
    entries = fold_scores(labelled, pipeline, folds, repeats, parallelism, scorers)
    columns = ["repeat", "fold", "side", *metric_names]
    types = "repeat int, fold int, side string, " + ", ".join(f"{m} double" for m in metric_names)
    table = spark.createDataFrame([[e[c] for c in columns] for e in entries], types)
    return metrics.fold_summary(table, metric_names).withColumn("model", F.lit(pipeline.model)).select(
        "model", "metric", "test_mean", "test_std", "train_mean", "train_std"
    )


def train(
    df: DataFrame,
    key: str,
    spec: FeatureSpec = DEFAULT_SPEC,
    model: str = "logistic_regression",
    sampler: str | Callable | None = "BorderlineSMOTE",
    preprocessor: Estimator | None = None,
    evaluate: bool = True,
    save_to: str | None = None,
    folds: int = CV_FOLDS,
    repeats: int = CV_REPEATS,
) -> tuple[PipelineModel, DataFrame | None]:
    """Fitted pipeline and, on demand, its cross-validation summary."""
    pipeline = TrainingPipeline(model=model, key=key, spec=spec, preprocessor=preprocessor, sampler=sampler)
    summary = cross_validate(df, pipeline, folds, repeats) if evaluate else None
    fitted = pipeline.fit(df)
    if save_to:
        fitted.write().overwrite().save(save_to)
    return fitted, summary


def sweep(
    df: DataFrame, key: str, models: Sequence[str], spec: FeatureSpec = DEFAULT_SPEC,
    samplers: Sequence[str | None] = ("BorderlineSMOTE",), folds: int = CV_FOLDS, repeats: int = CV_REPEATS,
) -> DataFrame:
    """Summaries of all model and sampler combinations, with an ``experiment`` column."""
    out = None
    for model in models:
        for sampler in samplers:
            pipeline = TrainingPipeline(model=model, key=key, spec=spec, sampler=sampler)
            name = f"{model}+{sampler}" if sampler else model
            rows = cross_validate(df, pipeline, folds, repeats).withColumn("experiment", F.lit(name))
            out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError("no model to compare")
    return out


def load_model(spark, path: str) -> PipelineModel:
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no model at {path}")
    return PipelineModel.load(path)


def save_results(
    summary: DataFrame, model: str, path: str, folds: int = CV_FOLDS, repeats: int = CV_REPEATS,
    sampler: str | Callable | None = "BorderlineSMOTE", seed: int = SEED,
) -> None:
    """Cross-validation result document as JSON; the settings are those that the summary was made with."""
    config = result_config(folds, repeats, sampler, seed)
    write_json(results_document(summary, model, model_entry(model).display_name, config), path)
