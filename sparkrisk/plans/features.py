"""Feature preparation: pipeline assembly, fit on train, apply to both parts, persistence."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame

from sparkrisk.operators.encode import TableEncoderModel, encoder_for
from sparkrisk.operators.impute import IllegalToMode
from sparkrisk.operators.outliers import OutlierCapper
from sparkrisk.sources.files import path_exists
from sparkrisk.spec import DEFAULT_SPEC, FeatureSpec


def feature_pipeline(
    spec: FeatureSpec = DEFAULT_SPEC,
    include_illegal: bool = True,
    include_outliers: bool = True,
) -> Pipeline:
    """Illegal to mode, cap outliers, encode; the first two steps are optional."""
    stages = []
    if include_illegal:
        rules = {c: v for c, v in spec.rules.items() if c != spec.target}
        stages.append(IllegalToMode(rules=rules))
    if include_outliers:
        stages.append(OutlierCapper(columns=list(spec.outlier_columns)))
    stages.append(encoder_for(spec))
    return Pipeline(stages=stages)


def feature_names(fitted: PipelineModel) -> list[str]:
    """Encoded column names of a fitted feature pipeline."""
    encoders = [s for s in fitted.stages if isinstance(s, TableEncoderModel)]
    if not encoders:
        raise ValueError("the pipeline has no fitted encoder")
    return encoders[-1].feature_names


def prepare_features(
    train: DataFrame,
    test: DataFrame | None = None,
    spec: FeatureSpec = DEFAULT_SPEC,
    save_to: str | None = None,
) -> tuple[DataFrame, DataFrame | None, PipelineModel]:
    """Statistics from ``train`` only, the same projection on both tables."""
    fitted = feature_pipeline(spec).fit(train)
    if save_to:
        fitted.write().overwrite().save(save_to)
    return fitted.transform(train), None if test is None else fitted.transform(test), fitted


def preprocess(df: DataFrame, spec: FeatureSpec = DEFAULT_SPEC) -> DataFrame:
    """Encode one table with its own statistics, without the two cleaning steps."""
    return feature_pipeline(spec, include_illegal=False, include_outliers=False).fit(df).transform(df)


def load_preprocessor(spark, path: str) -> PipelineModel:
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no preprocessor at {path}")
    return PipelineModel.load(path)
