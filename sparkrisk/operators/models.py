"""Model registry and the model-side transformers."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LinearSVC, LinearSVCModel, LogisticRegression,
    MultilayerPerceptronClassifier, RandomForestClassifier,
)
from pyspark.ml.common import _py2java
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkrisk.operators.hinge import fit_hinge
from sparkrisk.operators.stages import make_param
from sparkrisk.spec import SEED

FEATURES, LABEL = "features", "label"


class FourierFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Random Fourier features of a Gaussian kernel exp(-gamma |x - y|^2).

    Inner products of the mapped vectors approach the kernel as ``width`` grows
    (Rahimi and Recht 2007), so a linear machine on them stands for a kernel machine
    whose cost is linear in the rows.
    """

    inputCol = make_param("inputCol", "vector column", TypeConverters.toString)
    outputCol = make_param("outputCol", "mapped vector column", TypeConverters.toString)
    inputSize = make_param("inputSize", "length of the input vector", TypeConverters.toInt)
    width = make_param("width", "number of Fourier features", TypeConverters.toInt)
    gamma = make_param("gamma", "kernel coefficient", TypeConverters.toFloat)
    seed = make_param("seed", "seed of the random directions", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol=FEATURES, outputCol="kernel_features", inputSize=1, width=256, gamma=1.0, seed=SEED):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol, inputSize=inputSize, width=width, gamma=gamma, seed=seed)

    def drawn(self) -> tuple[np.ndarray, np.ndarray]:
        """Random directions and shifts."""
        width = self.getOrDefault("width")
        draw = np.random.default_rng(self.getOrDefault("seed"))
        spread = math.sqrt(2.0 * self.getOrDefault("gamma"))
        directions = draw.normal(0.0, spread, (self.getOrDefault("inputSize"), width))
        return directions, draw.uniform(0.0, 2.0 * math.pi, width)

    def _transform(self, df: DataFrame) -> DataFrame:
        width = self.getOrDefault("width")
        directions, shifts = self.drawn()

        @F.arrow_udf(T.ArrayType(T.DoubleType()))
        def mapped(x: pa.Array) -> pa.Array:
            rows = np.asarray(x.flatten()).reshape(len(x), len(directions))
            z = math.sqrt(2.0 / width) * np.cos(rows @ directions + shifts)
            return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * width, pa.int32()), z.ravel())

        given = vector_to_array(F.col(self.getOrDefault("inputCol")))
        return df.withColumn(self.getOrDefault("outputCol"), array_to_vector(mapped(given)))


class KernelMachine(Estimator):
    """``machine`` on the features of ``mapped``, which are worked out in each pass and never kept; see :mod:`hinge`."""

    def __init__(self, mapped: FourierFeatures, machine: LinearSVC):
        super().__init__()
        self.mapped, self.machine = mapped, machine

    def _fit(self, df: DataFrame) -> PipelineModel:
        own = self.machine
        coefficients, intercept, _ = fit_hinge(
            df, self.mapped.getOrDefault("inputCol"), own.getLabelCol(), *self.mapped.drawn(),
            reg=own.getRegParam(), max_iter=own.getMaxIter(), tol=own.getTol())
        made = df.sparkSession._jvm.org.apache.spark.ml.classification.LinearSVCModel(
            own.uid, _py2java(df.sparkSession.sparkContext, Vectors.dense(coefficients)), intercept)
        return PipelineModel([self.mapped, own._copyValues(LinearSVCModel(made))])


class ScoreColumns(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """``y_pred``, ``y_score`` (decision value) and, if the model has it, ``y_proba``."""

    def __init__(self):
        super().__init__()

    def _transform(self, df: DataFrame) -> DataFrame:
        added = {"y_pred": F.col("prediction").cast("int")}
        if "rawPrediction" in df.columns:
            added["y_score"] = vector_to_array("rawPrediction")[1]
        if "probability" in df.columns:
            added["y_proba"] = vector_to_array("probability")[1]
        helpers = ("prediction", "rawPrediction", "probability", FEATURES, "kernel_features")
        return df.withColumns(added).drop(*helpers)


@dataclass(frozen=True)
class ModelEntry:
    """``build(n_rows, n_features)`` gives the configured estimator.

    Both counts are those of the table the model is fitted on, after resampling.
    """

    display_name: str
    build: Callable[[int, int], Estimator]


_COMMON = {"featuresCol": FEATURES, "labelCol": LABEL}


def _logistic(n_rows: int, n_features: int) -> Estimator:
    # sum of losses * C + |w|^2 / 2 with C = 1, expressed for a mean loss.
    return LogisticRegression(
        **_COMMON, maxIter=1000, tol=1e-8, regParam=1.0 / max(n_rows, 1), elasticNetParam=0.0, standardization=False,
    )


def _decision_tree(n_rows: int, n_features: int) -> Estimator:
    # There is no smallest node size to split; half of it as smallest leaf stands in.
    return DecisionTreeClassifier(**_COMMON, maxDepth=3, minInstancesPerNode=10, seed=SEED)


def _random_forest(n_rows: int, n_features: int) -> Estimator:
    return RandomForestClassifier(
        **_COMMON, numTrees=200, maxDepth=3, minInstancesPerNode=25, featureSubsetStrategy="sqrt", seed=SEED,
    )


def _kernel_svm(n_rows: int, n_features: int) -> Estimator:
    mapped = FourierFeatures(inputSize=n_features, gamma=1.0 / n_features, width=256)
    machine = LinearSVC(
        featuresCol="kernel_features", labelCol=LABEL, maxIter=100, standardization=False,
        regParam=1.0 / (10.0 * max(n_rows, 1)),
    )
    return KernelMachine(mapped, machine)


def _boosted_trees(n_rows: int, n_features: int) -> Estimator:
    return GBTClassifier(**_COMMON, maxIter=100, maxDepth=3, stepSize=0.01, subsamplingRate=0.7, seed=SEED)


def _perceptron(n_rows: int, n_features: int) -> Estimator:
    return MultilayerPerceptronClassifier(**_COMMON, layers=[n_features, 100, 2], maxIter=200, seed=SEED)


REGISTRY: dict[str, ModelEntry] = {
    "logistic_regression": ModelEntry("Logistic Regression", _logistic),
    "decision_tree": ModelEntry("Decision Tree", _decision_tree),
    "random_forest": ModelEntry("Random Forest", _random_forest),
    "svm": ModelEntry("Support Vector Machine", _kernel_svm),
    "xgboost": ModelEntry("XGBoost", _boosted_trees),
    "mlp": ModelEntry("Multilayer Perceptron", _perceptron),
}


def register_model(name: str, display_name: str, build: Callable[[int, int], Estimator]) -> None:
    REGISTRY[name] = ModelEntry(display_name, build)


def model_entry(name: str) -> ModelEntry:
    if name not in REGISTRY:
        raise ValueError(f"model {name!r} is not available; options: {list(REGISTRY)}")
    return REGISTRY[name]


def get_model(name: str, n_rows: int, n_features: int) -> Estimator:
    return model_entry(name).build(n_rows, n_features)
