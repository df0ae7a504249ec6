"""Models whose fit is a few aggregates: fixed coefficients, and a threshold between class means."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrisk.operators.explain import linear_scores
from sparkrisk.operators.models import FEATURES, LABEL
from sparkrisk.operators.stages import FitFirst, Learned, TypeConverters, keyword_only, make_param


class LogisticScorer(Learned):
    """A logistic model with given coefficients over named columns: ``y_score``, ``y_proba``, ``y_pred``."""

    @classmethod
    def of(cls, coefficients: Mapping[str, float], intercept: float, threshold: float = 0.5) -> LogisticScorer:
        return cls({"coefficients": dict(coefficients), "intercept": float(intercept), "threshold": float(threshold)})

    def _transform(self, df: DataFrame) -> DataFrame:
        return linear_scores(df, self.learned["coefficients"], self.learned["intercept"], self.learned["threshold"])


class ClassMeans(FitFirst):
    """Splits one feature half way between the means of the two classes."""

    feature = make_param("feature", "position in the feature vector", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, feature=0):
        super().__init__()
        self._set(feature=feature)

    def _fit(self, df: DataFrame) -> ClassMeansModel:
        at = self.getOrDefault("feature")
        value = vector_to_array(FEATURES)[at]
        low, high = df.agg(*[F.avg(F.when(F.col(LABEL) == k, value)) for k in (0, 1)]).first()
        if low is None or high is None:
            raise ValueError("both classes are needed")
        return ClassMeansModel({"feature": at, "middle": (low + high) / 2, "rising": high >= low})


class ClassMeansModel(Learned):
    """The distance from the middle, towards the mean of class 1, is the decision value."""

    def _transform(self, df: DataFrame) -> DataFrame:
        off = vector_to_array(FEATURES)[self.learned["feature"]] - self.learned["middle"]
        margin = off if self.learned["rising"] else -off
        return df.withColumn("rawPrediction", array_to_vector(F.array(-margin, margin))).withColumn(
            "prediction", (margin > 0).cast("double"))
