"""Shared parts of the fitted operators."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable

__all__ = ["FitFirst", "Learned", "Param", "TypeConverters", "keyword_only", "make_param"]


def make_param(name: str, doc: str, converter=TypeConverters.identity) -> Param:
    return Param(Params._dummy(), name, doc, converter)


class FitFirst(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """An estimator whose own ``transform`` says that it has to be fitted first."""

    def transform(self, dataset, params=None):
        raise RuntimeError(f"{type(self).__name__} is not fitted; call fit() first")


class Learned(Model, DefaultParamsReadable, DefaultParamsWritable):
    """A model whose learned state is one JSON-able param, saved with the metadata."""

    state = make_param("state", "what fit() learned")

    def __init__(self, state=None):
        super().__init__()
        if state is not None:
            self._set(state=state)

    @property
    def learned(self):
        return self.getOrDefault("state")
