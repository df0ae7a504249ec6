"""Tabular binary-classification toolkit expressed as Spark DataFrame operators."""

from sparkrisk.spec import DEFAULT_SPEC, FeatureSpec

__all__ = ["DEFAULT_SPEC", "FeatureSpec"]
