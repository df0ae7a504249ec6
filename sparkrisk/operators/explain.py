"""Additive feature attributions of linear and boosted-tree models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkrisk.functions import ident
from sparkrisk.operators.sample import sample_rows
from sparkrisk.operators.stats import collect_stats
from sparkrisk.spec import SEED

LINEAR_BACKGROUND = 500


def background_means(
    df: DataFrame, names: Sequence[str], key: str, n: int = LINEAR_BACKGROUND, seed: int = SEED
) -> dict[str, float]:
    """Mean of every feature over a keyed sample of ``min(n, rows)`` rows."""
    rows = sample_rows(df.select(ident(key), *[ident(c) for c in names if c != key]), key, n, seed)
    return collect_stats(rows, {c: F.avg(ident(c)) for c in names})


def linear_scores(
    df: DataFrame, coefficients: Mapping[str, float], intercept: float, threshold: float = 0.5
) -> DataFrame:
    """Adds ``y_score`` (logit), ``y_proba`` and ``y_pred`` of a logistic model by one projection."""
    logit = F.lit(float(intercept))
    for c, w in coefficients.items():
        logit = logit + F.lit(float(w)) * ident(c).cast("double")
    return (
        df.withColumn("y_score", logit)
        .withColumn("y_proba", 1.0 / (1.0 + F.exp(-F.col("y_score"))))
        .withColumn("y_pred", (F.col("y_proba") > threshold).cast("int"))
    )


def linear_of(fitted: PipelineModel, names: Sequence[str]) -> tuple[dict[str, float], float]:
    """``(coefficients, intercept)`` of the linear model inside a fitted pipeline."""
    for stage in reversed(fitted.stages):
        if hasattr(stage, "coefficients") and hasattr(stage, "intercept"):
            return dict(zip(names, map(float, stage.coefficients.toArray()))), float(stage.intercept)
    raise ValueError("the pipeline has no linear model")


def linear_base(coefficients: Mapping[str, float], intercept: float, means: Mapping[str, float]) -> float:
    """Mean logit over the background."""
    return intercept + sum(w * means[c] for c, w in coefficients.items())


def linear_shap(
    df: DataFrame, coefficients: Mapping[str, float], means: Mapping[str, float], key: str
) -> DataFrame:
    """``key`` and one column per feature: weight times distance from the background mean."""
    return df.select(ident(key), *[
        (F.lit(float(w)) * (ident(c).cast("double") - F.lit(float(means[c])))).alias(c)
        for c, w in coefficients.items()
    ])


def linear_shap_long(
    df: DataFrame, coefficients: Mapping[str, float], means: Mapping[str, float], key: str
) -> DataFrame:
    """``(key, feature, value, shap)``, one row per cell, from the row itself (no join)."""
    return df.select(ident(key), F.inline(F.array(*[
        F.struct(
            F.lit(c).alias("feature"), ident(c).cast("double").alias("value"),
            (F.lit(float(w)) * (ident(c).cast("double") - F.lit(float(means[c])))).alias("shap"),
        )
        for c, w in coefficients.items()
    ])))


def shap_importance(long: DataFrame) -> DataFrame:
    """``(feature, importance)``: mean absolute attribution."""
    return long.groupBy("feature").agg(F.avg(F.abs("shap")).alias("importance"))


def best_feature(long: DataFrame) -> DataFrame:
    """``(feature)`` with the largest importance, the first name on ties."""
    return shap_importance(long).orderBy(F.desc("importance"), F.asc("feature")).limit(1).select("feature")


def shap_dependence(long: DataFrame) -> DataFrame:
    """``(key, value, shap)`` rows of the most important feature."""
    return long.where(F.col("feature") == best_feature(long).scalar()).drop("feature")


def shap_local(long: DataFrame, key: str, value, base: float) -> DataFrame:
    """``(feature, value, shap, base, output)`` of one row; base plus all attributions is the output."""
    row = long.where(ident(key) == value)
    total = F.sum("shap").over(Window.partitionBy(ident(key)))
    return row.select("feature", "value", "shap", F.lit(base).alias("base"), (total + base).alias("output"))


# -- boosted trees -----------------------------------------------------------


def boosted_trees_of(fitted):
    """The boosted-tree model inside a fitted pipeline, or the model itself."""
    if isinstance(fitted, PipelineModel):
        for stage in reversed(fitted.stages):
            found = boosted_trees_of(stage)
            if found is not None:
                return found
        return None
    return fitted if hasattr(fitted, "treeWeights") and hasattr(fitted, "trees") else None


def leaf_paths(model) -> list[dict]:
    """Every leaf of every tree: its weighted value and the conditions that lead to it.

    A condition is ``(feature, threshold, goes_left, share)``, ``share`` being the part
    of the node's training rows that went the same way. The list is bounded by the
    model (trees x leaves), not by any table.
    """
    leaves: list[dict] = []

    def walk(node, weight, path):
        if node.subtreeDepth() == 0:
            leaves.append({"value": weight * node.prediction(), "path": path})
            return
        split, rows = node.split(), node.impurityStats().count()
        for child, left in ((node.leftChild(), True), (node.rightChild(), False)):
            step = (split.featureIndex(), split.threshold(), left, child.impurityStats().count() / rows)
            walk(child, weight, [*path, step])

    for tree, weight in zip(model.trees, model.treeWeights):
        walk(tree._java_obj.rootNode(), weight, [])
    return leaves


def _leaf_games(leaves: Sequence[dict]) -> tuple[list, float]:
    """Conditions of each leaf grouped by feature, and the value expected without any feature."""
    games, expected = [], 0.0
    for leaf in leaves:
        tests: dict[int, list] = {}
        shares: dict[int, float] = {}
        for feature, threshold, left, share in leaf["path"]:
            tests.setdefault(feature, []).append((threshold, left))
            shares[feature] = shares.get(feature, 1.0) * share
        expected += leaf["value"] * float(np.prod(list(shares.values()))) if shares else leaf["value"]
        if tests:
            games.append((leaf["value"], tests, shares))
    return games, expected


@lru_cache(maxsize=None)
def _nodes(players: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and weights that integrate polynomials of lower degree than ``players`` over 0 to 1 exactly."""
    at, weight = np.polynomial.legendre.leggauss((players + 1) // 2)
    return (at + 1) / 2, weight / 2


#: Features of a path up to which the values of all its outcomes are worked out once.
_TABLED = 8


def _shapley(passes: np.ndarray, share: np.ndarray, value: float) -> np.ndarray:
    """Shapley values of one leaf game, a column for each feature, by the features' passed tests (a row for each feature).

    The sum over all sets of known features is the integral, over the chance t that a feature is known, of the product
    of the others' mean reach. Its polynomial has fewer degrees than there are features, so a few places give it
    exactly, and the work grows with the square of a path's features.
    """
    average = np.zeros_like(passes)
    for t, weight in zip(*_nodes(len(passes))):
        reach = passes * t + share * (1 - t)  # above zero, as shares are
        average += weight * reach.prod(axis=0) / reach
    return (value * (passes - share) * average).T


def _tabled(games: Sequence) -> list[tuple]:
    """Features, tests, value, shares and, for paths of few features, the values of all outcomes of the tests."""
    out = []
    for value, tests, shares in games:
        players = list(tests)
        share = np.array([[shares[f]] for f in players])
        table = None
        if len(players) <= _TABLED:
            outcomes = (np.arange(1 << len(players)) >> np.arange(len(players))[:, None] & 1).astype(float)
            table = np.ascontiguousarray(_shapley(outcomes, share, value).T)
        out.append((players, tests, value, share, table))
    return out


def _attributions(x: np.ndarray, games: Sequence) -> np.ndarray:
    """Shapley values of the leaf games: a known feature passes or fails its tests, an
    unknown one follows the leaf with the share of training rows that did.

    A row's values of a leaf depend on the outcomes of its tests only. Each test of any leaf is done once, and the
    values are looked up by the outcomes where there are few of these.
    """
    columns = np.ascontiguousarray(x.T)
    out = np.zeros_like(columns)
    done: dict[tuple, np.ndarray] = {}

    def passed(f: int, threshold: float, left: bool) -> np.ndarray:
        if (f, threshold, left) not in done:
            done[f, threshold, left] = columns[f] <= threshold if left else columns[f] > threshold
        return done[f, threshold, left]

    for players, tests, value, share, table in _tabled(games):
        passes = [np.logical_and.reduce([passed(f, *test) for test in tests[f]]) for f in players]
        if table is None:
            phi = _shapley(np.array(passes, dtype=float), share, value).T
        else:
            code = np.zeros(len(x), np.uint8)
            for k, own in enumerate(passes):
                code |= own.view(np.uint8) << np.uint8(k)
            code = code.astype(np.intp)
            phi = [own.take(code, mode="clip") for own in table]
        for f, own in zip(players, phi):
            out[f] += own
    return out.T


def tree_base(model) -> float:
    """Margin expected without knowing any feature."""
    return _leaf_games(leaf_paths(model))[1]


def _attributed(df: DataFrame, model, names: Sequence[str], key: str) -> tuple[DataFrame, float]:
    """Key and features with the array ``phi``; and the base value. ``model`` may be a list as of :func:`leaf_paths`."""
    games, base = _leaf_games(model if isinstance(model, list) else leaf_paths(model))

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def attribute(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=object)
        return pd.Series(list(_attributions(np.stack(x.to_numpy()), games)))

    given = F.array(*[ident(c).cast("double") for c in names])
    return df.select(ident(key), *[ident(c) for c in names], attribute(given).alias("phi")), base


def tree_shap(df: DataFrame, model, names: Sequence[str], key: str) -> DataFrame:
    """``key``, one attribution column per feature, and ``margin``.

    ``df`` holds the encoded features; ``model`` is a fitted model or the list of its leaves, as of :func:`leaf_paths`.
    The values are exact, and their work grows with the square of the features on a path.
    """
    values, base = _attributed(df, model, names, key)
    margin = F.aggregate("phi", F.lit(float(base)), lambda a, v: a + v)
    return values.select(
        ident(key), *[F.col("phi")[j].alias(c) for j, c in enumerate(names)], margin.alias("margin")
    )


def tree_shap_long(df: DataFrame, model, names: Sequence[str], key: str) -> DataFrame:
    """``(key, feature, value, shap)`` of :func:`tree_shap`."""
    values, _ = _attributed(df, model, names, key)
    return values.select(ident(key), F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), ident(c).cast("double").alias("value"), F.col("phi")[j].alias("shap"))
        for j, c in enumerate(names)
    ])))


def importance_of(fitted, names: Sequence[str], spark) -> DataFrame:
    """``(feature, importance)`` of a fitted model: tree importances or absolute weights."""
    if isinstance(fitted, PipelineModel):
        for stage in reversed(fitted.stages):
            if hasattr(stage, "featureImportances") or hasattr(stage, "coefficients"):
                return importance_of(stage, names, spark)
        raise ValueError("the model has neither importances nor coefficients")
    weights = fitted.featureImportances if hasattr(fitted, "featureImportances") else fitted.coefficients
    pairs = [(n, abs(float(w))) for n, w in zip(names, weights.toArray())]
    return spark.createDataFrame(pairs, "feature string, importance double")
