"""Attributions of a fixed logistic model and of fitted boosted trees."""

from pyspark.sql import functions as F

from sparkrisk.catalog.modelling import COEFFICIENTS, INTERCEPT, SPEC
from sparkrisk.catalog.tables import LABELLED, labelled, modelling, rounded
from sparkrisk.operators import explain
from sparkrisk.plans import train
from sparkrisk.plans.features import feature_names

_NAMES = list(COEFFICIENTS)
# The attributions are exact decimals; fewer digits would round ties.
_DIGITS = 10


def _means(df):
    return explain.background_means(df, _NAMES, "event_id")


def _long(spark, folder):
    df = labelled(spark, folder)
    return explain.linear_shap_long(df, COEFFICIENTS, _means(df), "event_id")


def linear_shap(spark, folder):
    df = labelled(spark, folder)
    return rounded(explain.linear_shap(df, COEFFICIENTS, _means(df), "event_id"), _DIGITS)


def shap_local(spark, folder):
    """The first row in key order."""
    df = labelled(spark, folder)
    means = _means(df)
    first = df.agg(F.min("event_id")).first()[0]
    long = explain.linear_shap_long(df, COEFFICIENTS, means, "event_id")
    return rounded(explain.shap_local(long, "event_id", first, explain.linear_base(COEFFICIENTS, INTERCEPT, means)), _DIGITS)


def tree_shap(spark, folder):
    """Attributions of every event to the encoded features of the boosted trees."""
    df = modelling(spark, folder)
    fitted, _ = train.train(df, "event_id", SPEC, "xgboost", sampler=None, evaluate=False)
    prepared = fitted.stages[0]
    return explain.tree_shap(prepared.transform(df), explain.boosted_trees_of(fitted), feature_names(prepared), "event_id")


#: Two trees over ``value`` and ``visitor``: (feature, threshold, goes left, share of the rows) for each step to a leaf.
LEAVES = [
    {"value": 1.0, "path": [(0, 40.0, True, 0.25)]},
    {"value": -2.0, "path": [(0, 40.0, False, 0.75), (1, 30.0, True, 0.5)]},
    {"value": 4.0, "path": [(0, 40.0, False, 0.75), (1, 30.0, False, 0.5)]},
    {"value": 0.5, "path": [(1, 60.0, True, 0.5), (0, 80.0, True, 0.5), (1, 20.0, False, 0.5)]},
]


def tree_shap_fixed(spark, folder):
    """Attributions of every event by trees written by hand."""
    return rounded(explain.tree_shap(labelled(spark, folder), LEAVES, _NAMES, "event_id"), _DIGITS)


QUERIES = {
    "linear_shap": linear_shap,
    "shap_long": lambda s, d: rounded(_long(s, d), _DIGITS),
    "shap_importance": lambda s, d: rounded(explain.shap_importance(_long(s, d)), _DIGITS),
    "shap_dependence": lambda s, d: rounded(explain.shap_dependence(_long(s, d)), _DIGITS),
    "shap_local": shap_local,
    "tree_shap": tree_shap,
    "tree_shap_fixed": tree_shap_fixed,
}

_BASE = f"""{LABELLED},
  background AS (SELECT * FROM labelled ORDER BY md5('42|' || CAST(event_id AS VARCHAR)) LIMIT 500),
  means AS (SELECT AVG(value) AS value, AVG(visitor) AS visitor FROM background),
  long AS (SELECT l.event_id, 'value' AS feature, l.value AS value, 0.0625::DOUBLE * (l.value - m.value) AS shap
           FROM labelled l, means m
           UNION ALL SELECT l.event_id, 'visitor', l.visitor, -0.03125::DOUBLE * (l.visitor - m.visitor)
           FROM labelled l, means m),
  importance AS (SELECT feature, AVG(ABS(shap)) AS importance FROM long GROUP BY feature)"""
_TESTS = """CAST(value <= 40 AS INTEGER) AS low, CAST(visitor <= 30 AS INTEGER) AS few, CAST(value <= 80 AS INTEGER) AS mid,
    CAST(visitor > 20 AND visitor <= 60 AS INTEGER) AS between_"""
# Each leaf with two features gives one of them: value * (passes - share) * (other passes + other share) / 2.
_BY_VALUE = """1.0::DOUBLE * (low - 0.25) - 2.0::DOUBLE * (0.25 - low) * (few + 0.5) / 2 + 4.0::DOUBLE * (0.25 - low) * (1.5 - few) / 2
    + 0.5::DOUBLE * (mid - 0.5) * (between_ + 0.25) / 2"""
_BY_VISITOR = """-2.0::DOUBLE * (few - 0.5) * (1.75 - low) / 2 + 4.0::DOUBLE * (0.5 - few) * (1.75 - low) / 2
    + 0.5::DOUBLE * (between_ - 0.25) * (mid + 0.5) / 2"""
# Expected without any feature: the leaves' values by their shares.
_EXPECTED = 1.0 * 0.25 - 2.0 * 0.375 + 4.0 * 0.375 + 0.5 * 0.125
_CELL = f"ROUND(value, {_DIGITS}) AS value, ROUND(shap, {_DIGITS}) + 0.0 AS shap"
SQL = {
    "linear_shap": f"""WITH {_BASE} SELECT event_id, ROUND(0.0625::DOUBLE * (l.value - m.value), {_DIGITS}) + 0.0 AS value,
      ROUND(-0.03125::DOUBLE * (l.visitor - m.visitor), {_DIGITS}) + 0.0 AS visitor FROM labelled l, means m""",
    "tree_shap_fixed": f"""WITH {_BASE}, tested AS (SELECT event_id, {_TESTS} FROM labelled)
      SELECT event_id, ROUND({_BY_VALUE}, {_DIGITS}) + 0.0 AS value, ROUND({_BY_VISITOR}, {_DIGITS}) + 0.0 AS visitor,
      ROUND({_BY_VALUE} + {_BY_VISITOR} + {_EXPECTED}, {_DIGITS}) + 0.0 AS margin FROM tested""",
    "shap_long": f"WITH {_BASE} SELECT event_id, feature, {_CELL} FROM long",
    "shap_importance": f"WITH {_BASE} SELECT feature, ROUND(importance, {_DIGITS}) AS importance FROM importance",
    "shap_dependence": f"""WITH {_BASE} SELECT event_id, {_CELL} FROM long
      WHERE feature = (SELECT feature FROM importance ORDER BY importance DESC, feature LIMIT 1)""",
    "shap_local": f"""WITH {_BASE}, base AS (SELECT -0.25::DOUBLE + 0.0625::DOUBLE * value - 0.03125::DOUBLE * visitor AS b FROM means)
      SELECT feature, {_CELL}, ROUND(b, {_DIGITS}) AS base, ROUND(b + SUM(shap) OVER (), {_DIGITS}) AS output
      FROM long, base WHERE event_id = (SELECT MIN(event_id) FROM labelled)""",
}
