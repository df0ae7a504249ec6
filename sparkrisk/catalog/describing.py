"""Descriptive statistics and plot data."""

from pyspark.sql import functions as F

from sparkrisk.catalog.tables import load, mixed, MIXED, rounded
from sparkrisk.operators import describe

_COLUMNS = ["quantity", "price", "line", "tax"]


def correlation(spark, folder):
    df = mixed(spark, folder).withColumn("constant", F.lit(7.0))
    return rounded(describe.correlation(df, [*_COLUMNS, "constant"]))


def histogram(spark, folder):
    df = mixed(spark, folder).withColumn("constant", F.lit(7.0))
    return rounded(describe.histogram(df, [*_COLUMNS, "constant"]))


def box_stats(spark, folder):
    events = load(spark, folder, "events").select("value", "user_id", "event_type")
    return rounded(describe.box_stats(events, ["value", "user_id", "event_type"]))


def box_fliers(spark, folder):
    lines = load(spark, folder, "lineitem").select("l_extendedprice", "l_quantity")
    p = F.col("l_extendedprice") / 10000.0
    return rounded(describe.box_fliers(lines.withColumn("l_extendedprice", p * p * p * p), ["l_extendedprice", "l_quantity"]))


QUERIES = {
    "describe": lambda s, d: rounded(describe.describe(mixed(s, d), _COLUMNS)),
    "describe_filtered": lambda s, d: rounded(describe.describe(
        load(s, d, "orders"), ["o_totalprice"], where=F.col("o_totalprice") < 200000)),
    "histogram": histogram,
    "box_stats": box_stats,
    "box_fliers": box_fliers,
    "category_histogram": lambda s, d: describe.category_histogram(mixed(s, d), ["flag", "status", "line"]),
    "correlation": correlation,
}


def _describe(column, table, where="TRUE"):
    v = f"CAST({column} AS DOUBLE)"
    return f"""SELECT '{column}' AS "column", COUNT({column}) AS count, ROUND(AVG({v}), 6) AS mean,
      ROUND(STDDEV_SAMP({v}), 6) AS std, ROUND(MIN({v}), 6) AS min, ROUND(quantile_cont({v}, 0.25), 6) AS q25,
      ROUND(quantile_cont({v}, 0.5), 6) AS q50, ROUND(quantile_cont({v}, 0.75), 6) AS q75, ROUND(MAX({v}), 6) AS max
      FROM {table} WHERE {where}"""


def _histogram(column):
    v = f"CAST({column} AS DOUBLE)"
    return f"""SELECT '{column}' AS "column", bin, ROUND(lo + bin * (hi - lo) / 30, 6) AS "left",
        ROUND(lo + (bin + 1) * (hi - lo) / 30, 6) AS "right", COUNT(*) AS n
      FROM (SELECT lo, hi, LEAST(CAST(FLOOR(({v} - lo) / (hi - lo) * 30) AS BIGINT), 29) AS bin
            FROM wide, (SELECT CASE WHEN a = b THEN a - 0.5 ELSE a END AS lo, CASE WHEN a = b THEN b + 0.5 ELSE b END AS hi
                        FROM (SELECT MIN({v}) AS a, MAX({v}) AS b FROM wide)) WHERE {column} IS NOT NULL)
      GROUP BY bin, lo, hi"""


def _box(column):
    v = f"CAST({column} AS DOUBLE)"
    return f"""SELECT '{column}' AS "column", ROUND(MAX(q1), 6) AS q1, ROUND(MAX(q2), 6) AS median, ROUND(MAX(q3), 6) AS q3,
      ROUND(LEAST(MAX(q1), MIN(CASE WHEN {v} BETWEEN lo AND hi THEN {v} END)), 6) AS whisker_low,
      ROUND(GREATEST(MAX(q3), MAX(CASE WHEN {v} BETWEEN lo AND hi THEN {v} END)), 6) AS whisker_high,
      COUNT(CASE WHEN {v} < lo OR {v} > hi THEN 1 END) AS fliers
      FROM events, (SELECT q1, q2, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM
        (SELECT quantile_cont({v}, 0.25) AS q1, quantile_cont({v}, 0.5) AS q2, quantile_cont({v}, 0.75) AS q3 FROM events))"""


def _pair(x, y):
    both = f"{x} IS NOT NULL AND {y} IS NOT NULL"
    a, b = f"CAST({x} AS DOUBLE)", f"CAST({y} AS DOUBLE)"
    return f"""SELECT '{x}' AS x, '{y}' AS y, CASE WHEN STDDEV_POP({a}) = 0 OR STDDEV_POP({b}) = 0 THEN NULL
      ELSE ROUND(COVAR_POP({a}, {b}) / (STDDEV_POP({a}) * STDDEV_POP({b})), 6) END AS r FROM wide WHERE {both}"""


_ALL = [*_COLUMNS, "constant"]
_WIDE = "wide AS (SELECT *, 7.0::DOUBLE AS constant FROM mixed)"
SQL = {
    "describe": f"WITH {MIXED} " + " UNION ALL ".join(_describe(c, "mixed") for c in _COLUMNS),
    "describe_filtered": _describe("o_totalprice", "orders", "o_totalprice < 200000"),
    "histogram": f"WITH {MIXED}, {_WIDE} " + " UNION ALL ".join(_histogram(c) for c in _ALL),
    "box_stats": " UNION ALL ".join(_box(c) for c in ("value", "user_id")),
    "box_fliers": """WITH p AS (SELECT l_extendedprice / 10000.0::DOUBLE AS p, l_quantity FROM lineitem),
      v AS (SELECT p * p * p * p AS price, CAST(l_quantity AS DOUBLE) AS quantity FROM p),
      q AS (SELECT quantile_cont(price, 0.25) AS a, quantile_cont(price, 0.75) AS b,
                   quantile_cont(quantity, 0.25) AS c, quantile_cont(quantity, 0.75) AS d FROM v)
      SELECT 'l_extendedprice' AS "column", ROUND(price, 6) AS value FROM v, q WHERE price < a - 1.5 * (b - a) OR price > b + 1.5 * (b - a)
      UNION ALL SELECT 'l_quantity', ROUND(quantity, 6) FROM v, q WHERE quantity < c - 1.5 * (d - c) OR quantity > d + 1.5 * (d - c)""",
    "category_histogram": f"WITH {MIXED} " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, COUNT(*) AS n FROM mixed WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in ("flag", "status", "line")),
    "correlation": f"WITH {MIXED}, {_WIDE} " + " UNION ALL ".join(_pair(x, y) for x in _ALL for y in _ALL),
}
