"""Outlier limits, capping, detection, removal, replacement."""

from sparkrisk.catalog.tables import labelled, load, rounded
from sparkrisk.operators import outliers

_COLUMNS = ["l_extendedprice", "l_quantity", "l_tax"]


def iqr_limits(spark, folder):
    df = load(spark, folder, "lineitem")
    return rounded(outliers.limits_table(df, outliers.limits(df, _COLUMNS)))


def percentile_limits(spark, folder):
    df = load(spark, folder, "lineitem")
    return rounded(outliers.limits_table(df, outliers.limits(df, _COLUMNS, "Percentiles")))


def _events(spark, folder):
    return labelled(spark, folder).select("event_id", "value", "visitor")


def cap_outliers(spark, folder):
    df = _events(spark, folder)
    return rounded(outliers.OutlierCapper(columns=["value", "visitor"]).fit(df).transform(df))


def cap_report(spark, folder):
    df = _events(spark, folder)
    return rounded(outliers.OutlierCapper(columns=["value", "visitor"]).fit(df).report(df))


def cap_percentiles(spark, folder):
    df = _events(spark, folder)
    capper = outliers.OutlierCapper(columns=["value", "visitor"], method="Percentiles")
    return rounded(capper.fit(df).transform(df))


def detect_outliers(spark, folder):
    documents = load(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    return outliers.detect_outliers(documents, "n_chars")


def cascade(spark, folder):
    return rounded(outliers.remove_outliers(_events(spark, folder), ["value", "visitor"])[0])


def cascade_report(spark, folder):
    df = _events(spark, folder)
    return rounded(outliers.removal_report(df, outliers.remove_outliers(df, ["value", "visitor"])[1]))


QUERIES = {
    "iqr_limits": iqr_limits,
    "percentile_limits": percentile_limits,
    "cap_outliers": cap_outliers,
    "cap_outliers_percentiles": cap_percentiles,
    "cap_report": cap_report,
    "detect_outliers": detect_outliers,
    "outlier_report": lambda s, d: rounded(outliers.outlier_report(_events(s, d), ["value", "visitor"])),
    "remove_outliers_cascade": cascade,
    "remove_outliers_report": cascade_report,
    "outliers_to_mean": lambda s, d: rounded(outliers.outliers_to_mean(_events(s, d), ["value", "visitor"])),
}

_EVENTS = "t AS (SELECT event_id, value, CAST(user_id AS DOUBLE) AS visitor FROM events)"


def _quartiles(column, table):
    return (f"SELECT quantile_cont(CAST({column} AS DOUBLE), 0.25) AS q1, "
            f"quantile_cont(CAST({column} AS DOUBLE), 0.75) AS q3 FROM {table}")


def _iqr(name, column, table):
    return (f"{name} AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi "
            f"FROM ({_quartiles(column, table)}))")


def _percentiles(name, column, table):
    return (f"{name} AS (SELECT quantile_cont({column}, 0.05) AS lo, quantile_cont({column}, 0.95) AS hi FROM {table})")


def _capped(column, bounds):
    return (f"ROUND(CASE WHEN {column} < {bounds}.lo THEN {bounds}.lo WHEN {column} > {bounds}.hi "
            f"THEN {bounds}.hi ELSE {column} END, 6) AS {column}")


def _outside(column, bounds):
    return f"({column} < {bounds}.lo OR {column} > {bounds}.hi)"


_CAPPED = f"SELECT event_id, {_capped('value', 'a')}, {_capped('visitor', 'b')} FROM t, a, b"
_BOTH = f"WITH {_EVENTS}, {_iqr('a', 'value', 't')}, {_iqr('b', 'visitor', 't')}"
_STEPS = (f"WITH {_EVENTS}, {_iqr('a', 'value', 't')}, "
          f"u AS (SELECT t.* FROM t, a WHERE value BETWEEN a.lo AND a.hi), {_iqr('b', 'visitor', 'u')}, "
          f"v AS (SELECT u.* FROM u, b WHERE visitor BETWEEN b.lo AND b.hi)")

SQL = {
    "iqr_limits": "WITH " + ", ".join(_iqr(f"b{i}", c, "lineitem") for i, c in enumerate(_COLUMNS)) + " " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", ROUND(lo, 6) AS lower, ROUND(hi, 6) AS upper FROM b{i}" for i, c in enumerate(_COLUMNS)),
    "percentile_limits": "WITH " + ", ".join(_percentiles(f"b{i}", c, "lineitem") for i, c in enumerate(_COLUMNS)) + " " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", ROUND(lo, 6) AS lower, ROUND(hi, 6) AS upper FROM b{i}" for i, c in enumerate(_COLUMNS)),
    "cap_outliers": f"{_BOTH} {_CAPPED}",
    "cap_outliers_percentiles": f"WITH {_EVENTS}, {_percentiles('a', 'value', 't')}, {_percentiles('b', 'visitor', 't')} {_CAPPED}",
    "cap_report": _BOTH + " " + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", ROUND(MAX({b}.lo), 6) AS lower, ROUND(MAX({b}.hi), 6) AS upper,
            COUNT(CASE WHEN {_outside(c, b)} THEN 1 END) AS capped FROM t, {b}""" for c, b in (("value", "a"), ("visitor", "b"))),
    "detect_outliers": f"WITH {_iqr('b', 'n_chars', 'documents')} SELECT doc_id, lang, n_chars FROM documents, b WHERE {_outside('n_chars', 'b')}",
    "outlier_report": _BOTH + ", r AS (" + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", COUNT(CASE WHEN {_outside(c, b)} THEN 1 END) AS outliers,
            ROUND(100.0 * CAST(COUNT(CASE WHEN {_outside(c, b)} THEN 1 END) AS DOUBLE) / COUNT(*), 2) AS pct
            FROM t, {b}""" for c, b in (("value", "a"), ("visitor", "b"))) +
        ") SELECT * FROM r UNION ALL SELECT 'TOTAL', CAST(SUM(outliers) AS BIGINT), NULL FROM r",
    "remove_outliers_cascade": _STEPS + " SELECT event_id, ROUND(value, 6) AS value, visitor FROM v",
    "remove_outliers_report": _STEPS + """ SELECT 'value' AS "column", CAST(1 AS BIGINT) AS step,
        (SELECT COUNT(*) FROM u) AS rows_left,
        ROUND(100.0 * CAST((SELECT COUNT(*) FROM u) AS DOUBLE) / (SELECT COUNT(*) FROM t), 2) AS pct_left
      UNION ALL SELECT 'visitor', CAST(2 AS BIGINT), (SELECT COUNT(*) FROM v),
        ROUND(100.0 * CAST((SELECT COUNT(*) FROM v) AS DOUBLE) / (SELECT COUNT(*) FROM t), 2)""",
    "outliers_to_mean": f"""{_BOTH},
      ma AS (SELECT AVG(value) AS m FROM t, a WHERE NOT {_outside('value', 'a')}),
      mb AS (SELECT AVG(visitor) AS m FROM t, b WHERE NOT {_outside('visitor', 'b')})
      SELECT event_id, ROUND(CASE WHEN {_outside('value', 'a')} THEN ma.m ELSE value END, 6) AS value,
             ROUND(CASE WHEN {_outside('visitor', 'b')} THEN mb.m ELSE visitor END, 6) AS visitor FROM t, a, b, ma, mb""",
}
