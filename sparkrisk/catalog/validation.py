"""Domain rules and imputation."""

from sparkrisk.catalog.tables import MIXED, RULED, RULES, mixed, rounded, ruled
from sparkrisk.operators import clean, profile
from sparkrisk.operators.impute import IllegalToMode, MissingFill


def _modes_table(spark, model):
    return spark.createDataFrame(
        [(c, str(v)) for c, v in model.modes.items()], "column string, mode string")


def mode_fit(spark, folder):
    return _modes_table(spark, IllegalToMode(rules=RULES).fit(ruled(spark, folder)))


def mode_impute(spark, folder):
    df = ruled(spark, folder)
    return IllegalToMode(rules=RULES).fit(df).transform(df)


def mode_impute_report(spark, folder):
    df = ruled(spark, folder)
    return IllegalToMode(rules=RULES).fit(df).report(df)


def mode_impute_all(spark, folder):
    df = ruled(spark, folder)
    return IllegalToMode(rules=RULES, modeOver="all").fit(df).transform(df)


def median_impute(spark, folder):
    df = mixed(spark, folder)
    filled = MissingFill(median=["quantity", "price"]).fit(df).transform(df)
    return rounded(filled.withColumn("line", filled["line"].cast("double")))


def most_frequent_impute(spark, folder):
    df = mixed(spark, folder)
    return rounded(MissingFill(mode=["flag", "line"]).fit(df).transform(df))


QUERIES = {
    "rule_report": lambda s, d: rounded(profile.rule_report(ruled(s, d), RULES)),
    "rule_filter": lambda s, d: clean.filter_by_rules(ruled(s, d), RULES),
    "rule_filter_report": lambda s, d: rounded(clean.rule_filter_report(ruled(s, d), RULES)),
    "mode_fit": mode_fit,
    "mode_impute": mode_impute,
    "mode_impute_report": mode_impute_report,
    "mode_impute_all": mode_impute_all,
    "median_impute": median_impute,
    "most_frequent_impute": most_frequent_impute,
}

_LEGAL = {
    "line": "COALESCE(line IN (2, 3, 4, 5), FALSE)",
    "quantity": "COALESCE(quantity IN (" + ", ".join(str(q) for q in range(1, 41)) + "), FALSE)",
    "flag": "COALESCE(flag IN ('A', 'N'), FALSE)",
}


def _mode(column, table, where="TRUE"):
    return (f"(SELECT {column} FROM {table} WHERE {column} IS NOT NULL AND {where} "
            f"GROUP BY {column} ORDER BY COUNT(*) DESC, {column} LIMIT 1)")


def _rule_row(column):
    text = "in (" + ", ".join(str(v) for v in RULES[column]) + ")"
    bad = f"COUNT(CASE WHEN NOT {_LEGAL[column]} THEN 1 END)"
    return (f"SELECT '{column}' AS \"column\", '{text}' AS rule, {bad} AS invalid, "
            f"ROUND(100.0 * CAST({bad} AS DOUBLE) / COUNT(*), 2) AS pct FROM ruled")


def _imputed(legal_only):
    return "SELECT l_orderkey, l_partkey, " + ", ".join(
        f"CASE WHEN {test} THEN {c} ELSE {_mode(c, 'ruled', test if legal_only else 'TRUE')} END AS {c}"
        for c, test in _LEGAL.items()) + " FROM ruled"


_ALL_LEGAL = " AND ".join(_LEGAL.values())
SQL = {
    "rule_report": f"WITH {RULED}, report AS (" + " UNION ALL ".join(_rule_row(c) for c in RULES) + """)
      SELECT * FROM report UNION ALL SELECT 'TOTAL', NULL, CAST(SUM(invalid) AS BIGINT), NULL FROM report""",
    "rule_filter": f"WITH {RULED} SELECT * FROM ruled WHERE {_ALL_LEGAL}",
    "rule_filter_report": f"""WITH {RULED}, n AS (SELECT COUNT(*) AS rows_before,
        COUNT(CASE WHEN {_ALL_LEGAL} THEN 1 END) AS rows_left FROM ruled)
      SELECT rows_before, rows_left, rows_before - rows_left AS rows_removed,
             ROUND(100.0 * CAST(rows_before - rows_left AS DOUBLE) / rows_before, 2) AS pct_removed FROM n""",
    "mode_fit": f"WITH {RULED} " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({_mode(c, 'ruled', t)} AS VARCHAR) AS mode" for c, t in _LEGAL.items()),
    "mode_impute": f"WITH {RULED} {_imputed(True)}",
    "mode_impute_report": f"WITH {RULED} " + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST({_mode(c, 'ruled', t)} AS VARCHAR) AS fill,
            COUNT(CASE WHEN NOT {t} THEN 1 END) AS imputed FROM ruled""" for c, t in _LEGAL.items()),
    "mode_impute_all": f"WITH {RULED} {_imputed(False)}",
    "median_impute": f"""WITH {MIXED} SELECT l_orderkey, l_partkey,
      ROUND(COALESCE(quantity, (SELECT quantile_cont(quantity, 0.5) FROM mixed)), 6) AS quantity,
      ROUND(COALESCE(price, (SELECT quantile_cont(price, 0.5) FROM mixed)), 6) AS price,
      flag, status, CAST(line AS DOUBLE) AS line, ROUND(tax, 6) AS tax FROM mixed""",
    "most_frequent_impute": f"""WITH {MIXED} SELECT l_orderkey, l_partkey, ROUND(quantity, 6) AS quantity,
      ROUND(price, 6) AS price, COALESCE(flag, {_mode('flag', 'mixed')}) AS flag, status,
      COALESCE(line, {_mode('line', 'mixed')}) AS line, ROUND(tax, 6) AS tax FROM mixed""",
}
