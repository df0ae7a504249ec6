"""Sources, profiling and cleaning."""

from pyspark.sql import functions as F

from sparkrisk.catalog.tables import RAW, load, raw, rounded
from sparkrisk.operators import clean, profile
from sparkrisk.plans.prepare import load_and_prepare
from sparkrisk.session import scratch_path
from sparkrisk.sources.files import read_delimited, write_delimited


def _raw_csv(spark, folder):
    path = scratch_path(spark, "raw-csv")
    write_delimited(raw(spark, folder), path)
    return path


def csv_scan_strings(spark, folder):
    return read_delimited(spark, _raw_csv(spark, folder))


def prepare_job(spark, folder):
    return rounded(load_and_prepare(spark, _raw_csv(spark, folder), key="event_id"))


def prepare_job_keyless(spark, folder):
    """A file without a key, a third of whose rows are equal."""
    one = F.col("event_id") % 3 == 0
    rows = raw(spark, folder).select(
        F.when(one, "1.5").otherwise(F.col("reading")).alias("reading"), F.when(one, "7").otherwise(F.col("visitor")).alias("visitor"),
        F.when(one, "0").otherwise(F.col("kredit")).alias("kredit"), "mixed_type_col")
    path = scratch_path(spark, "keyless-csv")
    write_delimited(rows, path)
    return rounded(load_and_prepare(spark, path))


def shape_before_after(spark, folder):
    before = raw(spark, folder)
    return profile.table_shape(before, "before").unionByName(profile.table_shape(clean.clean(before), "after"))


def separated(spark, folder):
    """Both tables, paired again by their key."""
    features, target = clean.separate_target(clean.clean(raw(spark, folder)), key="event_id")
    return rounded(features.join(target, "event_id"))


QUERIES = {
    "csv_scan_strings": csv_scan_strings,
    "prepare_job": prepare_job,
    "prepare_job_keyless": prepare_job_keyless,
    "profile": lambda s, d: profile.table_profile(raw(s, d)),
    "preview": lambda s, d: profile.preview(load(s, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), "o_orderkey"),
    "value_counts": lambda s, d: profile.value_counts(load(s, d, "events"), "event_type"),
    "value_shares": lambda s, d: rounded(profile.value_shares(load(s, d, "events"), "event_type")),
    "non_numeric_tally": lambda s, d: profile.dirty_tally(raw(s, d)),
    "dirty_tokens": lambda s, d: profile.dirty_tokens(raw(s, d), exclude=["mixed_type_col"]),
    "replace_tokens": lambda s, d: clean.replace_tokens(
        raw(s, d), profile.dirty_tokens(raw(s, d), exclude=["mixed_type_col"])),
    "coerce_numeric": lambda s, d: rounded(clean.coerce_numeric(raw(s, d))),
    "null_counts": lambda s, d: profile.null_counts(clean.coerce_numeric(raw(s, d))),
    "drop_column": lambda s, d: clean.drop_column(raw(s, d), "mixed_type_col"),
    "valid_target": lambda s, d: rounded(clean.valid_target(clean.coerce_numeric(raw(s, d)))),
    "clean_report": lambda s, d: clean.clean_report(raw(s, d)),
    "clean_pipeline": lambda s, d: rounded(clean.clean(raw(s, d))),
    "separate_target": separated,
    "rename_columns": lambda s, d: clean.rename_columns(
        load(s, d, "customer"), {"c_custkey": "customer_id", "c_acctbal": "balance", "absent": "x"}),
    "complete_cases": lambda s, d: rounded(clean.complete_cases(clean.coerce_numeric(raw(s, d)))),
    "shape_report": shape_before_after,
}

_COERCED = """coerced AS (
  SELECT CAST(event_id AS DOUBLE) AS event_id, ROUND(TRY_CAST(reading AS DOUBLE), 6) AS reading,
         TRY_CAST(visitor AS DOUBLE) AS visitor, TRY_CAST(kredit AS DOUBLE) AS kredit, mixed_type_col
  FROM raw)"""
_CELLS = """cells AS (
  SELECT 'reading' AS "column", reading AS value FROM raw
  UNION ALL SELECT 'visitor', visitor FROM raw
  UNION ALL SELECT 'kredit', kredit FROM raw
  UNION ALL SELECT 'mixed_type_col', mixed_type_col FROM raw)"""
_CLEANED = "SELECT event_id, reading, visitor, CAST(kredit AS INTEGER) AS kredit FROM coerced WHERE kredit IN (0, 1)"


def _profile_row(column, dtype):
    return (f"SELECT '{column}' AS \"column\", '{dtype}' AS dtype, COUNT(*) AS n_rows, "
            f"COUNT({column}) AS non_null, COUNT(*) - COUNT({column}) AS nulls FROM raw")


SQL = {
    "csv_scan_strings": f"WITH {RAW} SELECT CAST(event_id AS VARCHAR) AS event_id, reading, visitor, kredit, mixed_type_col FROM raw",
    "prepare_job": f"""WITH {RAW}, {_COERCED},
      kept AS (SELECT CAST(CAST(event_id AS BIGINT) AS VARCHAR) AS event_id, reading, visitor,
                      CAST(kredit AS INTEGER) AS kredit FROM coerced WHERE kredit IN (0, 1)),
      classes AS (SELECT kredit, COUNT(*) AS n FROM kept GROUP BY kredit),
      sizes AS (SELECT CAST(SUM(n) AS BIGINT) AS total,
                       CAST(SUM(n) AS BIGINT) - CAST(CEIL(ROUND(0.3 * SUM(n), 6)) AS BIGINT) AS n_train FROM classes),
      base AS (SELECT kredit, n, n * n_train // total AS low, n * n_train % total AS rest, n_train FROM classes, sizes),
      dealt AS (SELECT kredit, n - low - CASE WHEN ROW_NUMBER() OVER (ORDER BY rest DESC, kredit)
                       <= n_train - SUM(low) OVER () THEN 1 ELSE 0 END AS n_test FROM base),
      ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY kredit ORDER BY md5('42|' || event_id)) AS place FROM kept)
      SELECT r.event_id, r.reading, r.visitor, r.kredit,
             CASE WHEN r.place <= d.n_test THEN 'test' ELSE 'train' END AS split
      FROM ranked r JOIN dealt d ON r.kredit = d.kredit""",
    "prepare_job_keyless": f"""WITH {RAW}, given AS (
        SELECT CASE WHEN event_id % 3 = 0 THEN '1.5' ELSE reading END AS reading,
               CASE WHEN event_id % 3 = 0 THEN '7' ELSE visitor END AS visitor,
               CASE WHEN event_id % 3 = 0 THEN '0' ELSE kredit END AS kredit FROM raw),
      kept AS (SELECT TRY_CAST(reading AS DOUBLE) AS reading, TRY_CAST(visitor AS DOUBLE) AS visitor,
                      CAST(TRY_CAST(kredit AS DOUBLE) AS INTEGER) AS kredit
               FROM given WHERE TRY_CAST(kredit AS DOUBLE) IN (0, 1)),
      digests AS (SELECT *, md5('{{' || concat_ws(',', '"c0":"' || reading || '"', '"c1":"' || visitor || '"', '"c2":"' || kredit || '"') || '}}') AS digest
                  FROM kept),
      keyed AS (SELECT reading, visitor, kredit,
                       digest || '-' || ROW_NUMBER() OVER (PARTITION BY digest) AS row_id FROM digests),
      classes AS (SELECT kredit, COUNT(*) AS n FROM kept GROUP BY kredit),
      sizes AS (SELECT CAST(SUM(n) AS BIGINT) AS total,
                       CAST(SUM(n) AS BIGINT) - CAST(CEIL(ROUND(0.3 * SUM(n), 6)) AS BIGINT) AS n_train FROM classes),
      base AS (SELECT kredit, n, n * n_train // total AS low, n * n_train % total AS rest, n_train FROM classes, sizes),
      dealt AS (SELECT kredit, n - low - CASE WHEN ROW_NUMBER() OVER (ORDER BY rest DESC, kredit)
                       <= n_train - SUM(low) OVER () THEN 1 ELSE 0 END AS n_test FROM base),
      ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY kredit ORDER BY md5('42|' || row_id)) AS place FROM keyed)
      SELECT ROUND(r.reading, 6) AS reading, r.visitor, r.kredit, r.row_id,
             CASE WHEN r.place <= d.n_test THEN 'test' ELSE 'train' END AS split
      FROM ranked r JOIN dealt d ON r.kredit = d.kredit""",
    "profile": f"WITH {RAW} " + " UNION ALL ".join([
        _profile_row("event_id", "bigint"), _profile_row("reading", "string"), _profile_row("visitor", "string"),
        _profile_row("kredit", "string"), _profile_row("mixed_type_col", "string")]),
    "preview": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5",
    "value_counts": "SELECT event_type AS value, COUNT(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY event_type",
    "value_shares": """SELECT event_type AS value, COUNT(*) AS n,
      ROUND(COUNT(*) / CAST(SUM(COUNT(*)) OVER () AS DOUBLE), 6) AS share
      FROM events WHERE event_type IS NOT NULL GROUP BY event_type""",
    "non_numeric_tally": f"""WITH {RAW}, {_CELLS} SELECT "column", value, COUNT(*) AS n FROM cells
      WHERE value IS NOT NULL AND TRY_CAST(value AS DOUBLE) IS NULL GROUP BY "column", value""",
    "dirty_tokens": f"""WITH {RAW}, {_CELLS} SELECT DISTINCT value FROM cells
      WHERE "column" <> 'mixed_type_col' AND value IS NOT NULL AND TRY_CAST(value AS DOUBLE) IS NULL""",
    "replace_tokens": f"""WITH {RAW}, {_CELLS}, tokens AS (SELECT DISTINCT value FROM cells
      WHERE "column" <> 'mixed_type_col' AND value IS NOT NULL AND TRY_CAST(value AS DOUBLE) IS NULL)
      SELECT event_id, CASE WHEN reading NOT IN (SELECT value FROM tokens) THEN reading END AS reading,
             CASE WHEN visitor NOT IN (SELECT value FROM tokens) THEN visitor END AS visitor,
             CASE WHEN kredit NOT IN (SELECT value FROM tokens) THEN kredit END AS kredit,
             CASE WHEN mixed_type_col NOT IN (SELECT value FROM tokens) THEN mixed_type_col END AS mixed_type_col
      FROM raw""",
    "coerce_numeric": f"WITH {RAW}, {_COERCED} SELECT * FROM coerced",
    "null_counts": f"WITH {RAW}, {_COERCED} " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", COUNT(*) - COUNT({c}) AS nulls FROM coerced"
        for c in ("event_id", "reading", "visitor", "kredit", "mixed_type_col")),
    "drop_column": f"WITH {RAW} SELECT event_id, reading, visitor, kredit FROM raw",
    "valid_target": f"WITH {RAW}, {_COERCED} SELECT * FROM coerced WHERE kredit IN (0, 1)",
    "clean_report": f"""WITH {RAW}, {_COERCED} SELECT COUNT(*) AS rows_before,
      COUNT(*) - COUNT(CASE WHEN c.kredit IN (0, 1) THEN 1 END) AS rows_removed,
      COUNT(CASE WHEN c.kredit IN (0, 1) THEN 1 END) AS rows_left,
      COUNT(CASE WHEN r.reading IS NOT NULL AND c.reading IS NULL THEN 1 END)
        + COUNT(CASE WHEN r.visitor IS NOT NULL AND c.visitor IS NULL THEN 1 END)
        + COUNT(CASE WHEN r.kredit IS NOT NULL AND c.kredit IS NULL THEN 1 END) AS dirty_cells,
      CAST(4 AS BIGINT) AS columns_left
      FROM raw r JOIN coerced c ON r.event_id = c.event_id""",
    "clean_pipeline": f"WITH {RAW}, {_COERCED} {_CLEANED}",
    "separate_target": f"WITH {RAW}, {_COERCED} SELECT event_id, reading, visitor, kredit FROM coerced WHERE kredit IN (0, 1)",
    "rename_columns": "SELECT c_custkey AS customer_id, c_name, c_nationkey, c_acctbal AS balance, c_mktsegment FROM customer",
    "complete_cases": f"""WITH {RAW}, {_COERCED} SELECT * FROM coerced WHERE event_id IS NOT NULL
      AND reading IS NOT NULL AND visitor IS NOT NULL AND kredit IS NOT NULL AND mixed_type_col IS NOT NULL""",
    "shape_report": f"""WITH {RAW}, {_COERCED}
      SELECT 'before' AS label, COUNT(*) AS n_rows, CAST(5 AS BIGINT) AS n_columns FROM raw
      UNION ALL SELECT 'after', COUNT(*), CAST(4 AS BIGINT) FROM coerced WHERE kredit IN (0, 1)""",
}
