"""Splits, folds, samples and oversampling."""

from pyspark.sql import functions as F

from sparkrisk.catalog.tables import LABELLED, labelled, rounded
from sparkrisk.operators import oversample, sample

_FEATURES = ["value", "visitor"]


def stratified_split(spark, folder):
    return sample.holdout_split(labelled(spark, folder), "event_id", "y").select("event_id", "y", "split")


def plain_split(spark, folder):
    return sample.holdout_split(labelled(spark, folder), "event_id", "y", stratify=False).select("event_id", "split")


def split_report(spark, folder):
    return rounded(sample.split_report(stratified_split(spark, folder), "y"))


def union_parts(spark, folder):
    df = stratified_split(spark, folder)
    return sample.union_parts(df.where(F.col("split") == "train"), df.where(F.col("split") == "test"))


def synthetic(sampler):
    def run(spark, folder):
        made = sampler(labelled(spark, folder), _FEATURES, "y", "event_id")
        return rounded(made.select("event_id", "copy", *_FEATURES, "y"), 4)
    return run


QUERIES = {
    "stratified_split": stratified_split,
    "plain_split": plain_split,
    "split_report": split_report,
    "union_parts": union_parts,
    "repeated_kfold": lambda s, d: sample.fold_table(labelled(s, d), "event_id", "y"),
    "sample_rows": lambda s, d: rounded(sample.sample_rows(labelled(s, d), "event_id", 500)),
    "smote": synthetic(oversample.smote),
    "borderline_smote": synthetic(oversample.borderline_smote),
}

_SPLIT = """classes AS (SELECT y, COUNT(*) AS n FROM labelled GROUP BY y),
  sizes AS (SELECT CAST(SUM(n) AS BIGINT) AS total,
                   CAST(SUM(n) AS BIGINT) - CAST(CEIL(ROUND(0.3 * SUM(n), 6)) AS BIGINT) AS n_train FROM classes),
  base AS (SELECT y, n, n * n_train // total AS low, n * n_train % total AS rest, n_train FROM classes, sizes),
  dealt AS (SELECT y, n - low - CASE WHEN ROW_NUMBER() OVER (ORDER BY rest DESC, y)
                   <= n_train - SUM(low) OVER () THEN 1 ELSE 0 END AS n_test FROM base),
  ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY y ORDER BY md5('42|' || CAST(event_id AS VARCHAR))) AS place
             FROM labelled),
  split AS (SELECT r.event_id, r.y, CASE WHEN r.place <= d.n_test THEN 'test' ELSE 'train' END AS split
            FROM ranked r JOIN dealt d ON r.y = d.y)"""

_FOLDS = """repeats AS (SELECT * FROM (VALUES (0), (1), (2)) v(repeat)),
  keyed AS (SELECT event_id, y, repeat, md5(CAST(42 + repeat AS VARCHAR) || '|' || CAST(event_id AS VARCHAR)) AS k
            FROM labelled, repeats),
  sorted AS (SELECT repeat, y, ROW_NUMBER() OVER (PARTITION BY repeat ORDER BY y, k) - 1 AS position FROM keyed),
  slots AS (SELECT repeat, y, position % 5 AS fold,
                   ROW_NUMBER() OVER (PARTITION BY repeat, y ORDER BY position % 5, position) AS place FROM sorted),
  ranked AS (SELECT event_id, repeat, y, ROW_NUMBER() OVER (PARTITION BY repeat, y ORDER BY k) AS place FROM keyed),
  folds AS (SELECT r.event_id, r.repeat, r.y, CAST(s.fold AS INTEGER) AS fold FROM ranked r
            JOIN slots s ON r.repeat = s.repeat AND r.y = s.y AND r.place = s.place)"""


def _unit(digest, start):
    return f"CAST(('0x' || substr({digest}, {start}, 8)) AS BIGINT) / 4294967296.0::DOUBLE"


def _neighbours(name, left, right, k):
    """k nearest rows of ``right`` for each row of ``left``, by distance and key."""
    return f"""{name} AS (SELECT * FROM (
      SELECT a.event_id, b.event_id AS other, b.value AS other_value, b.visitor AS other_visitor, b.y AS other_y,
             ROW_NUMBER() OVER (PARTITION BY a.event_id ORDER BY (a.value - b.value) * (a.value - b.value)
               + (a.visitor - b.visitor) * (a.visitor - b.visitor), b.event_id) AS place
      FROM {left} a JOIN {right} b ON a.event_id <> b.event_id) WHERE place <= {k})"""


# How many of the classes' size difference each starting row gets, then the points themselves.
_SYNTHETIC = f"""need AS (SELECT COUNT(CASE WHEN y = 0 THEN 1 END) - COUNT(CASE WHEN y = 1 THEN 1 END) AS n FROM labelled),
  total AS (SELECT COUNT(*) AS n FROM seeds),
  dealt AS (SELECT s.*, need.n // total.n + CASE WHEN ROW_NUMBER() OVER (
              ORDER BY md5('42:extra|' || CAST(event_id AS VARCHAR))) <= need.n % total.n THEN 1 ELSE 0 END AS copies
            FROM seeds s, need, total),
  many AS (SELECT *, UNNEST(range(1, CAST(copies AS BIGINT) + 1)) AS copy FROM dealt),
  drawn AS (SELECT *, md5('42|' || CAST(event_id AS VARCHAR) || '|' || CAST(copy AS VARCHAR)) AS digest FROM many),
  made AS (SELECT d.event_id, CAST(d.copy AS INTEGER) AS copy,
                  d.value + {_unit('digest', 9)} * (n.other_value - d.value) AS value,
                  d.visitor + {_unit('digest', 9)} * (n.other_visitor - d.visitor) AS visitor, 1 AS y
           FROM drawn d JOIN near n ON n.event_id = d.event_id
            AND n.place = CAST(FLOOR({_unit('digest', 1)} * 5) AS BIGINT) + 1)
  SELECT event_id, copy, ROUND(value, 4) AS value, ROUND(visitor, 4) AS visitor, y FROM made
  UNION ALL SELECT event_id, 0, ROUND(value, 4), ROUND(visitor, 4), y FROM labelled"""

_MINOR = "minor AS (SELECT * FROM labelled WHERE y = 1)"
SQL = {
    "stratified_split": f"WITH {LABELLED}, {_SPLIT} SELECT * FROM split",
    "plain_split": f"""WITH {LABELLED}, ranked AS (SELECT event_id, ROW_NUMBER() OVER (
        ORDER BY md5('42|' || CAST(event_id AS VARCHAR))) AS place, COUNT(*) OVER () AS n FROM labelled)
      SELECT event_id, CASE WHEN place <= CEIL(ROUND(0.3 * n, 6)) THEN 'test' ELSE 'train' END AS split FROM ranked""",
    "split_report": f"""WITH {LABELLED}, {_SPLIT} SELECT split, y AS class, COUNT(*) AS n,
      ROUND(COUNT(*) / CAST(SUM(COUNT(*)) OVER (PARTITION BY split) AS DOUBLE), 6) AS share FROM split GROUP BY split, y""",
    "union_parts": f"WITH {LABELLED}, {_SPLIT} SELECT * FROM split",
    "repeated_kfold": f"WITH {LABELLED}, {_FOLDS} SELECT event_id, repeat, fold FROM folds",
    "sample_rows": f"""WITH {LABELLED} SELECT event_id, ROUND(value, 6) AS value, ROUND(visitor, 6) AS visitor, y
      FROM labelled ORDER BY md5('42|' || CAST(event_id AS VARCHAR)) LIMIT 500""",
    "smote": f"""WITH {LABELLED}, {_MINOR}, {_neighbours('near', 'minor', 'minor', 5)},
      seeds AS (SELECT * FROM minor), {_SYNTHETIC}""",
    "borderline_smote": f"""WITH {LABELLED}, {_MINOR}, {_neighbours('around', 'minor', 'labelled', 10)},
      foreign_count AS (SELECT event_id, COUNT(CASE WHEN other_y = 0 THEN 1 END) AS n FROM around GROUP BY event_id),
      seeds AS (SELECT m.* FROM minor m JOIN foreign_count f ON m.event_id = f.event_id WHERE f.n >= 5 AND f.n < 10),
      {_neighbours('near', 'seeds', 'minor', 5)}, {_SYNTHETIC}""",
}
