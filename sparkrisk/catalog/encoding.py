"""Feature encoding."""

from pyspark.sql import functions as F

from sparkrisk.catalog.tables import MIXED, load, mixed, rounded
from sparkrisk.operators.encode import TableEncoder
from sparkrisk.plans.features import prepare_features, preprocess
from sparkrisk.spec import FeatureSpec

SPEC = FeatureSpec(
    numeric=("quantity", "price"), nominal=("flag", "status"), ordinal=("line", "tax"), target="y",
    rules={"flag": ["A", "N", "R"], "line": [1, 2, 3, 4, 5]}, outlier_columns=("quantity", "line"),
)


def minmax_scale(spark, folder):
    df = mixed(spark, folder).select("l_orderkey", "quantity", "price")
    return rounded(TableEncoder(numeric=["quantity", "price"]).fit(df).transform(df))


def one_hot(spark, folder):
    df = mixed(spark, folder).select("l_orderkey", "flag", "status")
    return TableEncoder(nominal=["flag", "status"]).fit(df).transform(df)


def ordinal_encode(spark, folder):
    df = mixed(spark, folder).select("l_orderkey", "line", "tax")
    return TableEncoder(ordinal=["line", "tax"]).fit(df).transform(df)


def encode_keys(spark, folder):
    """Codes of order and part keys, which have far more categories than a plan can hold; sparse vectors as text."""
    df = load(spark, folder, "lineitem").select("l_linenumber", F.col("l_orderkey").alias("line_order"), "l_orderkey", "l_partkey", F.col("l_partkey").alias("line_part"))
    made = TableEncoder(nominal=["l_partkey"], ordinal=["l_orderkey"], literalCategories=100).fit(df).transform(df)
    vector = F.get_json_object(F.to_json(F.struct("l_partkey")), "$.l_partkey")
    return made.select("line_order", "l_linenumber", "line_part", "l_orderkey", vector.alias("l_partkey"))


def fit_train_apply_test(spark, folder):
    """Statistics from odd orders; even orders are test rows with unseen values."""
    df = mixed(spark, folder)
    train, test = df.where(F.col("l_orderkey") % 2 == 1), df.where(F.col("l_orderkey") % 2 == 0)
    a, b, _ = prepare_features(train, test, SPEC)
    return rounded(a.withColumn("part", F.lit("train")).unionByName(b.withColumn("part", F.lit("test"))))


QUERIES = {
    "minmax_scale": minmax_scale,
    "one_hot": one_hot,
    "ordinal_encode": ordinal_encode,
    "encode_keys": encode_keys,
    "encode_all": lambda s, d: rounded(preprocess(mixed(s, d), SPEC)),
    "fit_train_apply_test": fit_train_apply_test,
}


def _mode(column, table, where="TRUE"):
    return (f"(SELECT {column} FROM {table} WHERE {column} IS NOT NULL AND {where} "
            f"GROUP BY {column} ORDER BY COUNT(*) DESC, {column} LIMIT 1)")


def _scaled(column, table):
    return (f"ROUND((COALESCE({column}, (SELECT quantile_cont({column}, 0.5) FROM {table})) "
            f"- (SELECT MIN({column}) FROM {table})) / ((SELECT MAX({column}) FROM {table}) "
            f"- (SELECT MIN({column}) FROM {table})) + 1.0, 6) AS {column}")


def _hot(column, value, table):
    return (f"CASE WHEN COALESCE({column}, {_mode(column, table)}) = '{value}' THEN 1.0::DOUBLE "
            f"ELSE 0.0::DOUBLE END AS {column}_{value}")


def _ranks(column, table):
    """Category table with ranks; joined, as a correlated count per row would be slow."""
    return (f"rank_{column} AS (SELECT {column} AS v, CAST(ROW_NUMBER() OVER (ORDER BY {column}) - 1 AS DOUBLE) AS r "
            f"FROM (SELECT DISTINCT {column} FROM {table} WHERE {column} IS NOT NULL))")


def _encoded(source, table):
    return f"""SELECT {_scaled('quantity', table)}, {_scaled('price', table)},
      {_hot('flag', 'N', table)}, {_hot('flag', 'R', table)}, {_hot('status', 'O', table)},
      COALESCE(rl.r, -1.0) AS line, COALESCE(rt.r, -1.0) AS tax, l_orderkey, l_partkey
      FROM {source} s
      LEFT JOIN rank_line rl ON COALESCE(s.line, {_mode('line', table)}) = rl.v
      LEFT JOIN rank_tax rt ON COALESCE(s.tax, {_mode('tax', table)}) = rt.v"""


def _fixed(name, source):
    """Illegal values to the train mode."""
    return f"""{name} AS (SELECT l_orderkey, l_partkey, quantity, price,
      CASE WHEN flag IN ('A', 'N', 'R') THEN flag ELSE {_mode('flag', 'tr', "flag IN ('A', 'N', 'R')")} END AS flag,
      status, CAST(CASE WHEN line IN (1, 2, 3, 4, 5) THEN line
                   ELSE {_mode('line', 'tr', 'line IN (1, 2, 3, 4, 5)')} END AS DOUBLE) AS line, tax FROM {source})"""


def _limit(column):
    return (f"lim_{column} AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM "
            f"(SELECT quantile_cont({column}, 0.25) AS q1, quantile_cont({column}, 0.75) AS q3 FROM fixed_train))")


def _cap(name, source):
    def one(c):
        return (f"CASE WHEN {c} < lim_{c}.lo THEN lim_{c}.lo WHEN {c} > lim_{c}.hi THEN lim_{c}.hi "
                f"ELSE {c} END AS {c}")
    return (f"{name} AS (SELECT l_orderkey, l_partkey, {one('quantity')}, price, flag, status, {one('line')}, tax "
            f"FROM {source}, lim_quantity, lim_line)")


SQL = {
    "minmax_scale": f"WITH {MIXED} SELECT {_scaled('quantity', 'mixed')}, {_scaled('price', 'mixed')}, l_orderkey FROM mixed",
    "one_hot": f"WITH {MIXED} SELECT {_hot('flag', 'N', 'mixed')}, {_hot('flag', 'R', 'mixed')}, {_hot('status', 'O', 'mixed')}, l_orderkey FROM mixed",
    "ordinal_encode": f"""WITH {MIXED}, {_ranks('line', 'mixed')}, {_ranks('tax', 'mixed')}
      SELECT COALESCE(rl.r, -1.0) AS line, COALESCE(rt.r, -1.0) AS tax, l_orderkey FROM mixed s
      LEFT JOIN rank_line rl ON COALESCE(s.line, {_mode('line', 'mixed')}) = rl.v
      LEFT JOIN rank_tax rt ON COALESCE(s.tax, {_mode('tax', 'mixed')}) = rt.v""",
    "encode_keys": """WITH orders_ranked AS (SELECT l_orderkey AS k, CAST(ROW_NUMBER() OVER (ORDER BY l_orderkey) - 1 AS DOUBLE) AS r
        FROM (SELECT DISTINCT l_orderkey FROM lineitem)),
      parts_ranked AS (SELECT l_partkey AS k, ROW_NUMBER() OVER (ORDER BY l_partkey) - 1 AS r FROM (SELECT DISTINCT l_partkey FROM lineitem))
      SELECT l.l_orderkey AS line_order, l_linenumber, l_partkey AS line_part, o.r AS l_orderkey,
        '{"type":0,"size":' || (SELECT COUNT(*) - 1 FROM parts_ranked) ||
        CASE WHEN p.r = 0 THEN ',"indices":[],"values":[]}' ELSE ',"indices":[' || (p.r - 1) || '],"values":[1.0]}' END AS l_partkey
      FROM lineitem l JOIN orders_ranked o ON l.l_orderkey = o.k JOIN parts_ranked p ON l.l_partkey = p.k""",
    "encode_all": f"WITH {MIXED}, {_ranks('line', 'mixed')}, {_ranks('tax', 'mixed')} {_encoded('mixed', 'mixed')}",
    "fit_train_apply_test": f"""WITH {MIXED}, tr AS (SELECT * FROM mixed WHERE l_orderkey % 2 = 1),
      te AS (SELECT * FROM mixed WHERE l_orderkey % 2 = 0),
      {_fixed('fixed_train', 'tr')}, {_fixed('fixed_test', 'te')}, {_limit('quantity')}, {_limit('line')},
      {_cap('capped_train', 'fixed_train')}, {_cap('capped_test', 'fixed_test')},
      {_ranks('line', 'capped_train')}, {_ranks('tax', 'capped_train')}
      SELECT *, 'train' AS part FROM ({_encoded('capped_train', 'capped_train')})
      UNION ALL SELECT *, 'test' AS part FROM ({_encoded('capped_test', 'capped_train')})""",
}
