"""Stand-in tables: the same derivation as a DataFrame and as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison across engines; negative zero becomes zero."""
    return df.select(*[
        (F.round(F.col(f"`{f.name}`"), digits) + F.lit(0.0)).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


# Raw table: text cells with dirt, a mixed column and an imperfect target.
RAW = """raw AS (
  SELECT event_id,
         CASE WHEN event_id % 13 = 0 THEN 'invalid' WHEN event_id % 11 = 0 THEN 'error'
              ELSE CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) END AS reading,
         CASE WHEN event_id % 29 = 0 THEN 'error' ELSE CAST(user_id AS VARCHAR) END AS visitor,
         CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 19 = 0 THEN '2'
              WHEN event_type = 'purchase' THEN '1' ELSE '0' END AS kredit,
         props AS mixed_type_col
  FROM events)"""


def raw(spark: SparkSession, folder: str) -> DataFrame:
    e = load(spark, folder, "events")
    i = F.col("event_id")
    return e.select(
        "event_id",
        F.when(i % 13 == 0, "invalid").when(i % 11 == 0, "error")
        .otherwise(F.col("value").cast("decimal(12,2)").cast("string")).alias("reading"),
        F.when(i % 29 == 0, "error").otherwise(F.col("user_id").cast("string")).alias("visitor"),
        F.when(i % 17 == 0, None).when(i % 19 == 0, "2")
        .when(F.col("event_type") == "purchase", "1").otherwise("0").alias("kredit"),
        F.col("props").alias("mixed_type_col"),
    )


# Ruled table: codes, some missing, some illegal under RULES.
RULED = """ruled AS (
  SELECT l_orderkey, l_partkey,
         CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE l_linenumber END AS line,
         l_quantity AS quantity, l_returnflag AS flag
  FROM lineitem)"""
RULES = {"line": [2, 3, 4, 5], "quantity": [float(q) for q in range(1, 41)], "flag": ["A", "N"]}


def ruled(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey",
        F.when(F.col("l_orderkey") % 17 == 0, None).otherwise(F.col("l_linenumber")).alias("line"),
        F.col("l_quantity").alias("quantity"), F.col("l_returnflag").alias("flag"),
    )


# Mixed table: numeric, nominal and ordinal columns with missing cells.
MIXED = """mixed AS (
  SELECT l_orderkey, l_partkey,
         CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE l_quantity END AS quantity,
         l_extendedprice AS price,
         CASE WHEN l_partkey % 19 = 0 THEN NULL ELSE l_returnflag END AS flag,
         l_linestatus AS status,
         CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE l_linenumber END AS line,
         l_tax AS tax
  FROM lineitem)"""


def mixed(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey",
        F.when(F.col("l_orderkey") % 17 != 0, F.col("l_quantity")).alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.when(F.col("l_partkey") % 19 != 0, F.col("l_returnflag")).alias("flag"),
        F.col("l_linestatus").alias("status"),
        F.when(F.col("l_suppkey") % 13 != 0, F.col("l_linenumber")).alias("line"),
        F.col("l_tax").alias("tax"),
    )


# Labelled table: two numeric features and an uneven binary target.
LABELLED = """labelled AS (
  SELECT event_id, value, CAST(user_id AS DOUBLE) AS visitor,
         CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS y
  FROM events)"""


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "events").select(
        "event_id", "value", F.col("user_id").cast("double").alias("visitor"),
        (F.col("event_type") == "purchase").cast("int").alias("y"),
    )


# Score tables: many ties, and mostly distinct scores.
TIED = """scored AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y_true,
         CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END AS y_pred,
         l_discount AS y_proba
  FROM lineitem)"""
DISTINCT = """scored AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y_true,
         CASE WHEN l_extendedprice / 131072 > 0.5 THEN 1 ELSE 0 END AS y_pred,
         l_extendedprice / 131072 AS y_proba
  FROM lineitem)"""


def tied_scores(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("y_true"),
        (F.col("l_discount") > 0.05).cast("int").alias("y_pred"),
        F.col("l_discount").alias("y_proba"),
    )


def distinct_scores(spark: SparkSession, folder: str) -> DataFrame:
    score = F.col("l_extendedprice") / 131072
    return load(spark, folder, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("y_true"),
        (score > 0.5).cast("int").alias("y_pred"), score.alias("y_proba"),
    )


def modelling(spark: SparkSession, folder: str) -> DataFrame:
    """Training table: numeric, ordinal and nominal features of events, target purchase."""
    return load(spark, folder, "events").select(
        "event_id", "value", F.get_json_object("props", "$.k").cast("double").alias("k"),
        F.hour("ts").alias("hour"), F.weekday("ts").alias("weekday"),
        (F.col("user_id") % 4).cast("int").alias("region"),
        (F.col("event_type") == "purchase").cast("int").alias("bought"),
    )
