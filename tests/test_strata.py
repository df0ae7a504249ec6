"""Splits and folds of more strata than a plan can hold as literals, against those of the path for few strata."""

import pytest
from pyspark.sql import functions as F

from sparkrisk.operators import cutoffs, sample, strata
from sparkrisk.session import materialize


@pytest.fixture(scope="module")
def table(spark):
    """A stratum with a third of the rows, small ones of 2 to 9 rows."""
    rows = [(k, 0) for k in range(400)] + [(1000 + 10 * s + j, s) for s in range(1, 120) for j in range(2 + s % 8)]
    return materialize(spark.createDataFrame(rows, "id long, cls int").repartition(5), "strata-rows")


@pytest.mark.parametrize("finish", [5000, 3])
def test_both_paths_give_the_same_rows(spark, table, monkeypatch, finish):
    monkeypatch.setattr(strata, "FINISH", finish)
    want = (sample.holdout_split(table, "id", "cls"), sample.repeated_folds(table, "id", "cls", 4, 2))
    want = [sorted(map(tuple, t.collect())) for t in want]
    monkeypatch.setattr(cutoffs, "LITERAL_STRATA", 5)
    got = (sample.holdout_split(table, "id", "cls"), sample.repeated_folds(table, "id", "cls", 4, 2))
    assert [t.columns for t in got] == [["id", "cls", "split"], ["id", "cls", "fold_0", "fold_1"]]
    assert [sorted(map(tuple, t.collect())) for t in got] == want


def test_salted_join_gives_the_same_rows(table, monkeypatch):
    monkeypatch.setattr(cutoffs, "LITERAL_STRATA", 5)
    want = sorted(map(tuple, sample.holdout_split(table, "id", "cls").collect()))
    monkeypatch.setattr(strata, "BROADCAST_BYTES", 0)
    assert sorted(map(tuple, sample.holdout_split(table, "id", "cls").collect())) == want


def test_fifty_thousand_strata(spark):
    """Two rows of each of 50 000 strata, and one stratum with a third of all rows: sizes are exact."""
    rows = spark.range(150_000).select("id", F.when(F.col("id") < 50_000, 0).otherwise(1 + F.col("id") % 50_000).alias("cls"))
    parts = materialize(sample.holdout_split(rows, "id", "cls", 0.5), "many-strata")
    counts = parts.groupBy("cls").agg(F.count_if(F.col("split") == "test").alias("test"), F.count(F.lit(1)).alias("n"))
    assert counts.where("test * 2 <> n").count() == 0 and counts.count() == 50_001


def test_refusals(spark, monkeypatch):
    monkeypatch.setattr(cutoffs, "LITERAL_STRATA", 2)
    one = spark.createDataFrame([(k, k // 2) for k in range(9)], "id long, cls int")
    with pytest.raises(ValueError, match="two rows"):
        sample.holdout_split(one, "id", "cls")
    with pytest.raises(ValueError, match="missing stratum"):
        sample.holdout_split(one.withColumn("cls", F.when(F.col("id") > 2, F.col("cls"))).unionByName(one), "id", "cls")
    twice = spark.createDataFrame([(1, s) for s in range(4) for _ in range(6)], "id long, cls int")
    with pytest.raises(Exception, match="not unique"):
        sample.holdout_split(twice, "id", "cls", 0.5).collect()
    with pytest.raises(ValueError, match="no class has"):
        sample.repeated_folds(spark.createDataFrame([(k, k) for k in range(9)], "id long, cls int"), "id", "cls", 3, 1)


def test_tables_too_large_to_broadcast_are_not_broadcast(spark, monkeypatch):
    """A written table of a few kilobytes, copies of which the planner would send to every task; frequent, missing and unseen keys."""
    monkeypatch.setattr(strata, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(strata, "HOT_ROWS", 100)
    ranks = materialize(spark.range(2_000).select(F.col("id").alias("v"), (F.col("id") * 3).alias("rank")), "few-ranks")
    rows = spark.range(3_000).select("id", F.when(F.col("id") < 500, 7).when(F.col("id") < 1000, 5_000).when(F.col("id") < 1_500, None).otherwise(F.col("id")).alias("k"))
    assert sorted(strata._frequent(rows, F.col("k"))) == [7, 5_000]
    joined = strata.attach(rows, ranks, F.col("k"), "v")
    assert joined.columns == ["id", "k", "rank"]
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    want = {i: (7 if i < 500 else None if i < 1_500 or i >= 2_000 else i) for i in range(3_000)}
    assert {r["id"]: r["rank"] for r in joined.collect()} == {i: None if k is None else 3 * k for i, k in want.items()}
