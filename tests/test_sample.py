import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkrisk.operators import cutoffs, sample


def table(spark, n, positives):
    return spark.range(n).select("id", (F.col("id") < positives).cast("int").alias("target")).repartition(5)


@pytest.mark.parametrize("share", [0.1, 0.2, 0.3, 0.4])
def test_exact_sizes_and_class_shares(spark, share):
    out = sample.holdout_split(table(spark, 100, 30), "id", "target", share).toPandas()
    test = out[out.split == "test"]
    assert len(test) == round(share * 100) and len(out) == 100
    assert abs((test.target == 0).mean() - 0.7) < 0.05


def test_uneven_classes_and_repeatability(spark):
    df = table(spark, 1000, 100)
    a = sample.holdout_split(df, "id", "target", 0.2)
    b = sample.holdout_split(df.repartition(13), "id", "target", 0.2)
    assert sorted(a.collect()) == sorted(b.collect())
    report = {(r["split"], r["class"]): (r["n"], r["share"]) for r in sample.split_report(a, "target").collect()}
    assert report["test", 0] == (180, 0.9) and report["train", 1] == (80, 0.1)
    other = sample.holdout_split(df, "id", "target", 0.2, seed=7)
    assert sorted(a.collect()) != sorted(other.collect())


def test_split_errors(spark):
    with pytest.raises(ValueError):
        sample.holdout_split(table(spark, 10, 3), "id", "absent")
    with pytest.raises(ValueError):
        sample.holdout_split(table(spark, 10, 1), "id", "target")
    with pytest.raises(ValueError):
        sample.holdout_split(spark.createDataFrame([(1, None), (2, 1)], "id int, target int"), "id", "target")


def test_plain_split(spark):
    out = sample.holdout_split(table(spark, 101, 1), "id", "target", stratify=False)
    assert out.where("split = 'test'").count() == 31


@pytest.mark.parametrize("n, positives", [(103, 20), (50, 11)])
def test_folds_are_balanced_and_cover_every_row(spark, n, positives):
    out = sample.repeated_folds(table(spark, n, positives), "id", "target", folds=5, repeats=3).toPandas()
    for r in range(3):
        sizes = out.groupby(f"fold_{r}").size()
        per_class = out.groupby([f"fold_{r}", "target"]).size().unstack()
        assert sizes.sum() == n and sizes.max() - sizes.min() <= 1
        assert ((per_class.max() - per_class.min()) <= 1).all()
    assert not out["fold_0"].equals(out["fold_1"])


def test_folds_have_no_shuffle_of_rows(spark):
    out = sample.repeated_folds(spark.range(100).withColumn("target", (F.col("id") % 2).cast("int")), "id", "target")
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_sampling(spark):
    df = table(spark, 500, 10)
    assert sample.sample_rows(df, "id", 37).count() == 37
    assert sample.sample_rows(df, "id", 1000).count() == 500


def test_keys_at_ranks_opens_digits(spark, monkeypatch):
    monkeypatch.setattr(cutoffs, "_FINISH_PER_RANK", 4)
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("stratum"), F.md5(F.col("id").cast("string")).alias("key"))
    frame = df.toPandas()
    sizes = frame.groupby("stratum").size().to_dict()
    got = cutoffs.keys_at_ranks(df, sizes, {"a": [0, 10, 999, 1000], "b": [1, 1000]})
    ordered = {s: sorted(g.key) for s, g in frame.groupby("stratum")}
    assert got["a", 1000] > max(ordered["a"])
    assert all(got[s, k] == ordered[s][k] for s, k in got if k < sizes[s])


def test_union_keeps_duplicates(spark):
    df = spark.createDataFrame(pd.DataFrame({"a": [1, 1]}))
    assert sample.union_parts(df, df).count() == 4
