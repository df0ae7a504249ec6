import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkrisk.operators import neighbours as nb
from sparkrisk.operators import oversample


def brute_force(left, right, k):
    out = {}
    x, keys = np.stack(right["vec"]), right["key"].to_numpy()
    for key, v in zip(left["key"], left["vec"]):
        d2 = np.zeros(len(x))
        for j, a in enumerate(v):
            d2 += (a - x[:, j]) ** 2
        order = [i for i in np.lexsort((keys, d2)) if keys[i] != key][:k]
        out[key] = [(d2[i], keys[i]) for i in order]
    return out


def points(n, d, seed, copies=0):
    rng = np.random.RandomState(seed)
    x = rng.normal(size=(n, d)).round(2)
    x[:copies] = 0.5
    return pd.DataFrame({"key": rng.permutation(n).astype("int64"), "label": rng.choice(["0", "1"], n), "vec": list(x)})


@pytest.mark.parametrize("d, copies, small", [(2, 0, False), (2, 200, True), (6, 50, True), (1, 0, True)])
def test_nearest_equals_brute_force(spark, monkeypatch, d, copies, small):
    if small:
        for name, value in (("VECTORS_PER_CELL", 20), ("LEFT_BLOCK", 16), ("RIGHT_BLOCK", 50), ("_TILE", 500), ("LEAF", 4)):
            monkeypatch.setattr(nb, name, value)
    frame = points(600, d, 3, copies)
    df = spark.createDataFrame(frame, "key long, label string, vec array<double>").repartition(4)
    left = df.where("label = '1'")
    got = {r["key"]: [(n["d2"], n["key"]) for n in r["neighbours"]] for r in nb.nearest(left, df, 5).collect()}
    assert got == brute_force(frame[frame.label == "1"], frame, 5)


def test_widely_shared_vectors_are_joined_by_broadcast(spark, monkeypatch):
    monkeypatch.setattr(nb, "_HOT_ROWS", 20)
    monkeypatch.setattr(nb, "_HOT_PARTS", 10)
    frame = points(300, 2, 5, 100)
    df = spark.createDataFrame(frame, "key long, label string, vec array<double>")
    got = nb.nearest(df, df, 3)
    assert {r["key"]: [(n["d2"], n["key"]) for n in r["neighbours"]] for r in got.collect()} == brute_force(frame, frame, 3)
    assert "Union" in got._jdf.queryExecution().optimizedPlan().toString()


def test_right_vectors_are_dealt_once_and_few_left_ones_go_on(spark, monkeypatch):
    """Cells grow in number with the rows, so that neither side is copied to all blocks of a crowded cell."""
    monkeypatch.setattr(nb, "RIGHT_BLOCK", 200)
    monkeypatch.setattr(nb, "FEW_CELLS", 1)
    df = spark.createDataFrame(points(6000, 2, 7), "key long, label string, vec array<double>").withColumn("grp", F.lit(0))
    folded = nb._numbered(nb._fold_equal_vectors(df, 4)).persist()
    n = folded.count()
    cells = nb._find_cells(folded, n, n)
    counts = nb._counts(folded, cells, 1)
    assert counts.sum() == n and counts.max() <= 400 and counts.shape[1] >= n / 200
    many = -(-counts // nb.RIGHT_BLOCK)
    blocks = nb._Blocks(cells, nb._homes(cells, counts, 4), np.cumsum(many, axis=1) - many, many)
    parts = np.ones((1, many.sum()), np.int64)
    assert blocks.dealt(folded, parts, False).count() == n
    found = nb._searched_first(folded.withColumn("n_rows", F.lit(1)), folded, blocks, 4, nb._list_type(df, True))
    visits = found.agg(F.count("id").alias("n"), F.sum(F.size("away")).alias("visits")).first()
    assert visits["n"] == n and visits["visits"] < n


def test_groups_with_few_and_without_right_rows(spark, monkeypatch):
    monkeypatch.setattr(nb, "VECTORS_PER_CELL", 20)
    frame = points(300, 2, 9)
    parts = {0: frame, 1: frame.iloc[:4], 2: frame.iloc[:0]}
    right = spark.createDataFrame(pd.concat([f.assign(grp=g) for g, f in parts.items()]), "key long, label string, vec array<double>, grp int")
    left = spark.createDataFrame(pd.concat([frame.iloc[:40].assign(grp=g) for g in parts]), "key long, label string, vec array<double>, grp int")
    got = {(r["grp"], r["key"]): r["neighbours"] for r in nb.nearest(left, right, 5, 3).collect()}
    assert len(got) == 120
    for g in (0, 1):
        for key, near in brute_force(frame.iloc[:40], parts[g], 5).items():
            assert [(n["d2"], n["key"]) for n in got[g, key]] == near
    assert all(near is None for (g, _), near in got.items() if g == 2)


def test_missing_feature_is_an_error(spark):
    df = spark.createDataFrame([(1, None), (2, 1.0)], "id int, x double")
    with pytest.raises(Exception, match="missing value"):
        df.select(nb.vector(["x"])).collect()


@pytest.fixture(scope="module")
def uneven(spark):
    rng = np.random.RandomState(1)
    frame = pd.DataFrame({"id": np.arange(300), "x": rng.normal(size=300), "z": rng.normal(size=300)})
    frame["y"] = (frame.x + 0.5 * rng.normal(size=300) > 1.2).astype(int)
    return frame


@pytest.mark.parametrize("name", ["SMOTE", "BorderlineSMOTE"])
def test_classes_become_equal_and_points_lie_between(spark, uneven, name):
    df = spark.createDataFrame(uneven)
    out = oversample.get_sampler(name)(df, ["x", "z"], "y", "id").toPandas()
    counts = out.groupby("y").size()
    assert counts[0] == counts[1] == (uneven.y == 0).sum()
    original = out[out["copy"] == 0].sort_values("id")
    assert original.x.tolist() == uneven.x.tolist()
    made, minor = out[out["copy"] > 0], uneven[uneven.y == 1]
    assert made.x.between(minor.x.min(), minor.x.max()).all()
    repeat = oversample.get_sampler(name)(df.repartition(7), ["x", "z"], "y", "id").toPandas()
    order = ["id", "copy"]
    pd.testing.assert_frame_equal(out.sort_values(order).reset_index(drop=True), repeat.sort_values(order).reset_index(drop=True))


def test_borderline_without_danger_rows_changes_nothing(spark):
    df = spark.range(60).select(
        "id", (F.col("id") + F.when(F.col("id") < 15, 1000).otherwise(0)).cast("double").alias("x"),
        (F.col("id") < 15).cast("int").alias("y"))
    assert oversample.borderline_smote(df, ["x"], "y", "id").count() == 60


def test_balanced_small_and_unknown(spark):
    even = spark.range(20).select("id", F.col("id").cast("double").alias("x"), (F.col("id") % 2).cast("int").alias("y"))
    assert oversample.smote(even, ["x"], "y", "id").count() == 20
    few = even.withColumn("y", (F.col("id") < 3).cast("int"))
    with pytest.raises(ValueError):
        oversample.smote(few, ["x"], "y", "id")
    with pytest.raises(ValueError):
        oversample.get_sampler("ADASYN")
    assert oversample.get_sampler(None) is None
