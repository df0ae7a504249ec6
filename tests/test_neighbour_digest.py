"""Vectors are sorted and joined by a number first; where it is equal the vectors themselves decide."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkrisk.operators import neighbours as nb


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.RandomState(7)
    x = rng.randint(0, 4, (120, 3)).astype(float)
    x[x[:, 0] == 0, 0] = rng.choice([0.0, -0.0], int((x[:, 0] == 0).sum()))  # one vector, written in two ways
    rows = pd.DataFrame({"grp": np.arange(120) % 2, "key": np.arange(120), "label": (np.arange(120) % 3 == 0).astype(int).astype(str), "vec": list(x)})
    return spark.createDataFrame(rows).withColumn("grp", F.col("grp").cast("int")).repartition(3).persist()


def lists(points, k=4):
    found = nb.nearest(points, points, k, groups=2, vectors=False).collect()
    return {r["key"]: [(n["d2"], n["key"]) for n in r["neighbours"]] for r in found}


def expected(points, k=4):
    rows = points.collect()
    out = {}
    for r in rows:
        apart = [(sum((a - b) ** 2 for a, b in zip(r["vec"], s["vec"])), s["key"]) for s in rows if s["grp"] == r["grp"] and s["key"] != r["key"]]
        out[r["key"]] = sorted(apart)[:k]
    return out


def test_sorts_begin_with_a_number(points):
    for table in (nb._fold_equal_vectors(points, 3), nb._attach(points, points.select("grp", "vec", F.lit(1).alias("n_rows"), F.array(F.struct("key")).alias("near")).hint("merge"), 120, 1, 2)):
        sorts = [line.split("Sort [", 1)[1] for line in table._jdf.queryExecution().executedPlan().toString().splitlines() if "Sort [" in line]
        assert sorts and all(s.startswith("digest#") for s in sorts)


def test_neighbours_are_those_of_all_pairs(points):
    assert lists(points) == expected(points)


def test_different_vectors_of_one_number_stay_apart(points, monkeypatch):
    monkeypatch.setattr(nb, "_digest", lambda: F.lit(1).cast("bigint"), raising=True)
    assert lists(points) == expected(points)
