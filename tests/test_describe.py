import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import by_key
from sparkrisk.operators import describe


@pytest.fixture(scope="module")
def frame():
    rng = np.random.RandomState(5)
    out = pd.DataFrame({"a": rng.normal(size=200), "b": rng.randint(0, 9, 200).astype(float), "c": 3.0})
    out["d"] = 2 * out.a + rng.normal(size=200)
    out.loc[::7, "b"] = np.nan
    return out


@pytest.fixture(scope="module")
def table(spark, frame):
    rows = frame.astype(object).where(frame.notna(), None).values.tolist()
    return spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(3)


def test_describe_equals_pandas(table, frame):
    got = by_key(describe.describe(table), "column")
    for c in frame:
        expected = frame[c].describe()
        assert [got[c][k] for k in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")] == pytest.approx(
            expected.tolist(), abs=1e-12)


def test_filtered_describe(table, frame):
    got = by_key(describe.describe(table, ["a"], where=F.col("a") < 0.5), "column")["a"]
    assert got["count"] == (frame.a < 0.5).sum() and got["q50"] == pytest.approx(frame.a[frame.a < 0.5].median())


def test_histogram_equals_numpy(table, frame):
    got = describe.histogram(table).toPandas()
    for c in frame:
        counts, edges = np.histogram(frame[c].dropna(), bins=30)
        mine = got[got.column == c].set_index("bin")["n"].reindex(range(30), fill_value=0)
        assert mine.tolist() == counts.tolist()
        first = got[(got.column == c)].sort_values("bin").iloc[0]
        assert first["left"] == pytest.approx(edges[first["bin"]])


def test_correlation_equals_pandas(table, frame):
    got = {(r["x"], r["y"]): r["r"] for r in describe.correlation(table).collect()}
    expected = frame.corr()
    for x in frame:
        for y in frame:
            if "c" in (x, y):
                assert got[x, y] is None
            else:
                assert got[x, y] == pytest.approx(expected.loc[x, y], abs=1e-12)


def test_correlation_of_a_pair_that_is_constant_where_both_are_present(spark):
    df = spark.createDataFrame([(1.0, 5.0), (1.0, 6.0), (2.0, None)], "x double, y double")
    got = {(r["x"], r["y"]): r["r"] for r in describe.correlation(df).collect()}
    assert got["x", "y"] is None and got["y", "y"] == pytest.approx(1.0)


def test_correlation_takes_only_numeric_columns(spark):
    df = spark.createDataFrame([(1.0, "t"), (2.0, "u")], "x double, t string")
    assert describe.correlation(df).count() == 1


def test_box_stats(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0, None]
    df = spark.createDataFrame([(v, "t") for v in values], "v double, t string")
    got = describe.box_stats(df, ["v", "t", "absent"]).collect()
    assert len(got) == 1
    assert got[0].asDict() == {"column": "v", "q1": 2.25, "median": 3.5, "q3": 4.75,
                               "whisker_low": 1.0, "whisker_high": 5.0, "fliers": 1}


def test_category_histogram(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (None, "x")], "a int, b string")
    got = {(r["column"], r["value"]): r["n"] for r in describe.category_histogram(df, ["a", "b"]).collect()}
    assert got == {("a", "1"): 2, ("b", "x"): 2, ("b", "y"): 1}
