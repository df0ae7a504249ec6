import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkrisk.operators import stats

PROBS = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]


@pytest.mark.parametrize("limit", [100_000, 40, 2])
def test_quantiles_equal_pandas_on_both_paths(spark, limit):
    rng = np.random.RandomState(0)
    values = np.concatenate([rng.lognormal(size=3000), np.full(2000, 1.25), rng.randint(0, 5, 1000)])
    frame = pd.DataFrame({"a": values, "b": rng.randint(0, 3, len(values))})
    got = stats.quantiles(spark.createDataFrame(frame).repartition(4), ["a", "b"], PROBS, limit)
    for c in "ab":
        assert got[c]["q"] == pytest.approx(frame[c].quantile(PROBS).tolist(), rel=1e-12)
        assert (got[c]["count"], got[c]["min"], got[c]["max"]) == (6000, frame[c].min(), frame[c].max())


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.floats(-1e6, 1e6), st.sampled_from([0.0, 7.0])), min_size=1, max_size=60))
def test_narrowing_is_exact(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = stats.quantiles(df, ["v"], [0.1, 0.5, 0.9], direct_limit=0)["v"]["q"]
    assert got == pytest.approx(pd.Series(values).quantile([0.1, 0.5, 0.9]).tolist(), rel=1e-9, abs=1e-9)


def test_quantiles_ignore_missing_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (2.0,), (3.0,), (4.0,)], "v double")
    got = stats.quantiles(df, ["v"], [0.25, 0.75])["v"]
    assert got["count"] == 4 and got["q"] == [1.75, 3.25]


def test_quantiles_of_an_empty_column(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert stats.quantiles(df, ["v"], [0.5])["v"] == {"count": 0, "min": None, "max": None, "q": [None]}


def test_modes_take_the_smallest_on_ties(spark):
    df = spark.createDataFrame([(3, "b"), (1, "a"), (3, "a"), (1, "b"), (2, None)], "n int, s string")
    assert stats.modes(df, ["n", "s"]) == {"n": 1.0, "s": "a"}


def test_legal_modes_skip_illegal_and_absent(spark):
    df = spark.createDataFrame([(9, 5), (9, 6), (2, 7)], "a int, b int")
    assert stats.legal_modes(df, {"a": [1, 2], "b": [1], "c": [1]}) == {"a": 2}


def test_stat_table_is_one_aggregation(spark):
    df = spark.range(10)
    table = stats.stat_table(df, "column", {"id": {"n": F.count("id"), "top": F.max("id")}})
    assert table.first().asDict() == {"column": "id", "n": 10, "top": 9}
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
