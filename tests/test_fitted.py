"""Imputation, outliers, encoding and their pipelines."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from conftest import by_key, column
from sparkrisk.operators import outliers
from sparkrisk.operators.encode import TableEncoder, assemble
from sparkrisk.operators.impute import IllegalToMode, MissingFill
from sparkrisk.operators.outliers import OutlierCapper
from sparkrisk.plans.features import feature_names, feature_pipeline, load_preprocessor, prepare_features, preprocess
from sparkrisk.spec import FeatureSpec

RULES = {"cat1": [1, 2, 3], "cat2": [10, 20, 30]}


@pytest.fixture(scope="module")
def ruled(spark):
    rows = [(1, 10, 1.5), (2, 999, 2.5), (99, 20, 3.5), (3, 30, 4.5), (1, 10, 5.5)]
    return spark.createDataFrame(rows, "cat1 int, cat2 int, num1 double")


def test_illegal_values_become_the_legal_mode(ruled):
    model = IllegalToMode(rules=RULES).fit(ruled)
    assert model.modes == {"cat1": 1, "cat2": 10}
    out = model.transform(ruled)
    assert column(out, "cat1") == [1, 2, 1, 3, 1] and column(out, "cat2") == [10, 10, 20, 30, 10]
    assert out.schema == ruled.schema
    assert model.transform(out).collect() == out.collect()
    assert {r["column"]: r["imputed"] for r in model.report(ruled).collect()} == {"cat1": 1, "cat2": 1}


def test_mode_over_all_values_may_be_illegal(spark):
    df = spark.createDataFrame([(9,), (9,), (1,), (None,)], "c int")
    assert column(IllegalToMode(rules={"c": [1]}, modeOver="all").fit(df).transform(df), "c") == [9, 9, 1, 9]
    assert column(IllegalToMode(rules={"c": [1]}).fit(df).transform(df), "c") == [1, 1, 1, 1]
    assert column(IllegalToMode(rules={"c": [5]}).fit(df).transform(df), "c") == [9, 9, 1, None]


def test_missing_fill(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (3.0, "b"), (4.0, None), (None, "a")], "n double, s string")
    out = MissingFill(median=["n"], mode=["s"]).fit(df).transform(df)
    assert column(out, "n")[-1] == 2.5 and column(out, "s")[3] == "a"


@pytest.fixture(scope="module")
def spread():
    rng = np.random.RandomState(42)
    return pd.DataFrame({
        "var1": np.concatenate([rng.normal(50, 10, 95), [0, 100, 150, 200, 250]]), "var2": rng.normal(size=100)})


@pytest.mark.parametrize("method", ["IQR", "Percentiles"])
def test_capping(spark, spread, method):
    df = spark.createDataFrame(spread)
    model = OutlierCapper(columns=["var1", "var2"], method=method).fit(df)
    low, high = (0.25, 0.75) if method == "IQR" else (0.05, 0.95)
    q = spread["var1"].quantile([low, high]).tolist()
    expected = outliers.fence(*q) if method == "IQR" else tuple(q)
    assert model.limits["var1"] == pytest.approx(list(expected))
    out = model.transform(df).toPandas()
    assert out["var1"].tolist() == pytest.approx(spread["var1"].clip(*expected).tolist())
    assert out["var1"].max() < 250 and out.shape == spread.shape


def test_capper_arguments(spark):
    with pytest.raises(ValueError):
        OutlierCapper(method="other")
    df = spark.createDataFrame([("x", 1)], "t string, n int")
    assert list(OutlierCapper(columns=["t", "n"]).fit(df).limits) == ["n"]
    with pytest.raises(ValueError):
        OutlierCapper(columns=["absent"]).fit(df)
    with pytest.raises(RuntimeError):
        OutlierCapper(columns=["n"]).transform(df)


def test_missing_values_stay_missing_when_capped(spark):
    df = spark.createDataFrame([(float(v),) for v in range(20)] + [(1000.0,), (None,)], "v double")
    out = column(OutlierCapper(columns=["v"]).fit(df).transform(df), "v")
    assert out[-1] is None and out[-2] < 1000


def test_cascaded_removal_and_mean_replacement(spark, spread):
    df = spark.createDataFrame(spread)
    left, steps = outliers.remove_outliers(df, ["var1", "var2"])
    expected = spread
    sizes = []
    for c in ("var1", "var2"):
        lo, hi = outliers.fence(*expected[c].quantile([0.25, 0.75]))
        expected = expected[expected[c].between(lo, hi)]
        sizes.append(len(expected))
    assert left.count() == sizes[-1]
    assert [r["rows_left"] for r in outliers.removal_report(df, steps).orderBy("step").collect()] == sizes
    lo, hi = outliers.fence(*spread["var1"].quantile([0.25, 0.75]))
    mean = spread.loc[spread["var1"].between(lo, hi), "var1"].mean()
    out = outliers.outliers_to_mean(df, ["var1"]).toPandas()["var1"]
    assert out.tolist() == pytest.approx(spread["var1"].where(spread["var1"].between(lo, hi), mean).tolist())


def test_mean_replacement_can_stop_at_the_first_clean_column(spark):
    df = spark.createDataFrame([(1.0, float(v)) for v in [1, 2, 3, 4, 5, 900]], "clean double, odd double")
    assert outliers.outliers_to_mean(df, ["clean", "odd"], stop_at_first_clean=True).collect() == df.collect()
    assert outliers.outliers_to_mean(df, ["clean", "odd"]).agg(F.max("odd")).first()[0] == 5.0


def test_detection_and_report(spark, spread):
    df = spark.createDataFrame(spread)
    n = outliers.detect_outliers(df, "var1").count()
    report = {r["column"]: r["outliers"] for r in outliers.outlier_report(df, ["var1"]).collect()}
    assert report == {"var1": n, "TOTAL": n} and n >= 4


def test_encoder_values_match_the_conventions(spark):
    train = spark.createDataFrame(
        [(0.0, 10, 3, 7.0, "k"), (10.0, 20, 1, 7.0, "k"), (None, None, None, 7.0, "k"), (4.0, 20, 5, 7.0, "k")],
        "n double, nom int, ord int, constant double, rest string")
    model = TableEncoder(numeric=["n", "constant"], nominal=["nom"], ordinal=["ord"]).fit(train)
    out = model.transform(train)
    assert model.feature_names == ["n", "constant", "nom_20", "ord"]
    assert out.columns == ["n", "constant", "nom_20", "ord", "rest"]
    assert column(out, "n") == pytest.approx([1.0, 2.0, 1.4, 1.4])
    assert column(out, "constant") == [1.0] * 4
    assert column(out, "nom_20") == [0.0, 1.0, 1.0, 1.0]
    assert column(out, "ord") == [1.0, 0.0, 0.0, 2.0]
    unseen = spark.createDataFrame([(20.0, 77, 99, 8.0, "k")], train.schema)
    assert model.transform(unseen).first()[:4] == (3.0, 2.0, 0.0, -1.0)


def test_encoder_adds_columns_keeps_rows_and_needs_fit(mixed_table, mixed_spec):
    out = preprocess(mixed_table, mixed_spec)
    assert out.count() == 100 and len(out.columns) > len(mixed_table.columns)
    assert {"row_id", "target"} <= set(out.columns)
    with pytest.raises(RuntimeError):
        TableEncoder(numeric=["num1"]).transform(mixed_table)
    vectors = assemble(out, ["num1", "num2"])
    assert vectors.first()["features"].size == 2


def test_steps_one_to_three(mixed_spec):
    for illegal in (True, False):
        for caps in (True, False):
            assert len(feature_pipeline(mixed_spec, illegal, caps).getStages()) == 1 + illegal + caps


def test_pipeline_is_projections_only_and_survives_saving(spark, mixed_table, mixed_spec, tmp_path):
    path = str(tmp_path / "pre")
    train, test, fitted = prepare_features(mixed_table, mixed_table.limit(10), mixed_spec, save_to=path)
    again = load_preprocessor(spark, path)
    assert isinstance(again, PipelineModel) and feature_names(again) == feature_names(fitted)
    assert by_key(again.transform(mixed_table), "row_id") == by_key(train, "row_id")
    assert test.count() == 10
    plan = fitted.transform(mixed_table)._jdf.queryExecution().optimizedPlan().toString()
    # One narrow stage; an imputed cell that several codes look at is computed once.
    assert plan.count("Project") <= 2 and "Join" not in plan and "Aggregate" not in plan
    with pytest.raises(FileNotFoundError):
        load_preprocessor(spark, str(tmp_path / "none"))


def test_spec_rejects_double_listing():
    with pytest.raises(ValueError):
        FeatureSpec(numeric=("a",), ordinal=("a",), nominal=())
    assert len(FeatureSpec().features) == 20
