"""Encoding of columns with more categories than a plan can hold, against the path for few categories."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from sparkrisk.operators import strata
from sparkrisk.operators.encode import TableEncoder, TableEncoderModel, assemble
from sparkrisk.operators.oversample import smote
from sparkrisk.plans.train import TrainingPipeline, cross_validate
from sparkrisk.session import materialize, scratch_path
from sparkrisk.spec import FeatureSpec


@pytest.fixture(scope="module")
def table(spark):
    """Texts, integers and decimals; one value fills a third of a column; missing cells in each."""
    rows = [(k, f"n{k % 23}" if k % 3 else "hot", None if k % 11 == 0 else k % 17 - 8, None if k % 7 == 0 else (k % 13) / 4, float(k)) for k in range(600)]
    return materialize(spark.createDataFrame(rows, "id long, name string, whole int, part double, x double").repartition(5), "category-rows")


def encoder(**more):
    return TableEncoder(numeric=["x"], nominal=["name", "whole"], ordinal=["part"], **more)


def cells(df):
    """Rows by id, vectors written out."""
    wide = df.select("id", "x", "part", *[vector_to_array(c).alias(c) if t == "vector" else c for c, t in df.dtypes if c not in ("id", "x", "part")])
    return {r["id"]: [v for c in wide.columns for v in (r[c] if isinstance(r[c], list) else [r[c]])] for r in wide.collect()}


@pytest.mark.parametrize("broadcast", [strata.BROADCAST_BYTES, 0])
def test_dictionaries_give_the_same_codes(table, monkeypatch, broadcast):
    monkeypatch.setattr(strata, "BROADCAST_BYTES", broadcast)
    unseen = table.limit(3).withColumns({"name": F.lit("never"), "whole": F.lit(77), "part": F.lit(0.3)})
    literal, model = encoder().fit(table), encoder(literalCategories=5).fit(table)
    assert model.feature_names == ["x", "name", "whole", "part"]
    assert model.transform(table).columns == ["x", "name", "whole", "part", "id"]
    for rows in (table, unseen):
        assert cells(model.transform(rows)) == cells(literal.transform(rows))


def test_one_column_may_be_literal_and_another_not(table):
    mixed = encoder(literalCategories=15).fit(table)
    assert cells(mixed.transform(table)) == cells(encoder().fit(table).transform(table))
    assert mixed.feature_names == ["x", "name", "whole", "part"] and len(mixed.dictionary_parts) == 2


def test_a_saved_dictionary_does_not_need_the_first_one(spark, table):
    model = encoder(literalCategories=5).fit(table)
    path = scratch_path(spark, "encoder")
    model.write().overwrite().save(path)
    again = TableEncoderModel.load(path)
    assert {p["dictionary"] for p in again.dictionary_parts} == {f"{path}/categories"}
    assert cells(again.transform(table)) == cells(model.transform(table))


def test_hundred_thousand_categories(spark):
    """Ranks are exact, the vectors are sparse and the plan is as long as for few categories."""
    def rows(n):
        return spark.range(3 * n // 2).select(F.when(F.col("id") < n, F.col("id")).otherwise(F.lit(7)).alias("v")).select(
            "v", F.lpad(F.col("v").cast("string"), 7, "0").alias("nominal"), F.col("v").alias("ordinal"))

    plans = []
    for n in (2_000, 100_000):
        made = TableEncoder(nominal=["nominal"], ordinal=["ordinal"]).fit(rows(n)).transform(rows(n))
        plans.append(len(made._jdf.queryExecution().optimizedPlan().toString()))
    assert abs(plans[1] - plans[0]) < 100
    made = materialize(made, "many-categories")
    assert made.count() == 150_000 and made.where("ordinal <> v").count() == 0
    vector = made.where("v = 99999").select("nominal").first()[0]
    assert vector.size == 99_999 and list(vector.indices) == [99_998] and list(vector.values) == [1.0]
    assert made.where("v = 0").select("nominal").first()[0].numNonzeros() == 0
    features = assemble(made.where("v = 7"), ["ordinal", "nominal"]).first()["features"]
    assert features.size == 100_000 and {int(i): x for i, x in zip(features.indices, features.values)} == {0: 7.0, 7: 1.0}


def test_empty_columns_and_tables(spark, table):
    model = encoder(literalCategories=1).fit(table.withColumn("name", F.lit(None).cast("string")))
    assert model.feature_names == ["x", "whole", "part"]
    assert model.transform(table.limit(0)).count() == 0
    assert encoder(literalCategories=1).fit(table.limit(0)).feature_names == []


def test_models_and_samplers_take_the_vectors(spark, table):
    df = table.withColumn("y", (F.col("id") % 5 == 0).cast("int")).withColumn("whole", F.coalesce("whole", F.lit(0)))
    encoded = encoder(literalCategories=5).fit(df).transform(df)
    balanced = smote(encoded, ["x", "name", "part"], "y", "id")
    assert balanced.columns == ["id", "x", "name", "part", "y", "copy"]
    assert {r["y"]: r["count"] for r in balanced.groupBy("y").count().collect()} == {0: 480, 1: 480}
    spec = FeatureSpec(numeric=("x",), nominal=("name", "whole"), ordinal=("part",), target="y", rules={}, outlier_columns=())
    steps = Pipeline(stages=[encoder(literalCategories=5)])
    pipeline = TrainingPipeline(model="logistic_regression", key="id", spec=spec, preprocessor=steps, sampler="SMOTE")
    scored = pipeline.fit(df).transform(df)
    assert scored.count() == 600
    rows = {r["metric"]: r for r in cross_validate(df, pipeline, 2, 1).collect()}
    assert rows and all(0 <= r["test_mean"] <= 1 for r in rows.values())
