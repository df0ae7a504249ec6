"""Training, scoring, persistence, explanations, streaming."""

import json

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import by_key
from sparkrisk.operators import explain, metrics
from sparkrisk.operators.models import REGISTRY, FourierFeatures, get_model, register_model
from sparkrisk.plans import score, train
from sparkrisk.plans.features import feature_names
from sparkrisk.session import learning_rows
from sparkrisk.sources.files import predictions_table
from sparkrisk.spec import METRICS_WITHOUT_AP, SEED
from sparkrisk.streaming import score_stream, score_stream_in_batches


@pytest.fixture(scope="module")
def fitted(mixed_table, mixed_spec):
    return train.train(mixed_table, "row_id", mixed_spec, sampler=None, evaluate=False)[0]


def test_registry(spark):
    assert {"logistic_regression", "decision_tree", "random_forest", "svm", "xgboost", "mlp"} <= set(REGISTRY)
    with pytest.raises(ValueError):
        get_model("nope", 1, 1)
    register_model("lr_again", "Again", REGISTRY["logistic_regression"].build)
    try:
        assert get_model("lr_again", 10, 2).getRegParam() == 0.1
    finally:
        del REGISTRY["lr_again"]


def test_steps(mixed_spec):
    with_sampler = train.TrainingPipeline(key="row_id", spec=mixed_spec)
    assert with_sampler.steps == ["preprocessor", "sampler", "model"]
    assert train.TrainingPipeline(key="row_id", spec=mixed_spec, sampler=None).steps == ["preprocessor", "model"]


def test_logistic_regression_is_the_penalised_optimum(fitted, mixed_table):
    """Newton's method on sum of losses + |w|^2 / 2 gives the same weights."""
    prepared = fitted.stages[0]
    names = feature_names(prepared)
    frame = prepared.transform(mixed_table).toPandas()
    x = np.column_stack([frame[names].to_numpy(float), np.ones(len(frame))])
    y = frame["target"].to_numpy(float)
    penalty = np.diag([1.0] * len(names) + [0.0])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, x.T @ (p - y) + penalty @ w)
    coefficients, intercept = explain.linear_of(fitted, names)
    assert [coefficients[n] for n in names] == pytest.approx(w[:-1].tolist(), abs=1e-4)
    assert intercept == pytest.approx(w[-1], abs=1e-4)


def test_scores_and_ranges(fitted, mixed_table):
    scored = score.predict_proba(fitted, mixed_table)
    row = scored.agg(F.min("y_proba").alias("lo"), F.max("y_proba").alias("hi"),
                     F.collect_set("y_pred").alias("classes"), F.count("*").alias("n")).first()
    assert 0 <= row["lo"] <= row["hi"] <= 1 and set(row["classes"]) <= {0, 1} and row["n"] == 100
    a = by_key(score.batch_predict(fitted, mixed_table, 10, proba=True), "row_id")
    assert a == by_key(scored, "row_id")


def test_saved_model_predicts_the_same(spark, fitted, mixed_table, tmp_path):
    path = str(tmp_path / "model")
    fitted.write().overwrite().save(path)
    again = train.load_model(spark, path)
    assert by_key(again.transform(mixed_table), "row_id") == by_key(fitted.transform(mixed_table), "row_id")
    with pytest.raises(FileNotFoundError):
        train.load_model(spark, str(tmp_path / "none"))


@pytest.mark.parametrize("model", ["decision_tree", "random_forest", "svm"])
def test_other_models(spark, mixed_table, mixed_spec, model, tmp_path):
    fitted, _ = train.train(mixed_table, "row_id", mixed_spec, model, sampler=None, evaluate=False, save_to=str(tmp_path / "m"))
    scored = fitted.transform(mixed_table)
    assert scored.where(F.col("y_pred").isin(0, 1)).count() == 100
    if model == "svm":
        with pytest.raises(AttributeError):
            score.predict_proba(fitted, mixed_table)
    assert by_key(train.load_model(spark, str(tmp_path / "m")).transform(mixed_table), "row_id") == by_key(scored, "row_id")


def test_resampling_happens_in_fit_only(mixed_table, mixed_spec):
    seen = []

    def doubled(df, features, target, key):
        seen.append(df.count())
        return df.unionByName(df)

    pipeline = train.TrainingPipeline(key="row_id", spec=mixed_spec, sampler=doubled)
    assert pipeline.fit(mixed_table).transform(mixed_table).count() == 100 and seen == [100]


def test_borderline_training(mixed_table, mixed_spec):
    fitted, _ = train.train(mixed_table, "row_id", mixed_spec, sampler="BorderlineSMOTE", evaluate=False)
    assert fitted.transform(mixed_table).count() == 100


def test_cross_validation_and_result_document(spark, mixed_table, mixed_spec, tmp_path):
    pipeline = train.TrainingPipeline(key="row_id", spec=mixed_spec, sampler=None)
    summary = train.cross_validate(mixed_table, pipeline, folds=2, repeats=2).persist()
    rows = by_key(summary, "metric")
    assert len(rows) == 7 and all(0 <= r["test_mean"] <= 1 and r["test_std"] >= 0 for r in rows.values())
    assert rows["roc_auc"]["train_mean"] > 0.5
    train.save_results(summary, "logistic_regression", str(tmp_path / "r"))
    text = spark.read.text(str(tmp_path / "r")).first()[0]
    doc = json.loads(text)
    assert doc["model_display_name"] == "Logistic Regression" and doc["config"]["smote_config"]["m_neighbors"] == 10
    assert set(doc["metrics"]["f1"]) == {"test_mean", "test_std", "train_mean", "train_std"}
    own = {"hit_share": F.avg((F.col("y_true") == F.col("y_pred")).cast("double"))}
    few = by_key(train.cross_validate(mixed_table, pipeline, 2, 1, metric_names=METRICS_WITHOUT_AP, scorers=own), "metric")
    assert len(few) == 7 and few["hit_share"]["test_mean"] == pytest.approx(few["accuracy"]["test_mean"])


def test_sweep_and_leaderboard(mixed_table, mixed_spec):
    table = train.sweep(mixed_table, "row_id", ["logistic_regression", "decision_tree"], mixed_spec, [None], 2, 1)
    assert metrics.leaderboard(table).count() == 2


def test_score_jobs(spark, fitted, mixed_table, tmp_path):
    got = score.score_job(fitted, mixed_table, str(tmp_path / "a"), truth="target").first()
    assert set(got["confusion_matrix"].asDict()) == {
        "true_negatives", "false_positives", "false_negatives", "true_positives"}
    assert spark.read.parquet(str(tmp_path / "a/predictions")).columns == ["y_true", "y_pred", "y_proba"]
    for proba, name in ((False, "y_pred"), (True, "y_proba")):
        out = str(tmp_path / name)
        assert score.score_job(fitted, mixed_table, out, proba=proba) is None
        assert spark.read.parquet(out + "/predictions").columns == [name]


def test_report_bundle(fitted, mixed_table):
    parts = score.report_bundle(fitted.transform(mixed_table), truth="target")
    assert set(parts) == {"confusion", "roc", "precision_recall", "classes"}
    assert parts["confusion"].agg(F.sum("n")).first()[0] == 100


def test_fourier_features_approach_the_kernel(spark):
    from pyspark.ml.linalg import Vectors
    x = np.random.RandomState(0).normal(size=(20, 3))
    df = spark.createDataFrame([(Vectors.dense(r),) for r in x], ["features"])
    z = np.array([r["kernel_features"].toArray() for r in FourierFeatures(inputSize=3, width=8000, gamma=0.5).transform(df).collect()])
    exact = np.exp(-0.5 * ((x[:, None] - x[None, :]) ** 2).sum(-1))
    assert np.abs(z @ z.T - exact).max() < 0.08


def test_linear_attributions_add_up(fitted, mixed_table):
    prepared = fitted.stages[0]
    names = feature_names(prepared)
    encoded = prepared.transform(mixed_table)
    w, b = explain.linear_of(fitted, names)
    means = explain.background_means(encoded, names, "row_id", 50)
    base = explain.linear_base(w, b, means)
    wide = explain.linear_shap(encoded, w, means, "row_id").toPandas().set_index("row_id")
    logit = explain.linear_scores(encoded, w, b).select("row_id", "y_score").toPandas().set_index("row_id")["y_score"]
    model = fitted.transform(mixed_table).select("row_id", "y_score").toPandas().set_index("row_id")["y_score"]
    assert (wide.sum(axis=1) + base).sort_index().tolist() == pytest.approx(logit.sort_index().tolist())
    assert logit.sort_index().tolist() == pytest.approx(model.sort_index().tolist())
    long = explain.linear_shap_long(encoded, w, means, "row_id")
    importance = by_key(explain.shap_importance(long), "feature")
    assert importance["num1"]["importance"] == pytest.approx(wide["num1"].abs().mean())
    best = explain.best_feature(long).first()[0]
    assert best == wide.abs().mean().idxmax() and explain.shap_dependence(long).count() == 100
    local = explain.shap_local(long, "row_id", 3, base).first()
    assert local["output"] == pytest.approx(logit[3])
    assert explain.importance_of(fitted, names, mixed_table.sparkSession).count() == len(names)


def test_tree_attributions_are_exact_shapley_values(mixed_table, mixed_spec):
    from itertools import combinations
    from math import factorial
    small = REGISTRY["xgboost"].build
    register_model("few_trees", "Few", lambda n, d: small(n, d).setMaxIter(3))
    try:
        fitted, _ = train.train(mixed_table, "row_id", mixed_spec, "few_trees", sampler=None, evaluate=False)
    finally:
        del REGISTRY["few_trees"]
    model, names = explain.boosted_trees_of(fitted), feature_names(fitted.stages[0])
    encoded = fitted.stages[0].transform(mixed_table)
    got = explain.tree_shap(encoded, model, names, "row_id").toPandas().set_index("row_id")
    raw = fitted.transform(mixed_table).select("row_id", "y_score").toPandas().set_index("row_id")["y_score"]
    # The model's raw prediction is twice the margin of the added trees.
    ratio = raw.sort_index() / got["margin"].sort_index()
    assert ratio.tolist() == pytest.approx([ratio.iloc[0]] * 100) and ratio.iloc[0] in (pytest.approx(1), pytest.approx(2))
    leaves = explain.leaf_paths(model)
    used = sorted({f for leaf in leaves for f, *_ in leaf["path"]})
    x = encoded.orderBy("row_id").toPandas()[names].to_numpy(float)

    def value(row, known):
        total = 0.0
        for leaf in leaves:
            reach = 1.0
            for f, threshold, left, share in leaf["path"]:
                reach *= float((row[f] <= threshold) == left) if f in known else share
            total += leaf["value"] * reach
        return total

    for i in (0, 17):
        for f in used:
            rest = [g for g in used if g != f]
            phi = sum(
                factorial(n) * factorial(len(rest) - n) / factorial(len(used))
                * (value(x[i], {*s, f}) - value(x[i], set(s)))
                for n in range(len(rest) + 1) for s in combinations(rest, n))
            assert got.sort_index().iloc[i][names[f]] == pytest.approx(phi, abs=1e-9)
    assert explain.tree_shap_long(encoded, model, names, "row_id").count() == 100 * len(names)


def test_streams_score_like_batches(spark, fitted, mixed_table, tmp_path):
    source = str(tmp_path / "in")
    mixed_table.repartition(3).write.parquet(source)
    expected = by_key(fitted.transform(mixed_table), "row_id")
    for name, start in (("a", score_stream), ("b", score_stream_in_batches)):
        rows = spark.readStream.schema(mixed_table.schema).option("maxFilesPerTrigger", 1).parquet(source)
        query = start(rows, fitted, str(tmp_path / name), str(tmp_path / f"{name}-checkpoint"))
        query.awaitTermination()
        got = spark.read.parquet(str(tmp_path / name))
        assert by_key(got.drop("batch"), "row_id") == expected


def test_predictions_table(spark):
    df = spark.createDataFrame([(1, 1, 0.7)], "target int, y_pred int, y_proba double")
    assert predictions_table(df, "target").columns == ["y_true", "y_pred", "y_proba"]
    assert predictions_table(df.drop("y_proba"), "target").columns == ["y_true", "y_pred"]


def test_learners_get_a_part_for_each_core(spark):
    """One file of one row group is one part; few rows stay as they are."""
    one = spark.range(50_000).select(F.col("id").cast("double").alias("x")).coalesce(1)
    with learning_rows(one) as (rows, n):
        assert n == 50_000 and rows.rdd.getNumPartitions() == 3 and rows.storageLevel.useMemory
        assert rows.agg(F.sum("x")).first()[0] == 50_000 * 49_999 / 2
    assert not rows.is_cached and not one.is_cached
    with learning_rows(one, at_once=spark.sparkContext.defaultParallelism) as (rows, n):
        assert n == 50_000 and rows.rdd.getNumPartitions() == 1
    with learning_rows(one.limit(1_000)) as (rows, n):
        assert n == 1_000 and rows.rdd.getNumPartitions() == 1


def test_fourier_features_of_each_row(spark):
    """The mapped rows are those of the formula, in batches of any size and in empty parts."""
    x = np.random.RandomState(4).normal(size=(25_000, 3))
    rows = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "id int, a double, b double, c double").repartition(3)
    rows = rows.unionByName(rows.where("id < 0"))
    given = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(rows)
    mapped = FourierFeatures(inputSize=3, width=8, gamma=0.5).transform(given)
    got = mapped.select("id", vector_to_array("kernel_features").alias("z")).toArrow().sort_by("id")
    draw = np.random.default_rng(SEED)
    directions, shifts = draw.normal(0.0, 1.0, (3, 8)), draw.uniform(0.0, 2.0 * np.pi, 8)
    assert len(got) == 25_000
    assert np.asarray(got["z"].combine_chunks().flatten()).reshape(-1, 8) == pytest.approx(0.5 * np.cos(x @ directions + shifts), abs=1e-12)
