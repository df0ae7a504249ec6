import math

import numpy as np
import pandas as pd
import pytest

from conftest import by_key
from sparkrisk.operators import metrics


def reference_auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return wins / (len(pos) * len(neg))


def reference_ap(y, p):
    total, before = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        chosen = p >= t
        recall = y[chosen].sum() / y.sum()
        total += (recall - before) * y[chosen].mean()
        before = recall
    return total


@pytest.fixture(scope="module")
def scores():
    rng = np.random.RandomState(3)
    y = rng.randint(0, 2, 400)
    p = np.clip(0.4 * y + rng.rand(400) * 0.6, 0, 1).round(2)
    return pd.DataFrame({"y_true": y, "y_pred": (p > 0.5).astype(int), "y_proba": p})


@pytest.fixture(scope="module")
def table(spark, scores):
    return spark.createDataFrame(scores).repartition(3)


@pytest.mark.parametrize("bits", [0, 1, 3, 16])
def test_rank_metrics_do_not_depend_on_blocks(table, scores, bits):
    got = metrics.rank_metrics(table, block_bits=bits).first()
    y, p = scores.y_true.to_numpy(), scores.y_proba.to_numpy()
    assert got["roc_auc"] == pytest.approx(reference_auc(y, p), rel=1e-12)
    assert got["average_precision"] == pytest.approx(reference_ap(y, p), rel=1e-12)


def test_groups_have_running_sums_of_their_own(spark, scores):
    """Also a missing group, and NaN as the highest score."""
    rows = [(None if k % 3 == 0 else f"g{k % 3}", int(y), math.nan if k == 7 else float(p)) for k, (y, p) in enumerate(zip(scores.y_true, scores.y_proba))]
    df = spark.createDataFrame(rows, "g string, y_true int, y_proba double").repartition(5)
    for bits in (0, 2, 16):
        got = {r["g"]: r for r in metrics.rank_metrics(df, by=["g"], block_bits=bits).collect()}
        assert set(got) == {None, "g1", "g2"}
        for g, r in got.items():
            y = np.array([b for a, b, _ in rows if a == g])
            p = np.array([2.0 if math.isnan(c) else c for a, _, c in rows if a == g])
            assert (r["roc_auc"], r["average_precision"]) == pytest.approx((reference_auc(y, p), reference_ap(y, p)))


def test_one_table_of_steps_serves_both_curves(table):
    steps = metrics.score_steps(table, block_bits=2)
    assert sorted(metrics.roc_of_steps(steps).collect()) == sorted(metrics.roc_points(table).collect())
    assert sorted(metrics.precision_recall_of_steps(steps).na.fill(-1.0).collect()) == sorted(metrics.precision_recall_points(table).na.fill(-1.0).collect())
    assert metrics.score_steps(table.limit(0)).count() == 0


def test_average_precision_is_not_interpolated(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.6), (0, 0.5), (1, 0.4)], "y_true int, y_proba double")
    got = metrics.rank_metrics(df).first()["average_precision"]
    assert got == pytest.approx((1 + 2 / 3 + 3 / 6) / 3)


def test_class_metrics_and_groups(table, scores):
    got = metrics.class_metrics(table).first()
    tp = ((scores.y_true == 1) & (scores.y_pred == 1)).sum()
    assert got["true_positives"] == tp and isinstance(got["true_positives"], int)
    assert got["accuracy"] == pytest.approx((scores.y_true == scores.y_pred).mean())
    recall, special = tp / (scores.y_true == 1).sum(), 1 - scores[scores.y_true == 0].y_pred.mean()
    assert got["geometric_mean"] == pytest.approx(math.sqrt(recall * special))
    grouped = by_key(metrics.evaluate(table.withColumn("g", table.y_pred), by=["g"]), "g")
    assert grouped[1]["precision"] == got["precision"] and grouped[0]["precision"] == 0.0


def test_single_class_input(spark):
    df = spark.createDataFrame([(1, 1, 0.3), (1, 0, 0.6)], "y_true int, y_pred int, y_proba double")
    got = metrics.evaluate(df).first()
    assert got["roc_auc"] is None and got["average_precision"] is None
    assert (got["true_negatives"], got["false_positives"], got["recall"], got["geometric_mean"]) == (0, 0, 0.5, 0.0)


def test_metrics_without_probabilities(spark):
    df = spark.createDataFrame([(1, 1), (0, 0)], "y_true int, y_pred int")
    assert "roc_auc" not in metrics.evaluate(df).columns
    doc = metrics.metrics_document(metrics.evaluate(df)).first()
    assert doc["confusion_matrix"].asDict() == {
        "true_negatives": 1, "false_positives": 0, "false_negatives": 0, "true_positives": 1}


@pytest.mark.parametrize("bits", [0, 2, 16])
def test_roc_points(table, scores, bits):
    every = metrics.roc_points(table, drop_collinear=False, block_bits=bits).orderBy("threshold", ascending=False).collect()
    assert len(every) == scores.y_proba.nunique() + 1
    assert every[0][:2] == (0.0, 0.0) and math.isinf(every[0]["threshold"]) and every[-1][:2] == (1.0, 1.0)
    counts = scores.groupby("y_proba").y_true.agg(["sum", "count"]).sort_index(ascending=False)
    pairs = list(zip(counts["sum"], counts["count"]))
    kept = [i for i in range(len(pairs)) if i in (0, len(pairs) - 1) or pairs[i] != pairs[i + 1]]
    assert metrics.roc_points(table, block_bits=bits).count() == len(kept) + 1


def test_precision_recall_points(table, scores):
    got = metrics.precision_recall_points(table).orderBy("threshold", ascending=False).collect()
    assert len(got) == scores.y_proba.nunique() + 1
    last = [r for r in got if r["threshold"] is None][0]
    assert (last["precision"], last["recall"]) == (1.0, 0.0)
    lowest = min((r for r in got if r["threshold"] is not None), key=lambda r: r["threshold"])
    assert lowest["recall"] == 1.0 and lowest["precision"] == pytest.approx(scores.y_true.mean())


def test_confusion_table_has_the_full_grid(spark):
    df = spark.createDataFrame([(0, 0)], "y_true int, y_pred int")
    got = {(r["true_label"], r["predicted_label"]): r["n"] for r in metrics.confusion_table(df).collect()}
    assert got == {("Malo", "Malo"): 1, ("Malo", "Bueno"): 0, ("Bueno", "Malo"): 0, ("Bueno", "Bueno"): 0}


def test_class_distribution(spark):
    df = spark.createDataFrame([(v,) for v in [0, 1, 0, 1, 1, 1, 0, 0]], "y int")
    got = by_key(metrics.class_distribution(df, "y", {0: "Malo", 1: "Bueno"}), "label")
    assert (got["Malo"]["n"], got["Malo"]["pct"]) == (4, 50.0)


def test_fold_summary_uses_the_population_deviation(spark):
    rows = [("test", 0.80, 0.5), ("test", 0.85, float("nan")), ("test", 0.90, 0.7), ("train", 1.0, 1.0)]
    got = by_key(metrics.fold_summary(spark.createDataFrame(rows, "side string, accuracy double, recall double"),
                                      ["accuracy", "recall"]), "metric")
    assert got["accuracy"]["test_mean"] == pytest.approx(0.85)
    assert got["accuracy"]["test_std"] == pytest.approx(np.std([0.80, 0.85, 0.90]))
    assert got["recall"]["test_mean"] == pytest.approx(0.6) and got["recall"]["train_std"] == 0.0


def test_top_features_and_leaderboard(spark):
    imp = spark.createDataFrame([(f"feature_{i}", float((i * 7) % 30)) for i in range(30)], "feature string, importance double")
    assert [r["importance"] for r in metrics.top_features(imp, 5).collect()] == [29.0, 28.0, 27.0, 26.0, 25.0]
    assert metrics.top_features(imp, 50).count() == 30
    rows = [("a", "roc_auc", 0.7), ("b", "roc_auc", 0.8), ("c", "roc_auc", None), ("a", "f1", 0.9)]
    board = metrics.leaderboard(spark.createDataFrame(rows, "experiment string, metric string, test_mean double"))
    assert [r["experiment"] for r in board.orderBy("place").collect()] == ["b", "a", "c"]
