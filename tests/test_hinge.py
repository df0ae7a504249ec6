"""The kernel machine learns what LinearSVC learns on the written-out features, without such a table."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.linalg import Vectors

from sparkrisk.operators import hinge
from sparkrisk.operators.models import FourierFeatures, get_model


def table(spark, n=400, labels=None):
    rng = np.random.RandomState(3)
    x = rng.normal(size=(n, 3))
    y = (x[:, 0] * x[:, 1] + rng.normal(size=n) * 0.3 > 0.2).astype(float) if labels is None else labels
    return spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x, y)], ["features", "label"]).repartition(3)


def test_same_machine_as_on_written_features(spark):
    df = table(spark).persist()
    machine = get_model("svm", 400, 3)
    machine.mapped._set(width=32)
    machine.machine.setMaxIter(30)
    own = machine.fit(df).stages[1]
    written = Pipeline(stages=[machine.mapped, machine.machine]).fit(df).stages[1]
    assert np.allclose(own.coefficients.toArray(), written.coefficients.toArray(), rtol=1e-8, atol=1e-9)
    assert own.intercept == pytest.approx(written.intercept, abs=1e-9)
    *_, values = hinge.fit_hinge(df, "features", "label", *machine.mapped.drawn(), reg=machine.machine.getRegParam(), max_iter=30, tol=machine.machine.getTol())
    assert np.allclose(values, written.summary().objectiveHistory, rtol=1e-9)


def test_fit_makes_no_table_of_features(spark, monkeypatch):
    def refused(self, df):
        raise AssertionError("features written out")

    df = table(spark, 60)
    monkeypatch.setattr(FourierFeatures, "_transform", refused)
    machine = get_model("svm", 60, 3)
    machine.machine.setMaxIter(2)
    assert len(machine.fit(df).stages) == 2


def test_half_cosines():
    x, d, s = np.linspace(-40, 40, 6000).reshape(-1, 2), np.array([[1.0, 0.0], [0.0, 3.0]]), np.array([0.0, np.pi])
    assert np.abs(2 * hinge.squared_half_cosines(x, d / 2, s / 2) - 1 - np.cos(x @ d + s)).max() < 1e-13


@pytest.mark.parametrize("labels", [[0.0] * 20, [0.0, 1.0, 2.0, 1.0] * 5, [0.5, 1.0] * 10])
def test_other_labels_are_refused(spark, labels):
    with pytest.raises(Exception):
        get_model("svm", 20, 3).fit(table(spark, 20, labels))
