"""The registered cross-validation resamples inside every fold, as the operator does by default."""

from conftest import TESTDATA

from sparkrisk.catalog import QUERIES
from sparkrisk.operators import oversample
from sparkrisk.spec import CV_FOLDS, CV_REPEATS


def test_every_fit_is_resampled(spark, monkeypatch):
    seen = []

    def recorded(df, features, target, key):
        seen.append(key)
        return df

    monkeypatch.setitem(oversample.SAMPLERS, "BorderlineSMOTE", recorded)
    assert QUERIES["cross_validate"](spark, TESTDATA).count() > 0
    assert seen == ["event_id"] * (CV_FOLDS * CV_REPEATS)
