"""The fits of a cross-validation done together against the same fits done one by one."""

import pytest
from pyspark.sql import functions as F

from sparkrisk.operators.sample import repeated_folds
from sparkrisk.operators.encode import dense_cells
from sparkrisk.plans import folds, train
from sparkrisk.plans.features import feature_pipeline
from sparkrisk.session import materialize


@pytest.fixture(scope="module")
def dirty(spark, mixed_table):
    """The mixed table with illegal and missing codes, an outlier and a category that only one row has."""
    k = F.col("row_id")
    return materialize(mixed_table.withColumns({
        "nom1": F.when(k % 10 == 3, 9).when(k % 17 == 5, F.lit(None)).otherwise(F.col("nom1")),
        "ord2": F.when(k == 41, 77).when(k % 13 == 2, F.lit(None)).otherwise(F.col("ord2")),
        "num1": F.when(k % 19 == 4, F.lit(None)).when(k == 50, 100.0).otherwise(F.col("num1")),
    }), "dirty")


@pytest.fixture(scope="module")
def labelled(dirty):
    return materialize(repeated_folds(dirty, "row_id", "target", 3, 2), "labelled")


def masks(fits=6):
    return {g: F.col(f"fold_{g // 3}") != g % 3 for g in range(fits)}


@pytest.mark.parametrize("width", [150, 14])
def test_statistics_equal_those_of_separate_fits(labelled, mixed_spec, monkeypatch, width):
    monkeypatch.setattr(folds, "_WIDTH", width)
    together = folds.fit_together(feature_pipeline(mixed_spec), labelled, masks())
    for g, mask in masks().items():
        apart = feature_pipeline(mixed_spec).fit(labelled.where(mask))
        assert [s.learned for s in together[g].stages] == [s.learned for s in apart.stages]
    assert len({len(m.stages[-1].feature_names) for m in together.values()}) == 1
    assert len({str(m.stages[-1].learned) for m in together.values()}) == 6


@pytest.mark.parametrize("sampler", [None, "BorderlineSMOTE"])
def test_scores_equal_those_of_separate_fits(labelled, mixed_spec, sampler):
    pipeline = train.TrainingPipeline(key="row_id", spec=mixed_spec, sampler=sampler)
    assert folds.can_share(pipeline.preprocessor, pipeline.sampler)
    together = folds.scores_together(labelled, pipeline.preprocessor, pipeline.sampler, pipeline.model, masks(2), "row_id", "target", 3)
    apart = train._scores_apart(labelled, pipeline, masks(2), ["fold_0", "fold_1"], 3)
    rows = [sorted((r["grp"], r["side"], int(r["y_true"]), round(r["y_score"], 4)) for r in t.collect()) for t in (together, apart)]
    assert len(rows[0]) == len(rows[1]) == 200
    for a, b in zip(*rows):
        assert a[:3] == b[:3] and abs(a[3] - b[3]) <= 2e-4


def test_other_parts_are_fitted_one_by_one(mixed_spec):
    own = train.TrainingPipeline(key="row_id", spec=mixed_spec, sampler=lambda df, names, target, key: df)
    assert not folds.can_share(own.preprocessor, own.sampler)


def test_cross_validation_with_resampling(dirty, mixed_spec):
    rows = {r["metric"]: r for r in train.cross_validate(dirty, train.TrainingPipeline(key="row_id", spec=mixed_spec), 2, 1).collect()}
    assert all(0 <= rows[m]["test_mean"] <= 1 for m in rows) and len(rows) == 7
    assert rows["recall"]["train_mean"] > 0.2  # rows of the smaller class were added


def test_a_missing_feature_is_an_error(spark):
    rows = spark.createDataFrame([(1.0, None)], "a double, b double")
    with pytest.raises(Exception, match="missing value in 'b'"):
        rows.select(dense_cells(rows, ["a", "b"])).collect()


def test_separate_fits_read_written_folds(spark, mixed_table, mixed_spec):
    """Fold numbers are computed once, not in every pass of every fit."""
    read = []

    def own(encoded, names, target, key):
        read.append(encoded.inputFiles())
        return encoded

    pipeline = train.TrainingPipeline(key="row_id", spec=mixed_spec, sampler=own)
    assert train.cross_validate(mixed_table, pipeline, 2, 1).count()
    assert len(read) == 2 and all(files and all("fold-labels" in f for f in files) for files in read)
