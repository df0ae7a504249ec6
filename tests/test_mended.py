"""Inputs that the test tables do not hold: repeated keys, 64-bit codes, data-dependent types, narrow boxes."""

import pytest

from sparkrisk import session
from sparkrisk.operators import cutoffs, describe
from sparkrisk.operators.encode import TableEncoder
from sparkrisk.operators.impute import IllegalToMode, MissingFill
from sparkrisk.operators.sample import holdout_split, sample_rows
from sparkrisk.plans.prepare import with_row_id
from sparkrisk.plans.train import result_config

BIG = 2 ** 53


def test_a_key_that_repeats_around_the_cut_is_refused(spark):
    same = spark.range(20_000).selectExpr("1 AS k", "id % 2 AS y")
    with pytest.raises(ValueError, match="not unique"):
        sample_rows(same, "k", 5000)
    with pytest.raises(ValueError, match="not unique"):
        holdout_split(same, "k", "y")


def test_few_repeats_around_the_cut_are_refused_too(spark):
    df = spark.range(10).selectExpr("'all' AS stratum", "lpad(hex(id div 4), 32, '0') AS key")
    assert cutoffs.keys_at_ranks(df, {"all": 10}, {"all": [4]})["all", 4].endswith("1")
    with pytest.raises(ValueError, match="not unique"):
        cutoffs.keys_at_ranks(df, {"all": 10}, {"all": [5]})


def test_whole_keys_end_the_search(spark, monkeypatch):
    monkeypatch.setattr(cutoffs, "_FINISH_PER_RANK", 1)
    df = spark.range(900).selectExpr("'all' AS stratum", "lpad(hex(id div 300), 32, '0') AS key")
    assert cutoffs.keys_at_ranks(df, {"all": 900}, {"all": [300]})["all", 300].endswith("1")
    with pytest.raises(ValueError, match="not unique"):
        cutoffs.keys_at_ranks(df, {"all": 900}, {"all": [301]})


def test_codes_of_64_bits_stay_apart(spark):
    df = spark.createDataFrame([(BIG,), (BIG + 1,), (BIG + 1,), (None,)], "code long")
    assert IllegalToMode(rules={"code": [0]}, modeOver="all").fit(df).modes == {"code": BIG + 1}
    filled = MissingFill(mode=["code"]).fit(df).transform(df)
    assert sorted(r[0] for r in filled.collect()) == [BIG, BIG + 1, BIG + 1, BIG + 1]
    ranks = TableEncoder(ordinal=["code"]).fit(df).transform(df)
    assert sorted(r[0] for r in ranks.collect()) == [0.0, 1.0, 1.0, 1.0]
    hot = TableEncoder(nominal=["code"]).fit(df)
    assert hot.feature_names == [f"code_{BIG + 1}"]


@pytest.mark.parametrize("values", [(1, 3), (1, 2)])
def test_medians_are_doubles_whatever_their_value(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x int")
    assert dict(MissingFill(median=["x"]).fit(df).transform(df).dtypes) == {"x": "double"}


def test_whiskers_end_at_the_quartile_and_fliers_are_listed(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (1.0,), (10.0,)], "x double")
    row = describe.box_stats(df, ["x"]).first()
    assert (row["q3"], row["whisker_high"], row["whisker_low"], row["fliers"]) == (3.25, 3.25, 1.0, 1)
    assert [tuple(r) for r in describe.box_fliers(df, ["x"]).collect()] == [("x", 10.0)]


def test_row_keys_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame([(k % 7, None if k % 3 else "a") for k in range(60)], "a int, b string")
    one, two = (sorted(map(repr, with_row_id(df.repartition(n)).collect())) for n in (1, 5))
    assert one == two and with_row_id(df).select("row_id").distinct().count() == 60


class Unset:
    """A session, its settings and its context in one, without any checkpoint folder."""

    master = "spark://host:7077"
    conf = sparkContext = property(lambda self: self)

    def get(self, key, default=None):
        return default

    def getConf(self):
        return self

    def getCheckpointDir(self):
        return None


def test_clusters_need_a_shared_folder():
    assert session.is_local("local[8]") and session.is_local("local") and not session.is_local("local-cluster[2,1,1024]")
    with pytest.raises(RuntimeError, match="checkpoint"):
        session.scratch_root(Unset())


def test_the_results_document_states_the_settings():
    assert result_config(4, 2, None, 7) == {"cv_folds": 4, "cv_repeats": 2, "random_seed": 7}
    assert result_config(sampler="SMOTE")["smote_config"]["method"] == "SMOTE"
    assert "m_neighbors" in result_config()["smote_config"]


def test_many_copies_of_few_rows_are_made_in_chunks(spark, monkeypatch):
    from sparkrisk.operators import oversample

    monkeypatch.setattr(oversample, "CHUNK", 100)
    rows = [(k, 0, float(k), 0.0) for k in range(3000)] + [(10_000 + k, 1, 5.0 + k, 1.0) for k in range(7)]
    df = spark.createDataFrame(rows, "id long, y int, a double, b double")
    made = oversample.smote(df, ["a", "b"], "y", "id", k=3).where("copy > 0")
    per_row = {r["id"]: (r["count"], r["most"]) for r in made.groupBy("id").agg({"*": "count", "copy": "max"}).toDF("id", "count", "most").collect()}
    assert sum(n for n, _ in per_row.values()) == 2993 and all(n == most for n, most in per_row.values())


def test_correlation_of_many_columns(spark):
    import numpy as np
    import pandas as pd

    r = np.random.default_rng(1)
    x = pd.DataFrame(r.normal(size=(300, 60)) + 1e6, columns=[f"c{k}" for k in range(60)])
    x["c1"] = x["c0"] * 2 + r.normal(size=300)
    x = x.mask(r.random(x.shape) < 0.1)
    x["same"] = 3.0
    want = x.corr()
    got = {(q["x"], q["y"]): q["r"] for q in describe.correlation(spark.createDataFrame(x)).collect()}
    assert len(got) == 61 * 61 and got["same", "c1"] is None and got["same", "same"] is None
    assert all(abs(got[a, b] - want.loc[a, b]) < 1e-6 for a in want for b in want if "same" not in (a, b))
