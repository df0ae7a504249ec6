import pytest
from pyspark.sql import functions as F

from conftest import column
from sparkrisk.functions import to_number
from sparkrisk.operators import clean, profile


@pytest.fixture(scope="module")
def dirty(spark):
    rows = [("1", "10", "0", "a"), ("2", "20", "1", "b"), ("invalid", "30", "0", "c"),
            ("4", "error", None, "d"), ("5", "50", "1", "e")]
    return spark.createDataFrame(rows, "feature1 string, feature2 string, kredit string, mixed_type_col string")


def test_clean_drops_mixed_makes_numbers_keeps_valid_targets(dirty):
    out = clean.clean(dirty)
    assert "mixed_type_col" not in out.columns
    assert {f.dataType.typeName() for f in out.schema.fields} == {"double", "integer"}
    assert out.count() == 4 and out.where("kredit IS NULL").count() == 0


@pytest.mark.parametrize("text, number", [
    ("1d", None), ("1f", None), ("5D", None), ("0x10", None), ("1_0", None), ("", None), ("nan", None), ("abc", None),
    ("1e3", 1000.0), (" 7 ", 7.0), ("inf", float("inf")), ("-inf", float("-inf")), (".5", 0.5), ("5.", 5.0), ("+3", 3.0),
])
def test_number_parsing(spark, text, number):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(to_number(F.col("t"), df.schema["t"].dataType)).first()[0] == number


def test_mixed_types_become_missing(spark):
    df = spark.createDataFrame(
        [("1", "10"), ("invalid", "20"), ("3", "bad"), ("error", "40"), ("5", "50")], "col1 string, col2 string")
    got = profile.null_counts(clean.coerce_numeric(df))
    assert {r["column"]: r["nulls"] for r in got.collect()} == {"col1": 2, "col2": 1}


@pytest.mark.parametrize("targets, left", [([None, "2", "3"], 0), (["0", "1", "0", "1"], 4), ([None, None], 0), (["1"], 1)])
def test_target_edge_cases(spark, targets, left):
    df = spark.createDataFrame([("1", t, "x") for t in targets], "feature1 string, kredit string, mixed_type_col string")
    assert clean.clean(df).count() == left


def test_table_without_target_or_columns_is_left_alone(spark):
    df = spark.createDataFrame([("1",)], "a string")
    assert column(clean.clean(df), "a") == [1.0]
    empty = spark.range(0).select()
    assert clean.clean(empty).count() == 0


def test_tally_tokens_and_report(dirty):
    tally = {(r["column"], r["value"]): r["n"] for r in profile.dirty_tally(dirty).collect()}
    assert tally[("feature1", "invalid")] == 1 and tally[("mixed_type_col", "a")] == 1 and len(tally) == 7
    assert sorted(column(profile.dirty_tokens(dirty, ["mixed_type_col"]), "value")) == ["error", "invalid"]
    assert clean.clean_report(dirty).first().asDict() == {
        "rows_before": 5, "rows_removed": 1, "rows_left": 4, "dirty_cells": 2, "columns_left": 3}


def test_replace_tokens_from_list_table_and_long_table(spark, dirty, monkeypatch):
    expected = clean.replace_tokens(dirty, ["invalid", "error"]).collect()
    tokens = spark.createDataFrame([("invalid",), ("error",)], "value string")
    assert clean.replace_tokens(dirty, tokens).collect() == expected
    many = tokens.union(spark.range(6000).select(F.concat(F.lit("t"), "id")))
    assert sorted(clean.replace_tokens(dirty, many).collect(), key=str) == sorted(expected, key=str)
    monkeypatch.setattr(clean, "BROADCAST_BYTES", 0)
    assert sorted(clean.replace_tokens(dirty, many).collect(), key=str) == sorted(expected, key=str)


def test_separate_target(dirty):
    features, target = clean.separate_target(dirty, "kredit", key="feature1")
    assert features.columns == ["feature1", "feature2", "mixed_type_col"] and target.columns == ["feature1", "kredit"]
    with pytest.raises(ValueError):
        clean.separate_target(dirty, "absent")


def test_rename_and_complete_cases(dirty):
    assert clean.rename_columns(dirty, {"kredit": "credit", "zzz": "q"}).columns[2] == "credit"
    assert clean.complete_cases(dirty).count() == 4


def test_rule_filter_and_reports(spark):
    df = spark.createDataFrame([(1, 10), (2, 999), (99, 20), (None, 30)], "cat1 int, cat2 int")
    rules = {"cat1": [1, 2, 3], "cat2": [10, 20, 30], "absent": [1]}
    assert clean.filter_by_rules(df, rules).count() == 1
    assert clean.rule_filter_report(df, rules).first()["pct_removed"] == 75.0
    report = {r["column"]: (r["invalid"], r["pct"]) for r in profile.rule_report(df, rules).collect()}
    assert report == {"cat1": (2, 50.0), "cat2": (1, 25.0), "TOTAL": (3, None)}


def test_profile_counts_and_preview(spark, dirty):
    got = {r["column"]: (r["dtype"], r["non_null"], r["nulls"]) for r in profile.table_profile(dirty).collect()}
    assert got["kredit"] == ("string", 4, 1)
    assert [r["feature2"] for r in profile.preview(dirty, "feature2", 2).collect()] == ["10", "20"]
    shares = {r["value"]: r["share"] for r in profile.value_shares(dirty, "kredit").collect()}
    assert shares == {"0": 0.5, "1": 0.5}
    assert profile.table_shape(dirty).first().asDict() == {"label": "table", "n_rows": 5, "n_columns": 4}
