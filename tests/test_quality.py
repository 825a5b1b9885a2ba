"""Null handling, imputation, profiles."""

import pytest

from strata.operators.columns import drop_tolerant, numeric_columns, require_columns
from strata.operators.nulls import (dropna_subset, fill_constant, impute, null_profile,
                                    null_profile_long, schema_report)
from tests.conftest import rows


def test_double_fill_replaces_nan_and_null(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, None), (3, 1.0)], "i int, x double")
    out = fill_constant(df, {"x": 7.0}).orderBy("i")
    assert [r[0] for r in rows(out, "x")] == [7.0, 7.0, 1.0]


def test_string_fill_keeps_empty(spark):
    df = spark.createDataFrame([(1, None), (2, "")], "i int, s string")
    out = fill_constant(df, {"s": "UNKNOWN", "absent": "z"}).orderBy("i")
    assert [r[0] for r in rows(out, "s")] == ["UNKNOWN", ""]


def test_median_of_four_is_an_element(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,)], "x double")
    out = impute(df, mean=[], zero=[], median=["x"])
    assert sorted(r[0] for r in out.collect()) == [1.0, 2.0, 2.0, 3.0, 4.0]


def test_mean_fill_rounds_whole_column(spark):
    df = spark.createDataFrame([(1.234,), (2.0,), (None,)], "x double")
    out = impute(df, mean=["x"], zero=[], median=[])
    # mean of 1.234 and 2.0 = 1.617 -> filled, then every value rounded to 2
    assert sorted(r[0] for r in out.collect()) == [1.23, 1.62, 2.0]


def test_zero_fill_and_absent_columns(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (0.555,)], "x double")
    out = impute(df, mean=["nope"], zero=["x"], median=["gone"])
    assert sorted(r[0] for r in out.collect()) == [0.0, 0.0, 0.56]


def test_all_null_column_left_unfilled(spark):
    df = spark.createDataFrame([(None, 1.0), (None, None)], "x double, y double")
    out = impute(df, mean=["x", "y"], zero=[], median=[])
    assert sorted(rows(out, "x", "y"), key=str) == [(None, 1.0), (None, 1.0)]


def test_dropna_subset(spark):
    df = spark.createDataFrame([(1, "Day", "Day"), (2, None, "Day"), (3, "Day", None)],
                               "i int, a string, b string")
    assert [r[0] for r in rows(dropna_subset(df, ["a", "b", "zz"]), "i")] == [1]


def test_null_profile_type_aware(spark):
    df = spark.createDataFrame([("x", float("nan"), None), (None, None, 1), ("", 1.0, 2)],
                               "s string, d double, n int")
    assert rows(null_profile(df)) == [(1, 2, 1)]
    assert sorted(rows(null_profile_long(df))) == [("d", 2), ("n", 1), ("s", 1)]


def test_schema_report(spark):
    df = spark.createDataFrame([("a", 1)], "s string, n int")
    assert rows(schema_report(df), "column_name", "data_type") == [("s", "string"), ("n", "int")]
    full = schema_report(df, with_missing=True).orderBy("position")
    assert rows(full, "column_name", "missing") == [("s", 0), ("n", 0)]


def test_drop_and_type_selection(spark):
    df = spark.createDataFrame([("a", 1, 2.0, True)], "s string, n int, d double, b boolean")
    assert drop_tolerant(df, ["s", "missing"]).columns == ["n", "d", "b"]
    assert numeric_columns(df, exclude=["n"]) == ["d"]
    with pytest.raises(ValueError):
        require_columns(df, ["ID"])
