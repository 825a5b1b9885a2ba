"""Exact medians: extreme values, bounded passes."""

import math
import random
import struct

import pytest

from strata.operators import nulls
from strata.operators.nulls import imputation_stats, impute
from tests.conftest import rows


def _expected(values):
    v = sorted(x + 0.0 for x in values if x is not None and not math.isnan(x))
    return v[(len(v) + 1) // 2 - 1] if v else None


INF, NAN, TINY = math.inf, math.nan, 5e-324
CASES = {
    "one infinity": [1.0, 2.0, 3.0, INF],
    "only infinities": [INF, -INF, INF],
    "minus infinity in the middle": [-INF, -INF, -INF, 4.0, 5.0],
    "infinity in the middle": [4.0, INF, INF, INF],
    "both ends": [-INF, -1.0, 0.0, 1.0, INF],
    "signed zeros": [-0.0, 0.0, -0.0],
    "around zero": [-TINY, -0.0, TINY],
    "denormals": [TINY, 2 * TINY, 3 * TINY, 1e-310],
    "neighbours": [1.0, math.nextafter(1.0, 2.0), math.nextafter(1.0, 0.0)],
    "whole range": [-1.7976931348623157e308, 1.7976931348623157e308, -TINY, 1.0],
    "nan and null": [NAN, None, 2.0, NAN, 1.0],
    "nothing": [NAN, None],
    "one value": [7.5],
    "even": [1.0, 2.0, 3.0, 4.0],
}


def test_every_extreme_at_once(spark):
    longest = max(map(len, CASES.values()))
    table = list(zip(*[v + [None] * (longest - len(v)) for v in CASES.values()]))
    df = spark.createDataFrame(table, ", ".join(f"c{k} double" for k in range(len(CASES))))
    stats = imputation_stats(df, median=df.columns)
    for k, (name, values) in enumerate(CASES.items()):
        got = stats[f"median::c{k}"]
        assert got == _expected(values), name
        if got == 0:
            assert math.copysign(1, got) == 1, name


def _passes(monkeypatch):
    calls, real = [], nulls._narrow

    def narrow(df, search):
        calls.append(sorted(search))
        return real(df, search)
    monkeypatch.setattr(nulls, "_narrow", narrow)
    return calls


@pytest.mark.parametrize("columns", [1, 6])
def test_passes_do_not_depend_on_values_or_columns(spark, monkeypatch, columns):
    rng = random.Random(columns)

    def any_double():
        x = struct.unpack("<d", rng.randbytes(8))[0]
        return x if math.isfinite(x) else 1.0
    # values packed closely in several places of the order of doubles, where
    # one pass after another must part them
    def nest():
        x, out = any_double(), []
        for gap in (1 << 50, 1 << 37, 1 << 24, 1 << 11, 1):
            k = nulls._ordered(x)
            out += [nulls._double(max(min(k + j * gap, nulls._ordered(1.7e308)), -nulls._ordered(1.7e308)))
                    for j in range(-20, 20)]
        return out + [any_double() for _ in range(200)]
    data = list(zip(*[nest() for _ in range(columns)]))
    df = spark.createDataFrame(data, ", ".join(f"c{k} double" for k in range(columns)))
    calls = _passes(monkeypatch)
    stats = imputation_stats(df, median=df.columns)
    assert len(calls) <= 5
    for k, values in enumerate(zip(*data)):
        assert stats[f"median::c{k}"] == _expected(values)


def test_splits_cover_each_double_once():
    for low, high in ((-1e308, 1e308), (0.0, TINY), (-TINY, TINY), (1.0, math.nextafter(1.0, 2)), (3.0, 3.0)):
        s = nulls._splits(low, high)
        assert all(a < b for a, b in zip(s, s[1:])) and s[0] == low and s[-2] <= high < s[-1]
        assert len(s) <= nulls.MEDIAN_BUCKETS + 1


def test_float_and_integer_columns(spark):
    df = spark.createDataFrame([(1, 1.5), (2, 2.5), (9, float("inf")), (None, None)], "i int, f float")
    stats = imputation_stats(df, median=["i", "f"])
    assert (stats["median::i"], stats["median::f"]) == (2.0, 2.5)


def test_imputation_with_an_infinite_median(spark):
    df = spark.createDataFrame([(INF,), (INF,), (1.0,), (None,)], "x double")
    assert sorted(r[0] for r in rows(impute(df, mean=[], zero=[], median=["x"]))) == [1.0, INF, INF, INF]


def test_a_hot_value_leaves_tasks_counted(spark):
    df = spark.range(50000).selectExpr("CASE WHEN id % 3 = 0 THEN 5.0D ELSE double(id) END AS x")
    assert imputation_stats(df, median=["x"])["median::x"] == _expected(
        [5.0 if i % 3 == 0 else float(i) for i in range(50000)])
