"""Driver contract, and every oracle query against DuckDB on sf0.001."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from strata.oracles import ORACLES
from strata.queries import QUERIES
from tools.compare import TABLES, value_hash

SMOKE = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["Weather_Condition", "total_accidents", "avg_severity", "avg_temp",
                          "avg_precip", "avg_visibility"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(QUERIES) >= 60 and set(QUERIES) == set(ORACLES)


def test_a_wrong_preset_turns_a_query_red(spark, duck, monkeypatch):
    """The oracles hold their own values."""
    from strata import presets
    monkeypatch.setattr(presets, "WIND_WORDS", {**presets.WIND_WORDS, "EAST": "W"})
    with pytest.raises(AssertionError):
        test_query_matches_oracle(spark, duck, "wind_clean")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SMOKE}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def assert_jvm_only_plan(df, name):
    """No Python evaluation, no cartesian or nested-loop join in the plan."""
    text = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"PythonUDF|BatchEvalPython|ArrowEvalPython", text), name
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", text), name


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SMOKE)
    assert_jvm_only_plan(sdf, name)
    srows = [tuple(r) for r in sdf.collect()]
    rel = duck.sql(entry.oracle_sql()[name])
    orows = rel.fetchall()
    assert sorted(sdf.columns) == sorted(rel.columns)
    assert len(srows) == len(orows)
    assert value_hash(sdf.columns, srows) == value_hash(rel.columns, orows)
