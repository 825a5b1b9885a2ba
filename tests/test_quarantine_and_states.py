"""Malformed CSV rows kept apart, audits from footers, marts from states."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import presets as P
from strata.operators import marts
from strata.operators.ingest import assign_deliveries, audited_write, committed_rows
from strata.operators.partial_marts import PartialMarts
from strata.queries import _gold, _r6
from strata.sources.files import load_csv
from tests.conftest import SMOKE, rows

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.DoubleType()),
                       T.StructField("t", T.TimestampType()), T.StructField("s", T.StringType())])
GOOD = ['1,2.5,2025-01-01 10:00:00,plain', '2,\\N,\\N,"quoted, with comma"', '3,1e3,2025-01-01T00:00:00,""', '-4,7,\\N,é']
BAD = {'5,notanumber,\\N,a': "x", 'x6,1.0,yesterday,b': "id, t", '7,1.0': "fields", '8,1.0,\\N,c,more': "fields",
       '"9,1.0,\\N,d': "fields"}


def _load(spark, tmp, lines, **kw):
    spark.createDataFrame([(x,) for x in lines], "value string").repartition(3).write.text(f"{tmp}/lines")
    return load_csv(spark, f"{tmp}/lines", f"{tmp}/out", SCHEMA, header=False, **kw)


def test_every_record_is_good_or_rejected_with_a_reason(spark, tmp):
    good, rejected = _load(spark, tmp, GOOD + list(BAD))
    assert sorted(rows(good, "id", "x", "s")) == [(-4, 7.0, "é"), (1, 2.5, "plain"), (2, None, "quoted, with comma"),
                                                   (3, 1000.0, "")]
    assert good.columns == ["id", "x", "t", "s"]
    assert dict(rows(rejected, "record", "reason")) == BAD
    assert all("/lines/" in r[0] for r in rows(rejected, "file"))
    # counting, and reading one column, reject no other rows
    assert good.count() == 4 and good.select("s").count() == 4 and rejected.count() == 5


def test_nothing_rejected_and_nothing_good(spark, tmp):
    good, rejected = _load(spark, tmp, GOOD)
    assert good.count() == 4 and rejected.collect() == []
    good, rejected = load_csv(spark, f"{tmp}/lines", f"{tmp}/out", T.StructType(
        [T.StructField(c, T.IntegerType()) for c in "abcd"]), header=False)
    assert good.collect() == [] and rejected.count() == 4


def test_committed_rows_are_those_of_the_files(spark, tmp):
    df = spark.range(500).repartition(5)
    assert audited_write(df, f"{tmp}/a") == {"observed": 500, "committed": 500, "equal": True}
    assert committed_rows(spark, f"{tmp}/none") == 0
    # a writer that stores the rows twice, as a task counted twice would look
    twice = audited_write(df, f"{tmp}/b", lambda f: f.unionAll(f.select("id")).write.parquet(f"{tmp}/b"))
    assert twice["committed"] == 1000
    part = audited_write(df, f"{tmp}/c", lambda f: f.filter("id < 10").write.parquet(f"{tmp}/c"))
    assert part["committed"] == 10 and not part["equal"]


def test_counting_reads_no_column(spark, tmp):
    spark.range(10).write.parquet(f"{tmp}/a")
    plan = spark.read.schema("none int").parquet(f"{tmp}/a").agg(F.count(F.lit(1)))
    assert "ReadSchema: struct<>" in plan._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('gold')}/rows"
    assign_deliveries(_gold(spark, SMOKE), P.KEY).write.partitionBy(P.BATCH_COLUMN).parquet(path)
    return spark.read.parquet(path)


def _same(kept, gold):
    for name, fn in marts.MARTS.items():
        want = _r6(fn(gold))
        assert sorted(rows(_r6(kept.mart(name)).select(*want.columns)), key=str) == sorted(rows(want), key=str), name


def test_states_equal_a_full_rebuild_after_every_date(spark, tmp, gold):
    kept, dates = PartialMarts(spark, f"{tmp}/states"), ["2025_06_15", "2025_06_16", "2025_06_17"]
    for k, d in enumerate(dates):
        kept.update(gold, [d])
        assert kept.dates() == dates[:k + 1]
    _same(kept, gold)
    early = gold.filter(F.col(P.BATCH_COLUMN) <= dates[1])
    assert sorted(rows(_r6(kept.mart("dm_weather_accidents", upto=dates[1]))), key=str) == sorted(
        rows(_r6(marts.mart_weather(early))), key=str)
    # one date replaced, then emptied: only its own states change
    less = gold.filter((F.col(P.BATCH_COLUMN) != dates[1]) | (F.col(P.LABEL) < 3))
    kept.update(less, [dates[1]])
    _same(kept, less)
    none = gold.filter(F.col(P.BATCH_COLUMN) != dates[1])
    kept.update(none, [dates[1]])
    _same(kept, none)


def test_an_update_reads_its_own_dates(spark, tmp, gold):
    state = PartialMarts(spark, f"{tmp}/s")._state("dm_weather_accidents", gold.filter(
        F.col(P.BATCH_COLUMN).isin(["2025_06_16"])))
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_date" in plan and "2025_06_16" in plan
