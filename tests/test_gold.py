"""Enrichment join, unions, marts, paging."""

import pytest
from pyspark.sql import functions as F

from strata.operators import marts
from strata.operators.joins import DuplicateKeyError, enrich, join_audit, union_by_name
from strata.operators.serve import page, page_after, preview
from tests.conftest import rows


@pytest.fixture()
def gold(spark):
    data = [(f"A-{i}", 1 + i % 4, i % 3 == 0, False, None if i % 5 == 0 else i % 2 == 0,
             "Rain" if i % 2 else "Clear", float(i)) for i in range(40)]
    return spark.createDataFrame(data, "ID string, Severity int, Amenity boolean, Bump boolean, "
                                 "Junction boolean, Weather_Condition string, x double")


def test_infrastructure_mart_by_hand(gold):
    got = {r[2]: r[:2] for r in rows(marts.mart_infrastructure(gold, ["Amenity", "Bump", "Junction"]))}
    want = {}
    for flag, on in (("Amenity", lambda i: i % 3 == 0), ("Bump", lambda i: False),
                     ("Junction", lambda i: i % 5 != 0 and i % 2 == 0)):
        hits = [1 + i % 4 for i in range(40) if on(i)]
        want[flag] = (len(hits), sum(hits) / len(hits) if hits else None)
    assert got == want


def test_generic_mart_and_null_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0)], "k string, x double")
    out = marts.build_mart(df, ["k"], {"n": ("count", "*"), "m": ("avg", "x"),
                                       "hi": ("max", "x")})
    assert sorted(rows(out), key=str) == sorted([("a", 2, 2.0, 3.0), (None, 1, 5.0, 5.0)], key=str)


def test_severe_mart_filters_level_4(gold):
    out = marts.mart_severe_weather(gold.withColumnRenamed("x", "Temperature(C)")
                                    .withColumn("Wind_Speed_kmh", F.lit(1.0))
                                    .withColumn("Humidity(%)", F.lit(2.0)))
    assert sum(r[1] for r in out.collect()) == 10


def test_build_all_isolates_failures(gold):
    report = marts.build_all(gold, marts={"ok": lambda d: d.groupBy("Severity").count(),
                                          "bad": lambda d: d.select("nope")})
    assert [(n, s) for n, s, _ in report] == [("ok", "ok"), ("bad", "failed")]


def test_enrich_using_key_once(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "ID string, v int")
    right = spark.createDataFrame([("a", 9, "x"), ("b", 8, "y")], "ID string, p int, junk string")
    out = enrich(left, right, "ID", ["p"])
    assert out.columns == ["ID", "v", "p"]
    assert sorted(rows(out)) == [("a", 1, 9), ("b", 2, 8)]
    assert rows(join_audit(left, right, "ID")) == [(3, 2, 2)]


def test_enrich_rejects_duplicate_right_keys(spark):
    left = spark.createDataFrame([("a", 1)], "ID string, v int")
    right = spark.createDataFrame([("a", 1), ("a", 2)], "ID string, p int")
    with pytest.raises(DuplicateKeyError):
        enrich(left, right, "ID", ["p"], check_unique=True)
    with pytest.raises(ValueError):
        enrich(left, right.drop("ID"), "ID", ["p"])


def test_union_by_name_not_position(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2)], "b string, a int")
    assert sorted(rows(union_by_name([a, b]))) == [(1, "x"), (2, "y")]


def test_pages_are_stable_and_cover_everything(gold):
    seen = []
    for n in range(8):
        seen += [r[0] for r in page(gold, n * 5, 5).select("ID").collect()]
    assert len(seen) == 40 and len(set(seen)) == 40 and seen == sorted(seen)
    assert rows(page(gold, 3, 2), "ID") == [(seen[3],), (seen[4],)]
    assert [r[0] for r in page_after(gold, seen[9], 3).select("ID").collect()] == seen[10:13]
    assert [r[0] for r in preview(gold, 4).select("ID").collect()] == seen[:4]


def test_build_all_publishes_full_copy(gold, tmp):
    from strata.sources.sinks import parquet_publisher
    report = marts.build_all(gold, parquet_publisher(tmp),
                             marts={"by_sev": lambda d: d.groupBy("Severity").count()},
                             full_copy="gold_copy")
    assert [(n, s) for n, s, _ in report] == [("by_sev", "ok"), ("gold_copy", "ok")]
    assert gold.sparkSession.read.parquet(f"{tmp}/gold_copy").count() == 40


def test_persisted_scope(gold):
    from strata.operators.cache import persisted
    with persisted(gold) as cached:
        assert cached.is_cached
        assert cached.count() == 40
    assert not gold.is_cached
