"""Physical-plan properties: scans, pushdown, pruning, shuffles, no Python."""

import pytest
from pyspark.sql import functions as F

from strata.operators import marts
from strata.operators.joins import enrich
from strata.plans import bronze
from strata.sources.sinks import save_table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted") \
        if hasattr(df._sc._jvm, "PythonSQLUtils") else plan(df)


@pytest.fixture()
def parquet_gold(spark, tmp):
    data = [(f"A-{i}", 1 + i % 4, i % 3 == 0, i % 5 == 0, "Rain" if i % 2 else "Clear",
             float(i), float(i % 9)) for i in range(200)]
    df = spark.createDataFrame(data, "ID string, Severity int, Amenity boolean, Junction boolean, "
                               "Weather_Condition string, `Temperature(C)` double, "
                               "Wind_Speed_kmh double")
    df = df.withColumn("Humidity(%)", F.lit(50.0))
    df.write.parquet(f"{tmp}/gold")
    return spark.read.parquet(f"{tmp}/gold")


def test_infrastructure_mart_scans_once(parquet_gold):
    single = plan(marts.mart_infrastructure(parquet_gold, ["Amenity", "Junction"]))
    assert single.count("FileScan parquet") == 1


def test_severe_filter_reaches_scan_and_prunes_columns(parquet_gold):
    text = formatted(marts.mart_severe_weather(parquet_gold))
    assert "EqualTo(Severity,4)" in text
    assert "ReadSchema: struct<Severity:int,Weather_Condition:string,Temperature(C):double," \
           "Wind_Speed_kmh:double,Humidity(%):double>" in text
    assert "PythonUDF" not in text and "BatchEvalPython" not in text


def test_aggregate_is_partial_then_final(parquet_gold):
    text = plan(marts.mart_weather(parquet_gold.withColumnRenamed("Wind_Speed_kmh", "Visibility_km")
                                   .withColumn("Precipitation(cm)", F.lit(0.0))))
    assert "partial_count" in text and text.count("HashAggregate") >= 2


def test_snapshot_prunes_partitions(spark, tmp):
    df = spark.range(30).withColumn("batch_date", F.concat(F.lit("2025_06_1"),
                                                           (F.col("id") % 3 + 5).cast("string")))
    df.write.partitionBy("batch_date").parquet(f"{tmp}/bz")
    text = formatted(bronze.bronze_snapshot(spark, f"{tmp}/bz", "2025_06_16"))
    assert "PartitionFilters: [isnotnull(batch_date" in text
    assert "(batch_date" in text and "<= 2025_06_16)" in text


def test_bucketed_enrichment_needs_no_exchange(spark, tmp):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(1000).select(F.concat(F.lit("A-"), F.col("id").cast("string")).alias("ID"),
                                        F.col("id").alias("v"))
        right = left.select("ID", (F.col("v") % 4).cast("int").alias("prediction_classe"))
        save_table(left, "bkt_left", path=f"{tmp}/l", bucket_by=(4, "ID"))
        save_table(right, "bkt_right", path=f"{tmp}/r", bucket_by=(4, "ID"))
        joined = enrich(spark.table("bkt_left"), spark.table("bkt_right"), "ID",
                        ["prediction_classe"])
        text = plan(joined)
        assert "SortMergeJoin" in text
        assert "Exchange" not in text
        assert joined.count() == 1000
        import glob
        assert len(glob.glob(f"{tmp}/l/*.parquet")) == 4  # one file per bucket
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))


def test_chain_row_counts(spark):
    from strata.fixture import accidents
    from strata.plans.silver import silver_join, silver_ml
    from tests.conftest import SMOKE
    raw = accidents(spark, SMOKE)
    n = raw.count()
    twilight_missing = raw.filter(" OR ".join(f"{c} IS NULL" for c in
                                              ["Sunrise_Sunset", "Civil_Twilight",
                                               "Nautical_Twilight", "Astronomical_Twilight"])).count()
    assert silver_join(raw).count() == n - twilight_missing
    ml, _ = silver_ml(raw)
    assert ml.count() == n and len(ml.columns) == 34
    assert len(silver_join(raw).columns) == 42


def test_hot_key_enrichment_is_split_by_aqe(spark):
    """One ID holding a third of the left rows: AQE splits its partition.
    Thresholds are scaled down to the test size (defaults: 256 MB, 5x)."""
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.shuffle.partitions": "16",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k"}
    old = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        ids = F.concat(F.lit("A-"), F.col("id").cast("string"))
        left = spark.range(300000).select(
            F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(ids).alias("ID"), "id")
        right = spark.range(300000).select(ids.alias("ID"), (F.col("id") % 4).alias("p")) \
            .union(spark.createDataFrame([("HOT", 9)], "ID string, p long"))
        joined = enrich(left, right, "ID", ["p"])
        assert joined.count() == 300000
        joined.collect()
        final = plan(joined).split("== Initial Plan ==")[0]
        assert "SortMergeJoin(skew=true)" in final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_profile_uses_plain_hash_aggregates(spark):
    """No object aggregate, no fan-out of whole rows, and no added exchange in
    the fixture."""
    from strata.fixture import accidents
    from strata.operators import nulls
    from strata.plans import silver
    seen = []
    frame = type(spark.range(0))
    collect = frame.collect

    def spy(self):
        seen.append(plan(self))
        return collect(self)
    frame.collect = spy
    try:
        raw = accidents(spark, "/root/testdata/sf0.001")
        silver.profile(silver.prepare(raw))
    finally:
        frame.collect = collect
    assert seen and all("ObjectHashAggregate" not in p and "Generate" not in p for p in seen)
    assert "RoundRobin" not in plan(raw) and "REPARTITION" not in plan(raw)
    assert nulls.MEDIAN_BUCKETS > 1
