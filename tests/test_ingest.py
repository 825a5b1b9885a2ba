"""Deliveries, landing, incremental bronze (batch and stream)."""

import os

from pyspark.sql import functions as F

from strata import presets as P
from strata.operators.ingest import (assign_deliveries, repartition_by_key, row_audit,
                                     split_hash, split_random, stamp)
from strata.plans import bronze
from strata.sources.batches import dated_directories, latest_date, read_if_exists
from strata.sources.files import read_csv
from strata.sources.sinks import write_csv, write_partitioned
from strata.streaming import run_bronze_stream
from tests.conftest import rows


def _ids(spark, n=600):
    return spark.range(n).select(F.concat(F.lit("A-"), F.col("id").cast("string")).alias("ID"),
                                 (F.col("id") % 7).alias("v"))


def test_split_hash_disjoint_exhaustive_stable(spark):
    df = _ids(spark)
    parts = split_hash(df, "ID", [0.33, 0.33, 0.34])
    sets = [set(r[0] for r in p.select("ID").collect()) for p in parts]
    assert sum(len(s) for s in sets) == 600
    assert set().union(*sets) == {f"A-{i}" for i in range(600)}
    again = split_hash(df.repartition(5), "ID", [0.33, 0.33, 0.34])
    assert [set(r[0] for r in p.select("ID").collect()) for p in again] == sets


def test_split_random_disjoint_exhaustive(spark):
    df = _ids(spark).cache()
    parts = split_random(df, [0.8, 0.2], 42)
    ids = [r[0] for p in parts for r in p.select("ID").collect()]
    assert len(ids) == len(set(ids)) == 600


def test_stamp_replaces_column(spark):
    df = spark.createDataFrame([("a", "old")], "ID string, situation_date string")
    out = stamp(df, "2025-06-20", "situation_date")
    assert out.columns == ["ID", "situation_date"]
    assert rows(out, "situation_date") == [("2025-06-20",)]


def test_repartition_preserves_rows(spark):
    df = _ids(spark)
    assert repartition_by_key(df, 5, "v").count() == 600
    assert repartition_by_key(df, 5, "v", balanced=False).rdd.getNumPartitions() == 5
    assert repartition_by_key(df, 5, "missing", balanced=False).rdd.getNumPartitions() == 5


def test_rebalance_splits_a_hot_key_on_write(spark, tmp):
    import glob

    import pyarrow.parquet as pq
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        df = spark.range(300000).withColumn(
            "k", F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") % 50).cast("string")))
        repartition_by_key(df, key="k").write.parquet(f"{tmp}/bal")
        sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{tmp}/bal/*.parquet")]
        assert sum(sizes) == 300000
        assert max(sizes) < 100000  # the 100,000 hot rows are not in one file
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_row_audit_counts_in_same_pass(spark, tmp):
    df, obs = row_audit(_ids(spark), "n")
    df.write.parquet(f"{tmp}/out")
    assert obs.get["rows"] == 600


def test_csv_roundtrip_keeps_empty_vs_null(spark, tmp):
    df = spark.createDataFrame([("a", 1.0), ("", None), (None, 2.0)], "s string, d double")
    write_csv(df, f"{tmp}/csv")
    back = read_csv(spark, f"{tmp}/csv", df.schema)
    assert sorted(rows(back), key=str) == sorted(rows(df), key=str)


def _landed(spark, tmp):
    raw = f"{tmp}/raw"
    counts = bronze.write_deliveries(_ids(spark), raw, "ID")
    return raw, {r[0]: r[1] for r in counts.collect()}


def test_deliveries_one_pass_three_dates(spark, tmp):
    raw, counts = _landed(spark, tmp)
    assert sorted(counts) == ["2025_06_15", "2025_06_16", "2025_06_17"]
    assert sum(counts.values()) == 600
    assert sorted(d for d in os.listdir(raw) if d.startswith("batch_date=")) == [
        "batch_date=2025_06_15", "batch_date=2025_06_16", "batch_date=2025_06_17"]


def test_snapshot_is_sum_of_batches(spark, tmp):
    raw, counts = _landed(spark, tmp)
    bz = f"{tmp}/bronze"
    report = {r[0]: r[2] for r in bronze.accumulate(spark, raw, bz).collect()}
    assert set(report.values()) == {"ingested"}
    running = 0
    for d in sorted(counts):
        running += counts[d]
        assert bronze.bronze_snapshot(spark, bz, d).count() == running
    sizes = rows(bronze.snapshot_sizes(spark.read.parquet(bz)).orderBy("batch_date"))
    assert [s[2] for s in sizes] == [counts["2025_06_15"], counts["2025_06_15"] +
                                     counts["2025_06_16"], 600]


def test_rerun_is_idempotent_and_late_date_reported(spark, tmp):
    raw, counts = _landed(spark, tmp)
    bz = f"{tmp}/bronze"
    bronze.accumulate(spark, raw, bz).collect()
    before = sorted(rows(spark.read.parquet(bz)))
    # same dates again: nothing new
    again = {r[0]: r[2] for r in bronze.accumulate(spark, raw, bz).collect()}
    assert set(again.values()) == {"present"}
    assert sorted(rows(spark.read.parquet(bz))) == before
    # a late delivery below the high-water mark
    late = _ids(spark, 10).withColumn(P.BATCH_COLUMN, F.lit("2025_06_14"))
    write_partitioned(late, raw)
    report = {r[0]: r[2] for r in bronze.accumulate(spark, raw, bz).collect()}
    assert report["2025_06_14"] == "late"
    assert sorted(rows(spark.read.parquet(bz))) == before


def test_missing_bronze_reads_as_none(spark, tmp):
    assert read_if_exists(spark, f"{tmp}/nothing") is None
    assert latest_date(None) is None


def test_land_isolates_a_bad_delivery(spark, tmp):
    raw, counts = _landed(spark, tmp)
    bad = f"{tmp}/bad"
    os.makedirs(bad)
    with open(f"{bad}/part-0.parquet", "w") as fh:
        fh.write("not parquet")
    sources = {d: f"{raw}/batch_date={d}" for d in counts}
    sources["2025_06_18"] = bad
    report = {r[0]: (r[1], r[2]) for r in bronze.land(spark, sources, f"{tmp}/landed").collect()}
    assert report["2025_06_18"] == (None, "failed")
    assert {d: report[d] for d in counts} == {d: (n, "landed") for d, n in counts.items()}


def test_dated_directories_ignore_stray_names(spark, tmp):
    df = _ids(spark, 20)
    df.write.parquet(f"{tmp}/land/2025_06_15/parquet")
    df.limit(5).write.parquet(f"{tmp}/land/2025_06_16/parquet")
    df.write.parquet(f"{tmp}/land/tmp_copy/parquet")
    got = sorted(rows(dated_directories(spark, f"{tmp}/land")))
    assert got == [("2025_06_15", 20), ("2025_06_16", 5)]


def test_stream_equals_batch_and_reruns_add_nothing(spark, tmp):
    raw, counts = _landed(spark, tmp)
    batch_bz, stream_bz = f"{tmp}/bz_batch", f"{tmp}/bz_stream"
    bronze.accumulate(spark, raw, batch_bz).collect()
    run_bronze_stream(spark, raw, stream_bz, f"{tmp}/ckpt")
    run_bronze_stream(spark, raw, stream_bz, f"{tmp}/ckpt")
    a = sorted(rows(spark.read.parquet(batch_bz).select("ID", "v", "batch_date")))
    b = sorted(rows(spark.read.parquet(stream_bz).select("ID", "v", "batch_date")))
    assert a == b and len(a) == 600


def test_assign_deliveries_uses_directory_dates(spark):
    out = assign_deliveries(_ids(spark, 50), "ID")
    assert {r[0] for r in out.select(P.BATCH_COLUMN).distinct().collect()} <= {
        "2025_06_15", "2025_06_16", "2025_06_17"}


def test_dated_layout_lands_and_single_file_delivery(spark, tmp):
    import glob

    from strata.sources.batches import dated_sources
    df = _ids(spark, 60).repartition(3)
    df.write.parquet(f"{tmp}/temp/2025_06_15/parquet")
    df.limit(20).write.parquet(f"{tmp}/temp/2025_06_16/parquet")
    sources = dated_sources(spark, f"{tmp}/temp")
    assert sorted(sources) == ["2025_06_15", "2025_06_16"]
    # an extra delivery made from one part file of an existing date
    part = sorted(glob.glob(f"{tmp}/temp/2025_06_16/parquet/part-*.parquet"))[0]
    sources["2025_06_20"] = part
    report = {r[0]: (r[1], r[2]) for r in bronze.land(spark, sources, f"{tmp}/raw").collect()}
    assert report["2025_06_15"] == (60, "landed") and report["2025_06_16"] == (20, "landed")
    single = spark.read.parquet(part).count()
    assert report["2025_06_20"] == (single, "landed")
    raw = spark.read.parquet(f"{tmp}/raw")
    assert raw.filter(F.col(P.BATCH_COLUMN) == "2025_06_20").count() == single


def test_non_date_partition_never_becomes_the_mark(spark, tmp):
    raw, counts = _landed(spark, tmp)
    stray = _ids(spark, 5).withColumn(P.BATCH_COLUMN, F.lit("zz_manual"))
    write_partitioned(stray, raw)
    report = {r[0]: r[2] for r in bronze.accumulate(spark, raw, f"{tmp}/bz").collect()}
    assert report["zz_manual"] == "invalid"
    assert {report[d] for d in counts} == {"ingested"}
    late = _ids(spark, 7).withColumn(P.BATCH_COLUMN, F.lit("2025_06_18"))
    write_partitioned(late, raw)
    again = {r[0]: r[2] for r in bronze.accumulate(spark, raw, f"{tmp}/bz").collect()}
    assert again["2025_06_18"] == "ingested"


def test_table_file_size_cap(spark, tmp):
    import glob

    from strata.sources.sinks import save_table
    save_table(_ids(spark, 100).coalesce(1), "capped", path=f"{tmp}/capped",
               max_records_per_file=30)
    assert len(glob.glob(f"{tmp}/capped/*.parquet")) == 4
    assert spark.table("capped").count() == 100


def test_csv_copy_has_one_directory_per_date(spark, tmp):
    counts = bronze.write_deliveries(_ids(spark), f"{tmp}/d", "ID", csv_root=f"{tmp}/c")
    dirs = sorted(d for d in os.listdir(f"{tmp}/c") if d.startswith("batch_date="))
    assert dirs == ["batch_date=2025_06_15", "batch_date=2025_06_16", "batch_date=2025_06_17"]
    back = read_csv(spark, f"{tmp}/c", None, infer=False)
    assert back.count() == 600 and sum(r[1] for r in counts.collect()) == 600


def test_stream_in_bounded_micro_batches(spark, tmp):
    raw, counts = _landed(spark, tmp)
    out, report = run_bronze_stream(spark, raw, f"{tmp}/bz", f"{tmp}/ck", max_files_per_trigger=1)
    assert out.count() == 600 and {r[1] for r in rows(report)} == {"ingested"}


def test_stream_stopped_after_a_batch_resumes_without_loss(spark, tmp):
    import time

    from strata.streaming.bronze_stream import start_bronze_stream
    raw, bz, ck = f"{tmp}/raw", f"{tmp}/bz", f"{tmp}/ck"
    # the newest date is written first, so a stream that reads file by file
    # may meet it first and would take the others for late ones
    for d in ("2025_06_17", "2025_06_16", "2025_06_15"):
        write_partitioned(_ids(spark, 100).coalesce(1).withColumn(P.BATCH_COLUMN, F.lit(d)), raw)
    query = start_bronze_stream(spark, raw, bz, ck, max_files_per_trigger=1)
    while query.isActive and not query.recentProgress:
        time.sleep(0.05)
    query.stop()
    table, report = run_bronze_stream(spark, raw, bz, ck, max_files_per_trigger=1)
    assert table.count() == 300
    assert sorted(rows(report)) == [(d, "ingested") for d in ("2025_06_15", "2025_06_16", "2025_06_17")]


def test_stream_reports_late_and_invalid_dates(spark, tmp):
    raw, counts = _landed(spark, tmp)
    run_bronze_stream(spark, raw, f"{tmp}/bz", f"{tmp}/ck")
    for d in ("2025_06_14", "zz_manual", "2025_06_18"):
        write_partitioned(_ids(spark, 5).withColumn(P.BATCH_COLUMN, F.lit(d)), raw)
    table, report = run_bronze_stream(spark, raw, f"{tmp}/bz", f"{tmp}/ck")
    assert dict(rows(report)) == {**{d: "present" for d in counts}, "2025_06_14": "late",
                                  "zz_manual": "invalid", "2025_06_18": "ingested"}
    assert table.count() == 605


def test_accumulate_opens_new_dates_only(spark, tmp):
    import glob
    raw, counts = _landed(spark, tmp)
    bz = f"{tmp}/bz"
    bronze.accumulate(spark, raw, bz).collect()
    for root in (raw, bz):
        for f in glob.glob(f"{root}/batch_date=2025_06_1[56]/*.parquet"):
            with open(f, "wb") as fh:
                fh.write(b"broken")
    write_partitioned(_ids(spark, 9).withColumn(P.BATCH_COLUMN, F.lit("2025_06_18")), raw)
    report = {r[0]: (r[1], r[2]) for r in bronze.accumulate(spark, raw, bz).collect()}
    assert report["2025_06_18"] == (9, "ingested") and report["2025_06_15"] == (None, "present")


def test_paths_without_scheme_live_on_the_default_file_system(spark, tmp):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    os.makedirs(f"{tmp}/store")
    conf.set("fs.viewfs.mounttable.lake.link./data", f"file://{tmp}/store")
    conf.set("fs.defaultFS", "viewfs://lake/")
    try:
        raw, bz = "/data/raw", "/data/bronze"
        write_partitioned(_ids(spark, 10).withColumn(P.BATCH_COLUMN, F.lit("2025_06_15")), raw)
        assert not os.path.exists(raw)
        assert [tuple(r) for r in bronze.accumulate(spark, raw, bz).collect()] == [("2025_06_15", 10, "ingested")]
        assert [tuple(r) for r in bronze.accumulate(spark, raw, bz).collect()] == [("2025_06_15", None, "present")]
        assert read_if_exists(spark, bz).count() == 10
    finally:
        conf.set("fs.defaultFS", before)


def test_splits_keep_null_keys_and_small_weights(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), "id")
    a, b = split_hash(df, "k", [0.996, 0.004])
    n = b.count()
    assert 30 <= n <= 140 and a.count() + n == 20000
    assert b.filter("k IS NULL").count() > 0
    dated = assign_deliveries(df, "k")
    assert dated.filter(F.col(P.BATCH_COLUMN).isNull()).count() == 0
    spread = {r[0]: r[1] for r in dated.filter("k IS NULL").groupBy(P.BATCH_COLUMN).count().collect()}
    assert len(spread) == 3 and min(spread.values()) > 1500


def test_rebalance_takes_the_count(spark):
    text = repartition_by_key(_ids(spark), 10, "v")._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in text and "10" in text.splitlines()[0]


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    import pytest

    from strata import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default
    with pytest.raises(ValueError):
        session.checkpoint_dir(Session())
