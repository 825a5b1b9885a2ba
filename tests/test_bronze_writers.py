"""One bronze root for batch and stream: orders, interruptions, take-over."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from strata import presets as P
from strata.plans import bronze
from strata.plans.bronze_table import last_run, migrate_bronze, read_bronze
from strata.sources.batches import dated_sources, latest_listed, list_dates, listed_dates
from strata.sources.sinks import write_partitioned
from strata.streaming import bronze_stream, run_bronze_stream
from tests.conftest import rows

DATES = ["2025_06_15", "2025_06_16", "2025_06_17"]


def _land(spark, raw, date, n=100, files=1):
    ids = spark.range(n).select(F.concat(F.lit(f"{date}-"), F.col("id").cast("string")).alias("ID"))
    write_partitioned(ids.repartition(files).withColumn(P.BATCH_COLUMN, F.lit(date)), raw)


def _counts(spark, bz):
    """Rows and distinct keys per date."""
    return {r[0]: (r[1], r[2]) for r in read_bronze(spark, bz).groupBy(P.BATCH_COLUMN).agg(
        F.count(F.lit(1)), F.count_distinct("ID")).collect()}


def _whole(dates, n=100):
    return {d: (n, n) for d in dates}


@pytest.mark.parametrize("order", ["sbs", "bsb", "ssb", "bbs"])
def test_every_order_of_writers_gives_all_rows(spark, tmp, order):
    raw, bz, ck = f"{tmp}/raw", f"{tmp}/bz", f"{tmp}/ck"
    for k, (date, who) in enumerate(zip(DATES, order)):
        _land(spark, raw, date)
        if who == "s":
            run_bronze_stream(spark, raw, bz, ck)
        else:
            bronze.accumulate(spark, raw, bz)
        assert _counts(spark, bz) == _whole(DATES[:k + 1])
    # a last run of either kind has nothing to add
    assert {r[1] for r in rows(run_bronze_stream(spark, raw, bz, ck)[1])} == {"present"}
    assert {r[2] for r in rows(bronze.accumulate(spark, raw, bz))} == {"present"}
    assert _counts(spark, bz) == _whole(DATES)


def _failing_write(monkeypatch, at, after):
    """The at-th micro-batch write of the stream fails, after or before it wrote."""
    real, calls = bronze_stream.write_part, []

    def write(df, root, part, col):
        calls.append(part)
        if len(calls) == at and not after:
            raise RuntimeError("killed")
        real(df, root, part, col)
        if len(calls) == at:
            raise RuntimeError("killed")
    monkeypatch.setattr(bronze_stream, "write_part", write)


@pytest.mark.parametrize("at,after,finish", [(1, False, "stream"), (2, True, "stream"), (4, True, "batch"),
                                             (2, True, "batch"), (3, True, "new stream")])
def test_a_killed_run_is_completed_without_loss_or_copies(spark, tmp, monkeypatch, at, after, finish):
    raw, bz, ck = f"{tmp}/raw", f"{tmp}/bz", f"{tmp}/ck"
    _land(spark, raw, "2025_06_14")
    bronze.accumulate(spark, raw, bz)
    for d in reversed(DATES):  # two files a date, the newest date first: dates are split over micro-batches
        _land(spark, raw, d, files=2)
    with monkeypatch.context() as m:
        _failing_write(m, at, after)
        with pytest.raises(Exception):
            run_bronze_stream(spark, raw, bz, ck, max_files_per_trigger=1)
    assert last_run(spark, bz).open
    if finish == "batch":
        report = rows(bronze.accumulate(spark, raw, bz))
        assert {r[0]: r[2] for r in report} == {"2025_06_14": "present", **{d: "ingested" for d in DATES}}
    else:
        again = ck if finish == "stream" else f"{tmp}/ck2"
        report = rows(run_bronze_stream(spark, raw, bz, again, max_files_per_trigger=1)[1])
        assert dict(report) == {"2025_06_14": "present", **{d: "ingested" for d in DATES}}
    assert not last_run(spark, bz).open
    assert _counts(spark, bz) == _whole(["2025_06_14", *DATES])
    # the interrupted stream itself comes back later
    _land(spark, raw, "2025_06_18")
    run_bronze_stream(spark, raw, bz, ck)
    assert _counts(spark, bz) == _whole(["2025_06_14", *DATES, "2025_06_18"])


def test_a_take_over_cut_short_is_repeated(spark, tmp, monkeypatch):
    from strata.plans import bronze_table
    raw, bz, ck = f"{tmp}/raw", f"{tmp}/bz", f"{tmp}/ck"
    for d in DATES:
        _land(spark, raw, d)
    with monkeypatch.context() as m:
        _failing_write(m, 2, True)
        with pytest.raises(Exception):
            run_bronze_stream(spark, raw, bz, ck, max_files_per_trigger=1)
    with monkeypatch.context() as m:  # dates removed, run not yet ended
        m.setattr(bronze_table, "record_run", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            bronze.accumulate(spark, raw, bz)
    bronze.accumulate(spark, raw, bz)
    assert _counts(spark, bz) == _whole(DATES)


def test_begun_dates_are_kept_when_raw_has_lost_them(spark, tmp, monkeypatch):
    import shutil
    raw, bz, ck = f"{tmp}/raw", f"{tmp}/bz", f"{tmp}/ck"
    _land(spark, raw, DATES[0])
    _land(spark, raw, DATES[1])
    with monkeypatch.context() as m:
        _failing_write(m, 2, True)
        with pytest.raises(Exception):
            run_bronze_stream(spark, raw, bz, ck, max_files_per_trigger=1)
    before = _counts(spark, bz)
    shutil.rmtree(f"{raw}/{P.BATCH_COLUMN}={DATES[0]}")
    with pytest.raises(ValueError, match="no longer in raw"):
        bronze.accumulate(spark, raw, bz)
    assert _counts(spark, bz) == before


def test_other_layouts_are_refused_and_can_be_copied(spark, tmp):
    raw = f"{tmp}/raw"
    _land(spark, raw, DATES[0])
    flat, sink = f"{tmp}/flat", f"{tmp}/sink"
    write_partitioned(spark.read.parquet(raw), flat)
    os.makedirs(f"{sink}/_spark_metadata")
    for root in (flat, sink):
        with pytest.raises(ValueError, match="migrate_bronze"):
            bronze.accumulate(spark, raw, root)
        with pytest.raises(ValueError, match="migrate_bronze"):
            run_bronze_stream(spark, raw, root, f"{tmp}/ck")
    migrate_bronze(spark, flat, f"{tmp}/bz")
    assert rows(bronze.accumulate(spark, raw, f"{tmp}/bz"))[0][2] == "present"
    assert _counts(spark, f"{tmp}/bz") == _whole(DATES[:1])


def test_readers_see_no_part_and_no_record(spark, tmp):
    raw, bz = f"{tmp}/raw", f"{tmp}/bz"
    _land(spark, raw, DATES[0])
    run_bronze_stream(spark, raw, bz, f"{tmp}/ck")
    assert sorted(os.listdir(bz)) == ["_runs", f"{P.BATCH_COLUMN}={DATES[0]}"]
    assert sorted(bronze.bronze_snapshot(spark, bz).columns) == ["ID", P.BATCH_COLUMN]


def _break(pattern):
    for f in glob.glob(pattern, recursive=True):
        with open(f, "wb") as fh:
            fh.write(b"broken")


def test_dates_come_from_a_listing(spark, tmp):
    raw, bz = f"{tmp}/raw", f"{tmp}/bz"
    for d in DATES:
        _land(spark, raw, d)
    bronze.accumulate(spark, raw, bz)
    _break(f"{bz}/**/*.parquet")
    os.makedirs(f"{bz}/{P.BATCH_COLUMN}=zz_manual")
    assert list_dates(spark, bz) == DATES and latest_listed(spark, bz) == DATES[-1]
    assert sorted(r[0] for r in rows(listed_dates(spark, bz))) == DATES
    assert list_dates(spark, f"{tmp}/nothing") == [] and latest_listed(spark, f"{tmp}/nothing") is None


def test_landing_directories_come_from_a_listing(spark, tmp):
    for d in (*DATES, "tmp_copy", ".staging"):
        spark.range(3).write.parquet(f"{tmp}/land/{d}/parquet")
    _break(f"{tmp}/land/**/*.parquet")
    assert dated_sources(spark, f"{tmp}/land") == {d: f"{tmp}/land/{d}/parquet" for d in DATES}
    assert latest_listed(spark, f"{tmp}/land") == DATES[-1]
