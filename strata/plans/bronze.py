"""Bronze layer: deliveries, landing and incremental accumulation.

Layout: every layer is one parquet dataset partitioned by `batch_date`
(`<root>/batch_date=YYYY_MM_DD/`; bronze further by the part that wrote the
rows, see `bronze_table`).  Bronze is append-only: each new date is
written once into its own partition, and the snapshot as of a date is a
partition-pruned filter, so an ingestion run costs the size of the new
batches, not of the whole history.  Writes use dynamic partition overwrite,
so a re-run (or a job retried after executor loss) rewrites the same
partitions instead of duplicating rows.
"""

from __future__ import annotations

import logging
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import presets as P
from strata.operators.ingest import assign_deliveries, committed_rows, stamp
from strata.plans.bronze_table import BATCH_PART, PART_COLUMN, check_layout, read_bronze, settle, write_part
from strata.sources.batches import partition_values, snapshot
from strata.sources.sinks import write_csv, write_partitioned

log = logging.getLogger(__name__)

REPORT_SCHEMA = "batch_date string, rows bigint, status string"


def write_deliveries(df: DataFrame, root: str, key: str = P.KEY, dates=None, weights=None,
                     csv_root: str | None = None, col: str = P.BATCH_COLUMN) -> DataFrame:
    """Split `df` into dated deliveries by key hash and write them in one pass.

    The optional CSV copy (one directory per date) is produced from the
    written parquet (a columnar re-read), not by recomputing or caching the
    input.  Returns per-date row
    counts read from the written partitions.
    """
    write_partitioned(assign_deliveries(df, key, dates, weights, col), root, col)
    written = df.sparkSession.read.parquet(root)
    if csv_root:
        write_csv(written, csv_root, partition_by=col)  # one CSV directory per date
    return written.groupBy(col).agg(F.count(F.lit(1)).alias("rows"))


def land(spark: SparkSession, sources: dict, raw_root: str,
         col: str = P.BATCH_COLUMN) -> DataFrame:
    """Land each delivery `{date: path}` into the raw table, isolating failures.

    A delivery that cannot be read or written is reported as failed and the
    others continue.  Each landing overwrites only its own date partition.
    """
    report = []
    for date in sorted(sources):
        try:
            write_partitioned(stamp(spark.read.parquet(sources[date]), date, col), raw_root, col)
            report.append((date, committed_rows(spark, f"{raw_root.rstrip('/')}/{col}={date}"), "landed"))
        except Exception as exc:  # noqa: BLE001 - per-date isolation is the feature
            log.error("landing %s failed: %s", date, exc)
            report.append((date, None, "failed"))
    return spark.createDataFrame(report, REPORT_SCHEMA)


def ingestion_plan(landed: list, ingested: list, pattern: str = P.BATCH_DIR_PATTERN) -> dict:
    """{landed value: status} against the dates bronze has: `new` dates lie
    above the high-water mark (bronze's greatest date), `present` ones are in
    bronze, `late` ones are neither, and values that are no dates are
    `invalid`; those never count towards the mark."""
    is_date = re.compile(pattern).match
    have = {d for d in ingested if d is not None and is_date(d)}
    mark = max(have, default=None)

    def status(d):
        if d is None or not is_date(d):
            return "invalid"
        if mark is None or d > mark:
            return "new"
        return "present" if d in have else "late"
    return {d: status(d) for d in landed}


def accumulate(spark: SparkSession, raw_root: str, bronze_root: str,
               col: str = P.BATCH_COLUMN, pattern: str = P.BATCH_DIR_PATTERN) -> DataFrame:
    """Append raw dates newer than bronze's high-water mark to bronze.

    Dates at or below the mark that bronze lacks are late deliveries: they
    are not ingested (the mark is strict) but are reported as `late`.  Values
    that are not dates (`pattern`) are reported as `invalid`.  Returns one
    report row per raw value: ingested / present / late / invalid, with the
    rows written for ingested dates (null for the others).

    Dates come from the two partition listings and rows from the footers of
    the files that were written, so a run opens the files of its new dates and
    no others, and a job that was run again counts nothing twice.
    Dates that a stream run began and did not end are ingested anew, whole.
    """
    check_layout(spark, bronze_root, col)
    landed = partition_values(spark, raw_root, col)
    plan = ingestion_plan(landed, settle(spark, bronze_root, landed, col=col), pattern)
    report = []
    # one job per new date, oldest first: the mark (max date in bronze) can
    # only advance once every earlier date is committed, so an interrupted
    # run never leaves a gap that a re-run would take for a late delivery
    for d, status in plan.items():
        rows = None
        if status == "new":
            batch = spark.read.parquet(f"{raw_root.rstrip('/')}/{col}={d}")
            write_part(stamp(batch, d, col), bronze_root, BATCH_PART, col)
            rows = committed_rows(spark, f"{bronze_root.rstrip('/')}/{col}={d}/{PART_COLUMN}={BATCH_PART}")
            status = "ingested"
        elif status != "present":
            log.warning("raw partition %r not ingested: %s", d, status)
        report.append((d, rows, status))
    return spark.createDataFrame(report, REPORT_SCHEMA)


def bronze_snapshot(spark: SparkSession, bronze_root: str, date: str | None = None,
                    col: str = P.BATCH_COLUMN) -> DataFrame:
    """Rows delivered up to `date` (latest when None), partition-pruned."""
    return snapshot(read_bronze(spark, bronze_root), date, col)


def snapshot_sizes(bronze: DataFrame, col: str = P.BATCH_COLUMN) -> DataFrame:
    """(batch_date, rows, snapshot_rows): size of each batch and of the
    cumulative snapshot at that date.  The window runs over one row per
    date (the per-date counts), never over data rows."""
    from pyspark.sql import Window
    per_date = bronze.groupBy(col).agg(F.count(F.lit(1)).alias("rows"))
    w = Window.orderBy(col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_date.withColumn("snapshot_rows", F.sum("rows").over(w))
