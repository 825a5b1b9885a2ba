"""Incremental bronze as a Structured Streaming job.

The raw landing table is a file source; each run picks up only files it has
not seen (tracked in the checkpoint) and applies the bronze high-water mark.
Every micro-batch is written with the plain partitioned writer into parts of
its own (`bronze_table`), so a micro-batch that is run again after a lost
driver or executor replaces itself, and stream and batch runs may alternate on
one bronze root.  `availableNow` processes what is there and stops, so the same
job serves scheduled batch runs.  No state is kept: the operator is stateless,
so no watermark is needed.

The mark belongs to a run, not to a start: it is on record before the first
micro-batch is written, and a run that was interrupted resumes with the mark it
began with.  Bronze half-written by that run can therefore never turn its
remaining dates into late ones.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import presets as P
from strata.plans.bronze import ingestion_plan
from strata.plans.bronze_table import Run, check_layout, last_run, read_bronze, record_run, settle, write_part
from strata.sources.batches import partition_values, path_exists


def raw_schema(spark: SparkSession, raw_root: str) -> T.StructType:
    """Schema of the landed raw table (streaming file sources need one)."""
    return spark.read.parquet(raw_root).schema


def query_id(spark: SparkSession, checkpoint: str) -> str | None:
    """The id that the checkpoint's query keeps over restarts; None before its
    first start (a deleted checkpoint begins a new query)."""
    path = f"{checkpoint.rstrip('/')}/metadata"
    if not path_exists(spark, path):
        return None
    return json.loads(spark.read.text(path).first()[0])["id"]


def begin_run(spark: SparkSession, raw_root: str, bronze_root: str, checkpoint: str,
              col: str = P.BATCH_COLUMN) -> list[str]:
    """The dates bronze had when the current run began: those on record if this
    stream's run was cut short, else those it has now (after `settle`)."""
    check_layout(spark, bronze_root, col)
    return settle(spark, bronze_root, partition_values(spark, raw_root, col), query_id(spark, checkpoint), col)


def start_bronze_stream(spark: SparkSession, raw_root: str, bronze_root: str, checkpoint: str,
                        col: str = P.BATCH_COLUMN, schema: T.StructType | None = None,
                        max_files_per_trigger: int | None = None, pattern: str = P.BATCH_DIR_PATTERN):
    """Start (or resume) the availableNow ingestion; returns the StreamingQuery.

    Rows whose batch value is no date, or lies at or below the run's mark, are
    passed over; `run_bronze_stream` reports their dates."""
    schema = schema or raw_schema(spark, raw_root)
    have = begin_run(spark, raw_root, bronze_root, checkpoint, col)
    dated = [d for d, status in ingestion_plan(have, [], pattern).items() if status == "new"]
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(raw_root).filter(F.col(col).rlike(pattern))
    if dated:
        stream = stream.filter(F.col(col) > F.lit(max(dated)))

    writer: list[str] = []

    def ingest(batch: DataFrame, number: int) -> None:
        if not writer:  # the first micro-batch of this start
            writer.append(query_id(spark, checkpoint))
            run = last_run(spark, bronze_root)
            if run is None or not run.open:
                record_run(spark, bronze_root, Run(writer[0], have, True))
        write_part(batch, bronze_root, f"{writer[0][:8]}-{number:08d}", col)

    return (stream.writeStream.foreachBatch(ingest)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())


def run_bronze_stream(spark: SparkSession, raw_root: str, bronze_root: str, checkpoint: str,
                      col: str = P.BATCH_COLUMN, timeout_s: int | None = None,
                      max_files_per_trigger: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Run the ingestion to completion; returns the bronze dataset and a report
    (batch_date, status) with a row per landed value: ingested / present /
    late / invalid.

    `max_files_per_trigger` bounds each micro-batch when a large backlog has
    landed (availableNow still drains all of it, batch by batch).  With
    `timeout_s` a run that takes longer is stopped with an error and can be
    resumed."""
    have = begin_run(spark, raw_root, bronze_root, checkpoint, col)
    query = start_bronze_stream(spark, raw_root, bronze_root, checkpoint, col,
                                max_files_per_trigger=max_files_per_trigger)
    if timeout_s is None:
        query.awaitTermination()
    else:
        query.awaitTermination(timeout_s)
    if query.isActive:
        query.stop()
        raise TimeoutError(f"bronze stream did not finish within {timeout_s}s")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    run = last_run(spark, bronze_root)
    if run is not None and run.open:
        record_run(spark, bronze_root, Run(run.writer, run.ingested, False))
    plan = ingestion_plan(partition_values(spark, raw_root, col), have)
    report = [(d, "ingested" if status == "new" else status) for d, status in plan.items()]
    return (read_bronze(spark, bronze_root),
            spark.createDataFrame(report, f"{col} string, status string"))
