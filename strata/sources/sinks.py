"""Sinks: partitioned parquet, CSV, catalog tables.

No writer funnels data through one task: file counts follow the data's
partitioning (optionally capped per file with `maxRecordsPerFile`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from strata import presets as P


def write_partitioned(df: DataFrame, path: str, partition_by: str | list = P.BATCH_COLUMN,
                      mode: str = "overwrite", max_records_per_file: int | None = None) -> None:
    """Parquet partitioned by `partition_by`.

    With the session's dynamic partition-overwrite mode, `overwrite` replaces
    only the partitions present in `df`, so re-writing one date is idempotent
    and leaves the other dates in place.
    """
    cols = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    writer = df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.partitionBy(*cols).parquet(path)


# Null marker for CSV files written and read by this library.  Spark's
# default (the empty string) cannot tell a null from an empty text.
CSV_NULL = "\\N"


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", null_value: str = CSV_NULL,
              partition_by: str | list | None = None, **options) -> None:
    """CSV with a header; nulls written as `null_value`, empty text as ``""``;
    optionally one directory per value of `partition_by`."""
    writer = (df.write.mode(mode).option("header", True).option("nullValue", null_value)
              .options(**options))
    if partition_by:
        writer = writer.partitionBy(*([partition_by] if isinstance(partition_by, str)
                                      else partition_by))
    writer.csv(path)


def save_table(df: DataFrame, name: str, path: str | None = None, mode: str = "overwrite",
               bucket_by: tuple[int, str] | None = None,
               partition_by: list[str] | None = None,
               max_records_per_file: int | None = None) -> None:
    """Parquet catalog table.

    `bucket_by=(n, key)` writes a bucketed, key-sorted table so that a later
    join on `key` with a table bucketed the same way needs no shuffle.  The
    rows are first hash-partitioned on `key` into exactly `n` partitions
    (the same hash and modulus that assign buckets), so each write task
    holds one bucket and writes one file: without it every task would write
    a file per bucket, tasks x buckets files in all.
    `path` makes it an external table at a chosen (shared) location.
    """
    if bucket_by:
        df = df.repartition(bucket_by[0], bucket_by[1])
    writer = df.write.mode(mode).format("parquet")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        n, key = bucket_by
        writer = writer.bucketBy(n, key).sortBy(key)
    writer.saveAsTable(name)


def parquet_publisher(root: str, mode: str = "overwrite"):
    """Publisher writing each named frame to `<root>/<name>` as parquet."""
    def publish(name: str, df: DataFrame) -> None:
        df.write.mode(mode).parquet(f"{root.rstrip('/')}/{name}")
    return publish
