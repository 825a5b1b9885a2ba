"""JDBC sink and source.

Connection settings come from the caller or from the environment
(`STRATA_JDBC_URL`, `STRATA_JDBC_USER`, `STRATA_JDBC_PASSWORD`,
`STRATA_JDBC_DRIVER`); credentials are never written in code.  Writes run
one connection per partition (`numPartitions` caps that), with batched
inserts; reads can be split on a numeric column.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def connection_properties(user: str | None = None, password: str | None = None,
                          driver: str | None = None) -> dict:
    props = {
        "user": user or os.environ.get("STRATA_JDBC_USER", ""),
        "password": password or os.environ.get("STRATA_JDBC_PASSWORD", ""),
    }
    drv = driver or os.environ.get("STRATA_JDBC_DRIVER")
    if drv:
        props["driver"] = drv
    return {k: v for k, v in props.items() if v}


def jdbc_url(url: str | None = None) -> str:
    url = url or os.environ.get("STRATA_JDBC_URL")
    if not url:
        raise ValueError("no JDBC url given and STRATA_JDBC_URL is unset")
    return url


def write_jdbc(df: DataFrame, table: str, url: str | None = None, properties: dict | None = None,
               mode: str = "overwrite", num_partitions: int | None = None, batch_size: int = 10000,
               truncate: bool = True) -> None:
    """Publish `df` to an RDBMS table.

    `truncate=True` keeps the target's definition on overwrite; each partition
    inserts `batch_size` rows per batch.  `num_partitions` caps the concurrent
    connections (Spark folds the frame to that many tasks); None leaves it whole.
    """
    props = dict(properties or connection_properties())
    props.update({"batchsize": str(batch_size), "truncate": "true" if truncate else "false"})
    if num_partitions:
        props["numPartitions"] = str(num_partitions)
    df.write.jdbc(jdbc_url(url), table, mode=mode, properties=props)


def read_jdbc(spark: SparkSession, table: str, url: str | None = None,
              properties: dict | None = None, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None,
              num_partitions: int = 8) -> DataFrame:
    """Read an RDBMS table (schema reflected from the database)."""
    props = dict(properties or connection_properties())
    if partition_column is not None:
        return spark.read.jdbc(jdbc_url(url), table, column=partition_column,
                               lowerBound=lower, upperBound=upper,
                               numPartitions=num_partitions, properties=props)
    return spark.read.jdbc(jdbc_url(url), table, properties=props)


def jdbc_publisher(url: str | None = None, properties: dict | None = None, **write_options):
    """Publisher writing each named frame to the RDBMS table of that name."""
    def publish(name: str, df: DataFrame) -> None:
        write_jdbc(df, name, url=url, properties=properties, **write_options)
    return publish
