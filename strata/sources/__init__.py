"""Sources and sinks: files, catalog tables, dated batches, JDBC."""

from strata.sources.batches import (batch_dates, dated_directories, latest_date, latest_listed, list_dates,
                                    listed_dates, partition_values, read_if_exists, snapshot)
from strata.sources.files import read_csv, read_parquet
from strata.sources.jdbc import read_jdbc, write_jdbc
from strata.sources.sinks import save_table, write_csv, write_partitioned

__all__ = [
    "batch_dates", "dated_directories", "latest_date", "latest_listed", "list_dates", "listed_dates", "partition_values", "read_csv", "read_if_exists",
    "read_jdbc", "read_parquet", "save_table", "snapshot",
    "write_csv", "write_jdbc", "write_partitioned",
]
