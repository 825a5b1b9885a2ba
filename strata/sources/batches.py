"""Batch discovery over dated deliveries.

Two layouts are understood:
* a table partitioned by `batch_date` (what this library writes);
* dated directories `<root>/<YYYY_MM_DD>/...` (hand-made deliveries).
Dates come from one directory listing, filtered by the date pattern, so a stray
directory (`_tmp`, `.staging`) can never become a high-water mark.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import presets as P


def read_if_exists(spark: SparkSession, path: str, **options) -> DataFrame | None:
    """`spark.read.parquet(path)`, or None when nothing exists there yet.

    A path that exists and cannot be read (corrupt footer, permissions) raises:
    silently starting a new history from an unreadable one would lose data.
    """
    fs, target = _file_system(spark, path)
    return spark.read.options(**options).parquet(path) if fs.exists(target) else None


def _file_system(spark: SparkSession, path: str):
    """The path's own file system (`fs.defaultFS` without a scheme)."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def child_names(spark: SparkSession, pattern: str, keep=lambda name: True) -> list[str]:
    """Names of what lies directly in the folders that match `pattern` (a glob);
    empty when there are none."""
    fs, target = _file_system(spark, f"{pattern.rstrip('/')}/*")
    return [name for name in (f.getPath().getName() for f in fs.globStatus(target) or []) if keep(name)]


def delete_paths(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        fs, target = _file_system(spark, path)
        fs.delete(target, True)


def partition_values(spark: SparkSession, root: str, col: str = P.BATCH_COLUMN) -> list[str | None]:
    """Values of the first partition column of a table, sorted, None for its
    null partition; empty when nothing is there.  One directory listing on the
    path's own file system: no data file is opened, so the cost is the number
    of dates, whatever they hold."""
    fs, path = _file_system(spark, root)
    if not fs.exists(path):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(path) if f.isDirectory()]
    values = [unquote(n.split("=", 1)[1]) for n in names if n.startswith(f"{col}=")]
    return sorted((None if v == "__HIVE_DEFAULT_PARTITION__" else v for v in values),
                  key=lambda v: (v is not None, v))


def list_dates(spark: SparkSession, root: str, pattern: str = P.BATCH_DIR_PATTERN,
               col: str = P.BATCH_COLUMN) -> list[str]:
    """Dates of a dated root, ascending, from one directory listing: those of
    `<col>=<date>` partitions and of hand-made `<date>` directories.  Names that
    are no dates do not count and no data file is opened, so neither a stray
    directory nor an unreadable old file can change the answer."""
    names = {n.split("=", 1)[1] if n.startswith(f"{col}=") else n for n in child_names(spark, root)}
    return sorted(d for d in map(unquote, names) if re.match(pattern, d))


def listed_dates(spark: SparkSession, root: str, pattern: str = P.BATCH_DIR_PATTERN,
                 col: str = P.BATCH_COLUMN) -> DataFrame:
    """`list_dates` as rows."""
    return spark.createDataFrame([(d,) for d in list_dates(spark, root, pattern, col)], f"{col} string")


def latest_listed(spark: SparkSession, root: str, pattern: str = P.BATCH_DIR_PATTERN,
                  col: str = P.BATCH_COLUMN) -> str | None:
    """The latest date of a dated root (None when it has none), from a listing."""
    return max(list_dates(spark, root, pattern, col), default=None)


def batch_dates(df: DataFrame, col: str = P.BATCH_COLUMN) -> DataFrame:
    """Distinct values of a batch column; for frames whose root is not known
    (`listed_dates` opens no file)."""
    return df.select(col).distinct()


def latest_date(df: DataFrame | None, col: str = P.BATCH_COLUMN) -> str | None:
    """Lexical maximum of the batch column (None for no table / no rows); for
    frames whose root is not known (`latest_listed` opens no file)."""
    if df is None:
        return None
    return df.agg(F.max(col).alias("m")).first()["m"]


def snapshot(df: DataFrame, date: str | None = None, col: str = P.BATCH_COLUMN) -> DataFrame:
    """All rows delivered up to `date` (default: latest). Partition-pruned."""
    if date is None:
        return df
    return df.filter(F.col(col) <= F.lit(date))


def dated_directories(spark: SparkSession, root: str,
                      pattern: str = P.BATCH_DIR_PATTERN) -> DataFrame:
    """Dates of `<root>/<date>/...` parquet deliveries, with their row counts
    (read from the files' footers; `listed_dates` has the dates alone)."""
    files = (spark.read.option("recursiveFileLookup", "true").parquet(root)
             .select(F.col("_metadata.file_path").alias("p")))
    rel = F.regexp_replace(F.col("p"), r"^.*?" + re.escape(root.rstrip("/")) + "/", "")
    name = F.split(rel, "/").getItem(0)
    return (files.select(name.alias(P.BATCH_COLUMN))
            .filter(F.col(P.BATCH_COLUMN).rlike(pattern))
            .groupBy(P.BATCH_COLUMN).agg(F.count(F.lit(1)).alias("rows")))


def dated_sources(spark: SparkSession, root: str, leaf: str = "parquet",
                  pattern: str = P.BATCH_DIR_PATTERN) -> dict:
    """`{date: "<root>/<date>/<leaf>"}` for the dated deliveries under `root`,
    from a listing."""
    base = root.rstrip("/")
    return {d: f"{base}/{d}/{leaf}" if leaf else f"{base}/{d}" for d in list_dates(spark, root, pattern)}
