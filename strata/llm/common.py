"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import scratch_path

# Words are runs without these characters (space, tab, LF, VT, FF, CR).
BLANKS = "\\x20\\x09-\\x0D"

BROADCAST_BYTES = 32 << 20  # measured size up to which a side is broadcast


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts the lineage with
    files that outlive any executor."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """Texts reach Python tasks in Arrow batches of 2 MB: Spark's default of
    64 MB is held several times over by a task (rows, buffers, Python).  A
    caller's own setting stands."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == "67108864b":
        spark.conf.set(key, "2m")


def own(name: str) -> str:
    """A column name that cannot clash with one the caller brought."""
    return f"__{name}_{uuid.uuid4().hex[:8]}"


def clashes(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns of the input that an operator is about to produce itself."""
    return df.drop(*[c for c in df.columns if c.lower() in {n.lower() for n in names}])


def _width(value: Column, kind: T.DataType) -> Column:
    """About the bytes that a value takes in a row."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(value).cast("long")
    elif isinstance(kind, T.StructType):
        size = sum((_width(value[f.name], f.dataType) for f in kind.fields), F.lit(0).cast("long"))
    elif isinstance(kind, T.ArrayType):
        size = F.aggregate(value, F.lit(0).cast("long"), lambda n, x: n + _width(x, kind.elementType))
    else:
        return F.lit(kind.precision // 8 + 8 if isinstance(kind, T.DecimalType) else 8).cast("long")
    return F.coalesce(size, F.lit(0).cast("long")) + 16


def row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row, whatever the lengths of its strings and arrays."""
    return sum((_width(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(16).cast("long"))


def broadcast_if_bounded(df: DataFrame, measured: DataFrame | None = None) -> DataFrame:
    """Broadcast hint only for a side whose rows take at most BROADCAST_BYTES;
    beyond it Spark's shuffled joins do the same work.  `measured` is a stored
    table with at least the same rows, where df itself would be costly to read."""
    of = df if measured is None else measured
    total = of.agg(F.sum(row_bytes(of))).first()[0] or 0
    return F.broadcast(df) if total <= BROADCAST_BYTES else df


def broadcast_if_small(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """Broadcast hint only for a counted side of at most `limit` rows; beyond
    it Spark's shuffled joins do the same work."""
    return F.broadcast(df) if rows <= limit else df
