"""Positions in a sorted order, without bringing the order to one task.

Rows are range-partitioned and sorted, and written once with their place in
their own partition; a row's position is that place plus the row counts of the
partitions before.  What is summed up is one row per partition and group, so a
group of any size (all rows, one hot key) is spread over as many tasks as it
fills.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import scratch_path, unique_name

_PLACES = 33  # monotonically_increasing_id: the partition above these bits, the place in them


def number_partitions(df: DataFrame, order: list[Column], part: str, place: str,
                      n: int | None = None) -> DataFrame:
    """`df` range-partitioned and sorted by `order`, with each row's partition
    and its place (from 0) in it."""
    ranged = df.repartitionByRange(n, *order) if n else df.repartitionByRange(*order)
    ranged = ranged.withColumn(part, F.spark_partition_id()).sortWithinPartitions(F.col(part), *order)
    return ranged.withColumn(place, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _PLACES) - 1)))


def with_positions(df: DataFrame, order: list[Column], group: list[str] | None = None,
                   position: str = "position", size: str | None = None, name: str = "ranked") -> DataFrame:
    """`df` with each row's position (long, from 0) in `order` among the rows of
    its `group` (all rows when none is given) and, as `size`, their number.

    Rows that tie in `order` get positions in no set order, so name enough
    columns.  Null group values form a group.  `order` alone deals the rows, so
    equal values of all its columns share a task; end it with something that
    tells rows apart when one value may hold a large part of them.

    The sorted rows are written to the shared scratch folder first: positions
    then rest on files, and a task that is run again gives the same ones.
    """
    group = list(group or [])
    part, place = unique_name("part"), unique_name("place")
    first, before, rows = unique_name("first"), unique_name("before"), unique_name("rows")
    keys = [F.col(f"`{g}`").asc_nulls_first() for g in group]
    path = scratch_path(df.sparkSession, name)
    number_partitions(df, [*keys, *order], part, place).write.parquet(path)
    stored = df.sparkSession.read.parquet(path)

    names = {g: unique_name("group") for g in group}
    counts = stored.groupBy(F.col(part).alias(part), *[F.col(f"`{g}`").alias(a) for g, a in names.items()]).agg(
        F.count(F.lit(1)).alias(rows), F.min(place).alias(first))
    whole = Window.partitionBy(*names.values()) if names else Window.partitionBy(F.lit(0))
    earlier = whole.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col(part).alias(f"{part}_s"), *names.values(),
        (F.coalesce(F.sum(rows).over(earlier), F.lit(0)) - F.col(first)).alias(before),
        F.sum(rows).over(whole).alias(rows))
    same = F.col(part) == F.col(f"{part}_s")
    for g, a in names.items():
        same = same & F.col(f"`{g}`").eqNullSafe(F.col(a))
    out = [F.col(f"`{c}`") for c in df.columns if c not in {position, size}]
    out.append((F.col(place) + F.col(before)).cast("long").alias(position))
    if size:
        out.append(F.col(rows).cast("long").alias(size))
    return stored.join(starts, same).select(*out)
