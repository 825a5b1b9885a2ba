"""Previews and paged reads.

`page` sorts for every page; `page_after` goes on from a key; a `PageIndex` is
built once for a table and then reads any page from the few files that hold it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata import presets as P
from strata.operators.ranking import number_partitions


def preview(df: DataFrame, n: int = 10, key: str = P.KEY) -> DataFrame:
    """First `n` rows by `key`: a per-task top-n, then a merge of those."""
    return df.orderBy(F.col(key)).limit(n)


def page(df: DataFrame, offset: int = 0, limit: int = 1, key: str = P.KEY) -> DataFrame:
    """Rows `offset .. offset+limit-1` in `key` order (stable across calls).

    Spark keeps `offset + limit` rows to find the page, so this is for the
    first pages; `page_after` reads deep ones from the last key seen, a
    `PageIndex` any.
    """
    return df.orderBy(F.col(key)).offset(offset).limit(limit)


def page_after(df: DataFrame, last_key, limit: int = 10, key: str = P.KEY) -> DataFrame:
    """Keyset page: the `limit` rows after `last_key`.  The predicate reaches
    the scan, so deep pages cost no more than the first."""
    src = df if last_key is None else df.filter(F.col(key) > F.lit(last_key))
    return src.orderBy(F.col(key)).limit(limit)


PART, PLACE = "page_part", "page_place"


def build_page_index(df: DataFrame, path: str, key: str = P.KEY, partitions: int | None = None) -> PageIndex:
    """Write the position index of `df` in `key` order (null first) to `path`:
    a range-sorted copy, one directory per range, and the position each starts
    at.  Equal keys are in no set order among themselves, but in the same one
    for every page.  `partitions` is the number of ranges to aim for (default:
    the shuffle partition count)."""
    taken = {PART, PLACE} & set(df.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are the index's own")
    spark, root = df.sparkSession, path.rstrip("/")
    number_partitions(df, [F.col(f"`{key}`").asc_nulls_first()], PART, PLACE, partitions) \
        .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(PART).parquet(f"{root}/rows")
    df.limit(0).write.mode("overwrite").parquet(f"{root}/schema")
    # counts come from the files' footers; the window runs over one row a range
    counts = spark.read.schema(f"{PART} int").parquet(f"{root}/rows").groupBy(PART).agg(
        F.count(F.lit(1)).alias("rows"))
    upto = F.sum("rows").over(Window.orderBy(PART))
    counts.withColumn("start", upto - F.col("rows")).coalesce(1) \
        .write.mode("overwrite").parquet(f"{root}/starts")
    return PageIndex(spark, root)


class PageIndex:
    """Pages by position from the copy that `build_page_index` wrote."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark, self._root = spark, path.rstrip("/")

    def size(self) -> int:
        return self._starts().agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]

    def _starts(self) -> DataFrame:
        return self._spark.read.schema(f"{PART} int, rows long, start long").parquet(f"{self._root}/starts")

    def page(self, offset: int = 0, limit: int = 1) -> DataFrame:
        """Rows `offset .. offset+limit-1`, in order.  Only the ranges that hold
        them are listed and read; in the first and the last, the place reaches
        the parquet scan, so other row groups are skipped."""
        rows = f"{self._root}/rows"
        held = (F.col("start") < offset + limit) & (F.col("start") + F.col("rows") > offset)
        ranges = self._starts().filter(held).orderBy("start").collect()
        if limit <= 0 or not ranges:
            return self._spark.read.parquet(f"{self._root}/schema")
        first, last = ranges[0], ranges[-1]
        reader = self._spark.read.option("basePath", rows)
        ends = {r[PART]: reader.parquet(f"{rows}/{PART}={r[PART]}").filter(
            F.col(PLACE).between(max(0, offset - r["start"]), offset + limit - 1 - r["start"]))
            for r in (first, last)}
        out = ends[first[PART]]
        between = [f"{rows}/{PART}={r[PART]}" for r in ranges[1:-1]]
        if between:
            out = out.unionByName(reader.parquet(*between))
        if last[PART] != first[PART]:
            out = out.unionByName(ends[last[PART]])
        return out.orderBy(PART, PLACE).drop(PART, PLACE)
