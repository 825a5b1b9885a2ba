"""Enrichment join and by-name unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import presets as P
from strata.operators.columns import require_columns


class DuplicateKeyError(ValueError):
    pass


def assert_unique(df: DataFrame, key: str) -> None:
    """Fail if any `key` occurs twice.

    One aggregate over the key column only; it stops at the first duplicate
    group found, so its result is at most one row whatever the data size.
    """
    dup = (df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
           .filter(F.col("n") > 1).limit(1).collect())
    if dup:
        raise DuplicateKeyError(f"{key}={dup[0][0]!r} occurs {dup[0]['n']} times")


def enrich(left: DataFrame, right: DataFrame, key: str = P.KEY,
           cols: list[str] | None = None, how: str = "inner",
           check_unique: bool = True) -> DataFrame:
    """Attach `cols` of `right` to `left` on `key` (USING-style: key once, first).

    The right side is projected to key + cols before the join so only those
    columns are shuffled.  Spark chooses the strategy: a sort-merge join
    when both sides are large (no shuffle at all when both are bucketed on
    `key`), a broadcast hash join only when the right side's measured size is
    under the session's broadcast bound; AQE splits skewed key partitions.
    `check_unique` verifies the right key is unique first (a re-fed batch
    would otherwise multiply left rows) and raises `DuplicateKeyError` if not.
    """
    cols = [c for c in right.columns if c != key] if cols is None else cols
    require_columns(left, [key], "left side")
    require_columns(right, [key, *cols], "right side")
    slim = right.select(key, *cols)
    if check_unique:
        assert_unique(slim, key)
    return left.join(slim, on=key, how=how)


def join_audit(left: DataFrame, right: DataFrame, key: str = P.KEY) -> DataFrame:
    """(left_rows, right_rows, matched_rows) of an inner join on `key`, one job.

    Each side is reduced to per-key counts first (partial aggregation before
    the shuffle, so a hot key ships one row per task), then the two count
    tables are full-outer joined on the key.
    """
    lc = left.groupBy(key).agg(F.count(F.lit(1)).alias("l"))
    rc = right.groupBy(key).agg(F.count(F.lit(1)).alias("r"))
    both = lc.join(rc, on=key, how="full")
    return both.agg(
        F.coalesce(F.sum("l"), F.lit(0)).cast("bigint").alias("left_rows"),
        F.coalesce(F.sum("r"), F.lit(0)).cast("bigint").alias("right_rows"),
        F.coalesce(F.sum(F.col("l") * F.col("r")), F.lit(0)).cast("bigint").alias("matched_rows"),
    )


def union_by_name(frames: list[DataFrame], allow_missing: bool = False) -> DataFrame:
    """n-ary UNION ALL matched by column name (never by position)."""
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)
