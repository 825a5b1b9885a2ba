"""Null handling and data-quality profiles.

All means needed by one imputation are computed in a single aggregate job,
medians by counting, in at most five more jobs for all columns; all fills are
applied in a single projection.
"""

from __future__ import annotations

import logging
import struct

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import presets as P

log = logging.getLogger(__name__)

_FLOATING = (T.FloatType, T.DoubleType)


def dropna_subset(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows with a null (or NaN) in any of `subset`."""
    subset = P.TWILIGHT_REQUIRED if subset is None else subset
    present = [c for c in subset if c in df.columns]
    return df.na.drop(how="any", subset=present) if present else df


def fill_constant(df: DataFrame, values: dict) -> DataFrame:
    """`fillna` by column; doubles also replace NaN, strings keep ''."""
    present = {c: v for c, v in values.items() if c in df.columns}
    return df.na.fill(present) if present else df


# 13 bits of the ordered 64-bit integers behind doubles are settled a pass, so
# five passes find any median, whatever the values and however many columns.
MEDIAN_BUCKETS = 1 << 13


def imputation_stats(df: DataFrame, mean: list[str] = (), median: list[str] = ()) -> dict:
    """Mean and exact median per column, as doubles.

    Nulls are ignored; NaN would poison an average, so (as the fill below
    treats NaN as missing) it is excluded too.  The median is the least value
    with at least half of the values at or below it; infinities count, -0.0 is
    0.0.  One aggregate job gives the means and the ends of the median columns;
    `_medians` then counts, all columns at once.
    """
    exprs = [F.avg(_valid(df, c)).alias(f"mean::{c}") for c in mean]
    for c in median:
        v = _number(df, c)
        finite = F.when(F.abs(v) < F.lit(float("inf")), v)
        exprs += [F.count(v).alias(f"n::{c}"), F.count_if(v == F.lit(float("-inf"))).alias(f"low::{c}"),
                  F.count(finite).alias(f"finite::{c}"), F.min(finite).alias(f"min::{c}"),
                  F.max(finite).alias(f"max::{c}")]
    if not exprs:
        return {}
    row = df.agg(*exprs).first()
    stats = {f"mean::{c}": row[f"mean::{c}"] for c in mean}
    search = {}
    for c in median:
        rank = (row[f"n::{c}"] + 1) // 2 - row[f"low::{c}"]  # among the finite values
        if not row[f"n::{c}"]:
            stats[f"median::{c}"] = None
        elif rank <= 0 or rank > row[f"finite::{c}"]:
            stats[f"median::{c}"] = float("-inf") if rank <= 0 else float("inf")
        else:
            search[c] = (rank, row[f"min::{c}"], row[f"max::{c}"])
    stats.update({f"median::{c}": v for c, v in _medians(df, search).items()})
    return stats


def _number(df: DataFrame, c: str) -> Column:
    return _valid(df, c).cast("double") + F.lit(0.0)  # -0.0 + 0.0 is 0.0


def _ordered(x: float) -> int:
    """The place of a finite double in the order of all doubles (0.0 is 0)."""
    bits = struct.unpack("<q", struct.pack("<d", x))[0]
    return bits if bits >= 0 else -(bits & 0x7FFFFFFFFFFFFFFF)


def _double(place: int) -> float:
    x = struct.unpack("<d", struct.pack("<q", abs(place)))[0]
    return x if place >= 0 else -x


def _splits(low: float, high: float) -> list[float]:
    """Ends of at most MEDIAN_BUCKETS buckets over [low, high], each with
    equally many doubles."""
    first, last = _ordered(low), _ordered(high)
    step = -(-(last - first + 1) // MEDIAN_BUCKETS)
    return [_double(k) for k in range(first, last + 1, step)] + [_double(last + 1)]


def _medians(df: DataFrame, search: dict[str, tuple]) -> dict[str, float]:
    """The value of each column's rank among those in [low, high]; `search` has
    (rank, low, high) per column.  A pass narrows every column to the bucket
    that holds its rank, until that bucket holds one value."""
    found = {}
    while search:
        found.update({c: low for c, (_, low, high) in search.items() if low == high})
        search = {c: s for c, s in search.items() if c not in found}
        if search:
            search = _narrow(df, search)
    return found


def _narrow(df: DataFrame, search: dict[str, tuple]) -> dict[str, tuple]:
    """One pass over the rows for all columns: count the values of each bucket
    and keep the bucket of the rank.  Tasks count before the shuffle, so at most
    MEDIAN_BUCKETS rows per column and task leave it, and one row per column
    reaches the driver."""
    columns = list(search)
    values = [F.when(_number(df, c).between(F.lit(low), F.lit(high)), _number(df, c)).alias(f"v{k}")
              for k, (c, (_, low, high)) in enumerate(search.items())]
    bucketizer = Bucketizer(
        inputCols=[f"v{k}" for k in range(len(columns))], outputCols=[f"b{k}" for k in range(len(columns))],
        splitsArray=[_splits(low, high) for _, low, high in search.values()], handleInvalid="keep")
    keys = [f"b{k}" for k in range(len(columns))]
    # one grouping set a column; a set's grouping id has a zero bit at its own key
    own = [F.col("g") == (1 << len(keys)) - 1 - (1 << (len(keys) - 1 - k)) for k in range(len(keys))]
    pick = lambda names: F.coalesce(*[F.when(o, F.col(n)) for o, n in zip(own, names)])
    ends = [f(f"v{k}").alias(f"{n}{k}") for k in range(len(keys)) for n, f in (("low", F.min), ("high", F.max))]
    counts = (bucketizer.transform(df.select(*values))
              .groupingSets([[F.col(k)] for k in keys], *[F.col(k) for k in keys])
              .agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("g"), *ends)
              .select(F.coalesce(*[F.when(o, F.lit(k)) for k, o in enumerate(own)]).alias("c"), pick(keys).alias("b"),
                      "n", pick([f"low{k}" for k in range(len(keys))]).alias("low"),
                      pick([f"high{k}" for k in range(len(keys))]).alias("high"))
              .filter(F.col("low").isNotNull()))  # the group without values is no bucket
    upto = F.sum("n").over(Window.partitionBy("c").orderBy("b"))
    rank = F.element_at(F.array(*[F.lit(rank).cast("long") for rank, _, _ in search.values()]), F.col("c") + 1)
    rows = (counts.withColumn("before", upto - F.col("n")).withColumn("rank", rank - F.col("before"))
            .filter(F.col("rank").between(1, F.col("n"))).select("c", "rank", "low", "high").collect())
    return {columns[r["c"]]: (r["rank"], r["low"], r["high"]) for r in rows}


def _valid(df: DataFrame, c: str) -> Column:
    col = F.col(c)
    if isinstance(df.schema[c].dataType, _FLOATING):
        return F.when(~F.isnan(col), col)
    return col


def impute(df: DataFrame, mean: list[str] | None = None, zero: list[str] | None = None,
           median: list[str] | None = None, decimals: int = 2,
           stats: dict | None = None) -> DataFrame:
    """Fill nulls/NaN with the column mean, 0.0 or median, then round every
    imputed column to `decimals` (the whole column, not just filled cells).

    `stats` may be passed in from `imputation_stats` to share one aggregate
    across several frames derived from the same rows.  Absent columns are
    reported and skipped.  If a statistic is null (an all-null column) the
    column is left as is and reported.
    """
    mean = P.IMPUTE_MEAN if mean is None else mean
    zero = P.IMPUTE_ZERO if zero is None else zero
    median = P.IMPUTE_MEDIAN if median is None else median
    present = lambda cols: [c for c in cols if c in df.columns]
    missing = [c for c in [*mean, *zero, *median] if c not in df.columns]
    if missing:
        log.warning("imputation skipped for absent columns: %s", ", ".join(missing))
    mean_c, zero_c, median_c = present(mean), present(zero), present(median)
    if stats is None:
        stats = imputation_stats(df, mean_c, median_c)
    fills: dict[str, float] = {c: 0.0 for c in zero_c}
    for c in mean_c:
        fills[c] = stats.get(f"mean::{c}")
    for c in median_c:
        fills[c] = stats.get(f"median::{c}")
    exprs = {}
    for c, v in fills.items():
        if v is None:
            log.warning("no statistic for %s (all values missing); left unfilled", c)
            continue
        col = F.col(c)
        missing_cell = col.isNull()
        if isinstance(df.schema[c].dataType, _FLOATING):
            missing_cell = missing_cell | F.isnan(col)
        exprs[c] = F.round(F.when(missing_cell, F.lit(float(v))).otherwise(col), decimals)
    return df.withColumns(exprs) if exprs else df


def missing_condition(df: DataFrame, c: str) -> Column:
    """Null for every type; NaN as well for float and double columns."""
    cond = F.col(c).isNull()
    if isinstance(df.schema[c].dataType, _FLOATING):
        cond = cond | F.isnan(F.col(c))
    return cond


def null_profile(df: DataFrame) -> DataFrame:
    """One row: per column, the number of missing values (type-aware)."""
    return df.select([F.count(F.when(missing_condition(df, c), F.lit(1))).alias(c)
                      for c in df.columns])


def null_profile_long(df: DataFrame) -> DataFrame:
    """Long form (column_name, missing) of `null_profile`, same single pass."""
    wide = null_profile(df)
    return wide.unpivot([], [F.col(f"`{c}`") for c in df.columns],
                        "column_name", "missing")


def schema_report(df: DataFrame, with_missing: bool = False) -> DataFrame:
    """The schema as data: (position, column_name, data_type, nullable), one
    row per column; `with_missing` adds each column's missing count from a
    single pass over the rows (`null_profile_long`)."""
    spark = df.sparkSession
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable)
            for i, f in enumerate(df.schema.fields)]
    report = spark.createDataFrame(
        rows, "position int, column_name string, data_type string, nullable boolean")
    if with_missing:
        report = report.join(null_profile_long(df), "column_name", "left")
    return report
