"""Ingestion dataflow: split into deliveries, stamp, repartition, audit."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata import presets as P
from strata.sources.batches import path_exists


HASH_RANGE = 1 << 28  # the first 7 hex digits of an md5


def hash_value(key: str, row: list[str] | None = None) -> Column:
    """Stable value in [0, 2^28) from md5 of the key's text.

    It depends only on the key, never on partitioning or task order, so a
    re-run (or a lost executor's retried task) gives every row the same value.
    Rows without a key take their value from the columns of `row`, so they
    spread over all parts like any others; without `row` they share one value.
    """
    text = F.col(f"`{key}`").cast("string")
    other = F.to_json(F.struct(*[F.col(f"`{c}`") for c in row])) if row else F.lit("")
    digest = F.substring(F.md5(F.coalesce(text, other)), 1, 7)
    return F.conv(digest, 16, 10).cast("bigint")


def _cut_points(weights: list[float]) -> list[int]:
    """Upper ends of the parts; the last part takes what rounding leaves."""
    total = float(sum(weights))
    return [round(HASH_RANGE * w / total) for w in accumulate(weights)][:-1] + [HASH_RANGE]


def split_label(key: str, weights: list[float], labels: list, row: list[str] | None = None) -> Column:
    """Label of the weighted hash split a row falls into; never null."""
    v = hash_value(key, row)
    expr = F
    for cut, label in list(zip(_cut_points(weights), labels))[:-1]:
        expr = expr.when(v < cut, F.lit(label))
    return F.lit(labels[-1]) if expr is F else expr.otherwise(F.lit(labels[-1]))


def split_hash(df: DataFrame, key: str, weights: list[float]) -> list[DataFrame]:
    """Disjoint, exhaustive weighted split by key hash; stable across runs."""
    v = hash_value(key, df.columns)
    cuts = [0, *_cut_points(weights)]
    return [df.filter((v >= lo) & (v < hi)) for lo, hi in zip(cuts, cuts[1:])]


def split_random(df: DataFrame, weights: list[float], seed: int = P.SPLIT_SEED) -> list[DataFrame]:
    """Spark's seeded `randomSplit` (disjoint and exhaustive for a fixed input)."""
    return df.randomSplit(weights, seed)


def stamp(df: DataFrame, value: str, col: str = P.BATCH_COLUMN) -> DataFrame:
    """Set `col` to the literal string `value` (replacing it if present)."""
    return df.withColumn(col, F.lit(value))


def date_dir(date: str) -> str:
    """Directory form of a batch date: 2025-06-15 -> 2025_06_15."""
    return date.replace("-", "_")


def assign_deliveries(df: DataFrame, key: str, dates: list[str] | None = None,
                      weights: list[float] | None = None,
                      col: str = P.BATCH_COLUMN) -> DataFrame:
    """Give each row the delivery date of its hash-split part (one pass)."""
    dates = P.DELIVERY_DATES if dates is None else dates
    weights = P.DELIVERY_WEIGHTS if weights is None else weights
    return df.withColumn(col, split_label(key, weights, [date_dir(d) for d in dates], df.columns))


def repartition_by_key(df: DataFrame, n: int | None = None, key: str | None = None,
                       balanced: bool = True) -> DataFrame:
    """Cluster rows by `key` when present, else spread them; rows unchanged.

    `balanced=True` uses the REBALANCE hint: rows stay clustered by key, but
    AQE sizes the output partitions from the shuffle statistics and splits a
    partition holding a hot key (one key with a third of the rows would
    otherwise become one huge task and file); `n` is the count it starts from.
    `balanced=False` is a plain hash repartition into exactly `n` partitions.
    """
    has_key = bool(key) and key in df.columns
    if balanced:
        return df.hint("rebalance", *([n] if n else []), *([F.col(key)] if has_key else []))
    if has_key:
        return df.repartition(n, key) if n else df.repartition(key)
    return df.repartition(n) if n else df


def row_audit(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Attach a row counter computed in the same pass as the next action.

    The returned `Observation` is filled when an action on the returned frame
    finishes; no second scan (`count()`) is needed.
    """
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def committed_rows(spark: SparkSession, path: str) -> int:
    """Rows of the committed parquet files under `path` (0 when there are none),
    from their footers.  Unlike a counter that runs with the write, this cannot
    count a task or stage twice that was run again."""
    if not path_exists(spark, path):
        return 0
    return spark.read.schema("none int").parquet(path).agg(F.count(F.lit(1))).first()[0]


def audited_write(df: DataFrame, path: str, write=None) -> dict:
    """Write `df` and audit it: {"observed", "committed", "equal"}.

    `observed` counts rows as they are written, `committed` those in the files;
    the committed count is the one to report.  They differ when work was run
    again after a lost executor, and when the write dropped or doubled rows.
    """
    counted, obs = row_audit(df)
    write = write or (lambda frame: frame.write.mode("overwrite").parquet(path))
    write(counted)
    observed, committed = obs.get.get("rows", 0), committed_rows(df.sparkSession, path)
    return {"observed": observed, "committed": committed, "equal": observed == committed}
