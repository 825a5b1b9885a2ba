"""Marts kept incrementally: mergeable states per batch date.

    <root>/<mart>/batch_date=<date>/

A state is a mart's groups over the rows of one date, with what merges: counts,
sums with their counts, least and greatest values.  A new or replaced date costs
its own rows; reading a mart merges states, one row per group and date, never
data rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import presets as P
from strata.operators import marts
from strata.sources.batches import list_dates
from strata.sources.sinks import write_partitioned


def _states(fn: str, column: str | None) -> dict[str, Column]:
    """What a measure keeps per date."""
    value = None if column in (None, "*") else F.col(f"`{column}`")
    if fn == "count":
        return {"n": F.count(F.lit(1)) if value is None else F.count(value)}
    if fn == "avg":
        return {"sum": F.sum(value.cast("double")), "n": F.count(value)}
    return {fn: marts._FUNCS[fn](column)}


def _merged(fn: str, alias: str) -> Column:
    part = lambda s: F.col(f"`{alias}::{s}`")
    if fn == "count":
        return F.sum(part("n"))
    if fn == "avg":  # null when no date has a value
        n = F.sum(part("n"))
        return F.when(n > 0, F.sum(part("sum")) / n)
    return {"sum": F.sum, "min": F.min, "max": F.max}[fn](part(fn))


def _infra_rows(df: DataFrame, flags: list[str], col: str, label: str) -> DataFrame:
    """The infrastructure states: one conditional aggregate per date, unpivoted."""
    aggs = []
    for f in flags:
        hit = F.when(F.col(f) == F.lit(True), F.col(label))
        aggs += [F.count_if(F.col(f) == F.lit(True)).alias(f"a::{f}"), F.sum(hit.cast("double")).alias(f"s::{f}"),
                 F.count(hit).alias(f"n::{f}")]
    per_flag = F.array(*[F.struct(
        F.lit(f).alias("infrastructure"), F.col(f"`a::{f}`").alias("total_accidents::n"),
        F.col(f"`s::{f}`").alias("avg_severity::sum"), F.col(f"`n::{f}`").alias("avg_severity::n")) for f in flags])
    return df.groupBy(col).agg(*aggs).select(col, F.inline(per_flag))


class PartialMarts:
    """The published marts as states under `root`."""

    SPECS = {
        "dm_accidents_by_city": (*marts.CITY_MART, None),
        "dm_weather_accidents": (*marts.WEATHER_MART, None),
        "dm_accidents_by_infra": (["infrastructure"], {"total_accidents": ("count", "*"),
                                                       "avg_severity": ("avg", P.LABEL)}, None),
        "dm_grave_accidents_weather": (*marts.SEVERE_WEATHER_MART, marts.SEVERE_LEVEL),
    }
    INFRA = "dm_accidents_by_infra"

    def __init__(self, spark: SparkSession, root: str, col: str = P.BATCH_COLUMN) -> None:
        self._spark, self._root, self._col = spark, root.rstrip("/"), col

    def _state(self, name: str, df: DataFrame) -> DataFrame:
        keys, measures, level = self.SPECS[name]
        if name == self.INFRA:
            return _infra_rows(df, [f for f in P.INFRA_FLAGS if f in df.columns], self._col, P.LABEL)
        if level is not None:
            df = df.filter(F.col(P.LABEL) == level)
        aggs = [e.alias(f"{alias}::{s}") for alias, (fn, c) in measures.items() for s, e in _states(fn, c).items()]
        return df.groupBy(self._col, *[F.col(f"`{k}`") for k in keys]).agg(*aggs)

    def update(self, gold: DataFrame, dates: list[str]) -> None:
        """Write the states of `dates` from `gold` (which has the batch column;
        the filter prunes its partitions), replacing those they had.  A date
        whose rows are gone loses its states."""
        rows = gold.filter(F.col(self._col).isin(dates))
        for name in self.SPECS:
            path = f"{self._root}/{name}"
            state = self._state(name, rows)
            # a row per date that says it was seen, so a date left without groups is replaced too
            seen = self._spark.createDataFrame([(d,) for d in dates], f"{self._col} string")
            blank = seen.select(*[F.col(self._col) if f.name == self._col else F.lit(None).cast(f.dataType).alias(f.name)
                                  for f in state.schema.fields], F.lit(True).alias("blank"))
            write_partitioned(state.withColumn("blank", F.lit(False)).unionByName(blank), path, self._col)

    def dates(self, name: str = "dm_accidents_by_city") -> list[str]:
        return list_dates(self._spark, f"{self._root}/{name}", col=self._col)

    def mart(self, name: str, upto: str | None = None) -> DataFrame:
        """The mart over all dates (or those up to `upto`), from its states."""
        keys, measures, _ = self.SPECS[name]
        states = self._spark.read.parquet(f"{self._root}/{name}").filter(~F.col("blank"))
        if upto is not None:
            states = states.filter(F.col(self._col) <= upto)
        out = states.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(
            *[_merged(fn, alias).alias(alias) for alias, (fn, _) in measures.items()])
        return out.select(*measures, *keys) if name == self.INFRA else out
