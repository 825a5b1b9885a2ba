"""Gold marts.

Every mart is a hash aggregate: Spark aggregates partially inside each scan
task and shuffles at most one row per group per task, so a group holding a
third of all rows costs no more shuffle than any other.  Filters are
expressed before the aggregate so they reach the parquet scan.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata import presets as P

log = logging.getLogger(__name__)

_FUNCS = {
    "count": lambda c: F.count(F.lit(1)) if c in (None, "*") else F.count(F.col(c)),
    "avg": lambda c: F.avg(F.col(c)),
    "sum": lambda c: F.sum(F.col(c)),
    "min": lambda c: F.min(F.col(c)),
    "max": lambda c: F.max(F.col(c)),
}


def build_mart(df: DataFrame, keys: list[str], measures: dict,
               where: Column | None = None) -> DataFrame:
    """Generic mart: `measures = {alias: (fn, column)}`, fn in count/avg/sum/min/max.

    Null keys form their own group, as in SQL GROUP BY.
    """
    if where is not None:
        df = df.filter(where)
    aggs = [_FUNCS[fn](c).alias(alias) for alias, (fn, c) in measures.items()]
    return df.groupBy(*keys).agg(*aggs)


# Mart specifications; names and aliases are the published ones.
CITY_MART = (["City", "State"], {
    "total_accidents": ("count", "*"),
    "avg_severity": ("avg", "Severity"),
    "avg_distance": ("avg", "Distance_km"),
    "avg_duration": ("avg", "duration_minutes_accident"),
})
WEATHER_MART = (["Weather_Condition"], {
    "total_accidents": ("count", "*"),
    "avg_severity": ("avg", "Severity"),
    "avg_temp": ("avg", "Temperature(C)"),
    "avg_precip": ("avg", "Precipitation(cm)"),
    "avg_visibility": ("avg", "Visibility_km"),
})
SEVERE_WEATHER_MART = (["Weather_Condition"], {
    "nb_grave_accidents": ("count", "*"),
    "avg_temp": ("avg", "Temperature(C)"),
    "avg_wind": ("avg", "Wind_Speed_kmh"),
    "avg_humidity": ("avg", "Humidity(%)"),
})
SEVERE_LEVEL = 4


def mart_city(df: DataFrame) -> DataFrame:
    return build_mart(df, *CITY_MART)


def mart_weather(df: DataFrame) -> DataFrame:
    return build_mart(df, *WEATHER_MART)


def mart_severe_weather(df: DataFrame, level: int = SEVERE_LEVEL) -> DataFrame:
    return build_mart(df, *SEVERE_WEATHER_MART, where=F.col(P.LABEL) == level)


def mart_infrastructure(df: DataFrame, flags: list[str] | None = None,
                        label: str = P.LABEL) -> DataFrame:
    """Per flag: accidents where the flag is true, their mean severity.

    One scan and one global aggregate with a conditional count and average
    per flag, then unpivoted to one row per flag.  A row may count under
    several flags; a flag never true still yields a row (0, null).
    """
    flags = [f for f in (P.INFRA_FLAGS if flags is None else flags) if f in df.columns]
    aggs = []
    for f in flags:
        hit = F.col(f) == F.lit(True)
        aggs.append(F.count(F.when(hit, F.lit(1))).alias(f"n::{f}"))
        aggs.append(F.avg(F.when(hit, F.col(label))).alias(f"avg::{f}"))
    wide = df.agg(*aggs)
    per_flag = F.array(*[
        F.struct(F.col(f"`n::{f}`").alias("total_accidents"),
                 F.col(f"`avg::{f}`").alias("avg_severity"),
                 F.lit(f).alias("infrastructure"))
        for f in flags])
    return wide.select(F.inline(per_flag))


# Published names of the marts and of the full copy.
MARTS = {
    "dm_accidents_by_city": mart_city,
    "dm_weather_accidents": mart_weather,
    "dm_accidents_by_infra": mart_infrastructure,
    "dm_grave_accidents_weather": mart_severe_weather,
}


FULL_COPY = "gold_final_accidents"


def build_all(df: DataFrame, publish=None, marts: dict | None = None,
              full_copy: str | None = None) -> list[tuple]:
    """Build (and optionally publish) every mart; one failing mart is logged
    and the others still run.  Returns `(mart, status, error)` tuples.

    `publish(name, frame)` performs the write (parquet, table or JDBC).
    `full_copy` also publishes `df` itself under that name; unlike a mart,
    its failure is raised (the serving layer depends on it).
    """
    marts = MARTS if marts is None else marts
    report = []
    if full_copy and publish is None:
        raise ValueError("full_copy needs a publisher")
    for name, fn in marts.items():
        try:
            out = fn(df)
            if publish is not None:
                publish(name, out)
            report.append((name, "ok", None))
        except Exception as exc:  # noqa: BLE001 - reported per mart, run continues
            log.error("mart %s failed: %s", name, exc)
            report.append((name, "failed", str(exc)[:500]))
    if full_copy:
        publish(full_copy, df)
        report.append((full_copy, "ok", None))
    return report
