"""Unit conversion and durations (silver scalar transforms)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata import presets as P


def _convert(kind: str, c: Column) -> Column:
    if kind == "mi_to_km":
        return c * P.MILE_KM
    if kind == "f_to_c":
        return (c - 32) * 5.0 / 9.0
    if kind == "in_to_cm":
        return c * P.INCH_CM
    raise ValueError(f"unknown conversion {kind!r}")


def convert_units(df: DataFrame, spec: dict | None = None,
                  decimals: int = P.UNIT_DECIMALS) -> DataFrame:
    """Add each converted, rounded target column and drop its source.

    Sources absent from `df` are skipped.  All targets are added in a single
    projection.  `F.round` rounds HALF_UP on the decimal text of the double.
    """
    spec = P.UNIT_CONVERSIONS if spec is None else spec
    present = {src: tgt for src, tgt in spec.items() if src in df.columns}
    if not present:
        return df
    added = {tgt: F.round(_convert(kind, F.col(src)), decimals)
             for src, (tgt, kind) in present.items()}
    return df.withColumns(added).drop(*present)


def minutes_between(start: str, end: str, decimals: int = 2) -> Column:
    """Whole-second difference end - start in minutes, rounded; may be negative."""
    return F.round((F.unix_timestamp(F.col(end)) - F.unix_timestamp(F.col(start))) / 60,
                   decimals)


def add_durations(df: DataFrame, spec: dict | None = None,
                  drop: list[str] | None = None) -> DataFrame:
    """Add duration columns `out = minutes(end - start)`, then drop the times."""
    spec = P.DURATIONS if spec is None else spec
    drop = P.TIME_COLUMNS if drop is None else drop
    added = {out: minutes_between(s, e) for out, (s, e) in spec.items()
             if s in df.columns and e in df.columns}
    return df.withColumns(added).drop(*drop)


def convert_all(df: DataFrame) -> DataFrame:
    """Unit conversions followed by durations, as the silver stage applies them."""
    return add_durations(convert_units(df))
