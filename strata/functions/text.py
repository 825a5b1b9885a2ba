"""Text defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata import presets as P


def blank_to(c: Column, value: str) -> Column:
    """Null or empty string -> `value`; whitespace-only text is kept."""
    return F.when(c.isNull() | (c == F.lit("")), F.lit(value)).otherwise(c)


def default_text(df: DataFrame, rules: list | None = None) -> DataFrame:
    """Apply `[(columns, default), ...]` in one projection; absent columns skipped."""
    rules = P.DEFAULT_TEXT if rules is None else rules
    added = {}
    for cols, value in rules:
        for c in cols:
            if c in df.columns:
                added[c] = blank_to(F.col(c), value)
    return df.withColumns(added) if added else df
