"""Projection helpers: tolerant drop, type-driven column choice, guards."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import types as T

log = logging.getLogger(__name__)


def drop_tolerant(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop the listed columns that exist; absent names are reported, not fatal."""
    unknown = set(cols).difference(df.columns)
    if unknown:
        log.info("nothing to drop for: %s", sorted(unknown))
    return df.drop(*cols)  # Spark passes over names it does not know


def numeric_columns(df: DataFrame, exclude: list[str] | tuple = ()) -> list[str]:
    """Names of numeric columns in schema order, minus `exclude`."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def require_columns(df: DataFrame, cols: list[str], what: str = "input") -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks required column(s): {', '.join(missing)}")
