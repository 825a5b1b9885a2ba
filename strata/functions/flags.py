"""Boolean and day/night encodings to small integers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata import presets as P


def bool_as_int(c: Column) -> Column:
    """True -> 1; False and null -> 0."""
    return F.when(c == F.lit(True), F.lit(1)).otherwise(F.lit(0))


def daynight_as_int(c: Column, day=None, night=None) -> Column:
    """Day spellings -> 1, night spellings -> 0, anything else (null too) -> -1."""
    day = P.DAY_VALUES if day is None else day
    night = P.NIGHT_VALUES if night is None else night
    return (F.when(c.isin(*day), F.lit(1))
            .when(c.isin(*night), F.lit(0))
            .otherwise(F.lit(-1)))


def bool_to_int(df: DataFrame, cols: list[str] | None = None,
                suffix: str = P.FLAG_SUFFIX) -> DataFrame:
    cols = [c for c in (P.BOOL_FLAGS if cols is None else cols) if c in df.columns]
    return df.withColumns({c + suffix: bool_as_int(F.col(c)) for c in cols}).drop(*cols)


def daynight_to_int(df: DataFrame, cols: list[str] | None = None,
                    suffix: str = P.FLAG_SUFFIX) -> DataFrame:
    cols = [c for c in (P.DAYNIGHT_COLUMNS if cols is None else cols) if c in df.columns]
    return df.withColumns({c + suffix: daynight_as_int(F.col(c)) for c in cols}).drop(*cols)


def encode_flags(df: DataFrame) -> DataFrame:
    return daynight_to_int(bool_to_int(df))
