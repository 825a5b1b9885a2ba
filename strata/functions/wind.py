"""Wind direction: text canonicalisation, compass angle, cyclic encoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata import presets as P


def canonical_direction(c: Column) -> Column:
    """upper(trim(x)); calm/variable spellings -> UNKNOWN; words -> letters.

    A SQL null stays null (it matches no branch and falls to `otherwise`).
    """
    norm = F.upper(F.trim(c))
    out = F.when(norm.isin(*P.WIND_UNKNOWN), F.lit(P.WIND_UNKNOWN_LABEL))
    for word, letter in P.WIND_WORDS.items():
        out = out.when(norm == word, F.lit(letter))
    return out.otherwise(norm)


def compass_angle(c: Column) -> Column:
    """Angle in degrees of a 16-point compass label; anything else -> null."""
    out = None
    for i, point in enumerate(P.COMPASS_POINTS):
        angle = F.lit(i * P.COMPASS_STEP_DEG)
        out = F.when(c == point, angle) if out is None else out.when(c == point, angle)
    return out.otherwise(F.lit(None).cast("double"))


def clean_wind(df: DataFrame, source: str = "Wind_Direction",
               clean: str = "Wind_Direction_clean", angle: str = "wind_angle",
               sin_col: str = "wind_dir_sin", cos_col: str = "wind_dir_cos") -> DataFrame:
    """Add the clean label, its angle and (sin, cos); unknown angle -> (0, 0)."""
    df = df.withColumn(clean, canonical_direction(F.col(source)))
    df = df.withColumn(angle, compass_angle(F.col(clean)))
    rad = F.radians(F.col(angle))
    return df.withColumns({
        sin_col: F.coalesce(F.sin(rad), F.lit(0.0)),
        cos_col: F.coalesce(F.cos(rad), F.lit(0.0)),
    })
