"""Column-level transforms: every function here stays in JVM expressions."""

from strata.functions.flags import bool_as_int, bool_to_int, daynight_as_int, daynight_to_int, encode_flags
from strata.functions.text import blank_to, default_text
from strata.functions.units import add_durations, convert_all, convert_units, minutes_between
from strata.functions.wind import canonical_direction, clean_wind, compass_angle

__all__ = [
    "add_durations", "blank_to", "bool_as_int", "bool_to_int", "canonical_direction",
    "clean_wind", "compass_angle", "convert_all", "convert_units", "daynight_as_int",
    "daynight_to_int", "default_text", "encode_flags", "minutes_between",
]
