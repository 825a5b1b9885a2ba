"""Accident-table preset: column groups and lookup values.

Every operator takes its columns/spec as arguments; these are the defaults
that reproduce the original medallion pipeline over the accident table.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values.  They must equal the original pipeline's for identical
# results; they are stated plainly, in their natural order.
# ---------------------------------------------------------------------------

# Unit conversions: source column -> (target column, conversion kind).
#   mi_to_km: x * 1.60934     f_to_c: (x - 32) * 5.0 / 9.0     in_to_cm: x * 2.54
# Each converted value is rounded to 2 decimals; the source is dropped.
UNIT_CONVERSIONS = {
    "Distance(mi)": ("Distance_km", "mi_to_km"),
    "Temperature(F)": ("Temperature(C)", "f_to_c"),
    "Wind_Chill(F)": ("Wind_Chill(C)", "f_to_c"),
    "Visibility(mi)": ("Visibility_km", "mi_to_km"),
    "Wind_Speed(mph)": ("Wind_Speed_kmh", "mi_to_km"),
    "Precipitation(in)": ("Precipitation(cm)", "in_to_cm"),
}
MILE_KM = 1.60934
INCH_CM = 2.54
UNIT_DECIMALS = 2

# Durations in minutes: output -> (start column, end column).
DURATIONS = {
    "duration_minutes_accident": ("Start_Time", "End_Time"),
    "duration_minutes_record_weather": ("Start_Time", "Weather_Timestamp"),
}
TIME_COLUMNS = ["Start_Time", "End_Time", "Weather_Timestamp"]

# Wind direction text (after upper + trim) that is rewritten.
WIND_UNKNOWN = ["CALM", "VARIABLE", "VAR", "NULL"]
WIND_UNKNOWN_LABEL = "UNKNOWN"
WIND_WORDS = {"EAST": "E", "WEST": "W", "NORTH": "N", "SOUTH": "S"}
# The 16 compass points, clockwise from north; point i lies at i * 22.5 deg.
COMPASS_POINTS = ["N", "NNE", "NE", "ENE", "E", "ESE", "SE", "SSE",
                  "S", "SSW", "SW", "WSW", "W", "WNW", "NW", "NNW"]
COMPASS_STEP_DEG = 22.5

# Road-infrastructure flags: True -> 1, False or null -> 0, suffix "_num".
BOOL_FLAGS = ["Amenity", "Bump", "Crossing", "Give_Way", "Junction", "No_Exit",
              "Railway", "Roundabout", "Station", "Stop", "Traffic_Calming",
              "Traffic_Signal", "Turning_Loop"]
# Day/night columns: day/Day -> 1, night/Night -> 0, anything else -> -1.
DAYNIGHT_COLUMNS = ["Sunrise_Sunset", "Civil_Twilight", "Nautical_Twilight",
                    "Astronomical_Twilight"]
DAY_VALUES = ["day", "Day"]
NIGHT_VALUES = ["night", "Night"]
FLAG_SUFFIX = "_num"

# Categorical columns: nulls become "UNKNOWN", then frequency indexing.
CATEGORICAL_FILL = {"Timezone": "UNKNOWN", "State": "UNKNOWN",
                    "Weather_Condition": "UNKNOWN"}
INDEX_COLUMNS = ["Timezone", "State", "Weather_Condition"]
INDEX_SUFFIX = "_index"

# Imputation lists (each imputed column is rounded to 2 decimals afterwards).
IMPUTE_MEAN = ["Temperature(C)", "Humidity(%)", "Pressure(in)", "Wind_Speed_kmh",
               "Visibility_km"]
IMPUTE_ZERO = ["Precipitation(cm)", "duration_minutes_record_weather"]
IMPUTE_MEDIAN = ["Wind_Chill(C)"]

# Columns dropped on the way to the ML table (after indexing, before flags).
ML_DROP_TEXT = ["Description", "situation_date", "Airport_Code", "Source", "Street",
                "City", "Country", "County", "Wind_Direction", "wind_angle",
                "Wind_Direction_clean"]
# ... and after flag encoding.
ML_DROP_GEO = ["Start_Lat", "Start_Lng", "End_Lat", "End_Lng", "Start_Time",
               "End_Time", "Zipcode"]
# Columns dropped on the way to the join table.
JOIN_DROP = ["situation_date", "Source", "Country", "Wind_Direction", "wind_angle",
             "County", "wind_dir_sin", "wind_dir_cos"]

# Rows of the join table must have all four twilight columns.
TWILIGHT_REQUIRED = DAYNIGHT_COLUMNS
# Blank-or-null text replacements in the join table.
DEFAULT_TEXT = [
    (["Zipcode", "Timezone", "Airport_Code", "Street", "City"], "Other"),
    (["Description"], "No_description"),
    (["Weather_Condition"], "Other"),
]

# ML.
LABEL = "Severity"
PREDICTION_CLASS = "prediction_classe"
RF_NUM_TREES = 50
RF_MAX_BINS = 400
TRAIN_TEST_WEIGHTS = [0.8, 0.2]
SPLIT_SEED = 42

# Gold marts.
KEY = "ID"
INFRA_FLAGS = ["Amenity", "Bump", "Railway", "Stop", "Junction", "Traffic_Signal"]

# Delivery dates used to simulate daily batches.
DELIVERY_DATES = ["2025-06-15", "2025-06-16", "2025-06-17"]
DELIVERY_WEIGHTS = [0.33, 0.33, 0.34]
BATCH_COLUMN = "batch_date"
BATCH_DIR_PATTERN = r"^\d{4}_\d{2}_\d{2}$"

# ---------------------------------------------------------------------------
# Raw accident schema (46 columns), used for schema-on-read of CSV input.
# ---------------------------------------------------------------------------
_S, _D, _I, _B, _TS = (T.StringType(), T.DoubleType(), T.IntegerType(),
                       T.BooleanType(), T.TimestampType())

ACC_SCHEMA = T.StructType([
    T.StructField("ID", _S), T.StructField("Source", _S), T.StructField("Severity", _I),
    T.StructField("Start_Time", _TS), T.StructField("End_Time", _TS),
    T.StructField("Weather_Timestamp", _TS),
    T.StructField("Start_Lat", _D), T.StructField("Start_Lng", _D),
    T.StructField("End_Lat", _D), T.StructField("End_Lng", _D),
    T.StructField("Distance(mi)", _D), T.StructField("Description", _S),
    T.StructField("Street", _S), T.StructField("City", _S), T.StructField("County", _S),
    T.StructField("State", _S), T.StructField("Zipcode", _S), T.StructField("Country", _S),
    T.StructField("Timezone", _S), T.StructField("Airport_Code", _S),
    T.StructField("Temperature(F)", _D), T.StructField("Wind_Chill(F)", _D),
    T.StructField("Humidity(%)", _D), T.StructField("Pressure(in)", _D),
    T.StructField("Visibility(mi)", _D), T.StructField("Wind_Direction", _S),
    T.StructField("Wind_Speed(mph)", _D), T.StructField("Precipitation(in)", _D),
    T.StructField("Weather_Condition", _S),
    *[T.StructField(c, _B) for c in BOOL_FLAGS],
    *[T.StructField(c, _S) for c in DAYNIGHT_COLUMNS],
])
