"""Scalar transforms: the unit-test rows of the fixture spec."""

import math

from pyspark.sql import functions as F

from strata import presets as P
from strata.functions import (add_durations, bool_to_int, clean_wind, convert_units,
                              daynight_to_int, default_text)
from tests.conftest import rows


def test_unit_conversions_golden_row(spark):
    df = spark.createDataFrame([(78.0, 10.0, 7.0, 0.0, 1.0, 78.0)],
                               "`Temperature(F)` double, `Visibility(mi)` double, "
                               "`Wind_Speed(mph)` double, `Precipitation(in)` double, "
                               "`Distance(mi)` double, `Wind_Chill(F)` double")
    out = convert_units(df)
    assert rows(out, "Temperature(C)", "Visibility_km", "Wind_Speed_kmh", "Precipitation(cm)",
                "Distance_km", "Wind_Chill(C)") == [(25.56, 16.09, 11.27, 0.0, 1.61, 25.56)]
    assert not set(P.UNIT_CONVERSIONS) & set(out.columns)


def test_unit_conversion_skips_absent_and_keeps_nulls(spark):
    df = spark.createDataFrame([(None, 5.0)], "`Temperature(F)` double, `Humidity(%)` double")
    out = convert_units(df)
    assert sorted(out.columns) == ["Humidity(%)", "Temperature(C)"]
    assert rows(out, "Temperature(C)", "Humidity(%)") == [(None, 5.0)]


def test_round_half_up_on_decimal_text(spark):
    df = spark.createDataFrame([(0.285,), (1.005,), (-0.285,)], "x double")
    assert [r[0] for r in df.select(F.round("x", 2)).collect()] == [0.29, 1.01, -0.29]


def test_durations_negative_lag_and_null(spark):
    df = spark.sql("""
      SELECT TIMESTAMP_NTZ'2024-01-01 10:00:00' AS Start_Time,
             TIMESTAMP_NTZ'2024-01-01 10:45:00' AS End_Time,
             TIMESTAMP_NTZ'2024-01-01 09:37:40' AS Weather_Timestamp
      UNION ALL
      SELECT TIMESTAMP_NTZ'2024-01-01 10:00:00.900', TIMESTAMP_NTZ'2024-01-01 10:00:30.100', NULL""")
    out = add_durations(df)
    assert set(out.columns) == {"duration_minutes_accident", "duration_minutes_record_weather"}
    got = sorted(rows(out, "duration_minutes_accident", "duration_minutes_record_weather"),
                 key=lambda r: r[0])
    # whole seconds: 10:00:30 - 10:00:00 = 30 s = 0.5 min
    assert got == [(0.5, None), (45.0, -22.33)]


def test_wind_cases(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(
        [" west ", "VAR", "Calm", "NULL", "NNW", "XX", None, "east", "Variable"])],
        "i int, Wind_Direction string")
    out = clean_wind(df).orderBy("i")
    got = rows(out, "Wind_Direction_clean", "wind_angle", "wind_dir_sin", "wind_dir_cos")
    clean = [g[0] for g in got]
    assert clean == ["W", "UNKNOWN", "UNKNOWN", "UNKNOWN", "NNW", "XX", None, "E", "UNKNOWN"]
    angles = [g[1] for g in got]
    assert angles == [270.0, None, None, None, 337.5, None, None, 90.0, None]
    for (_, angle, s, c) in got:
        if angle is None:
            assert (s, c) == (0.0, 0.0)
        else:
            assert math.isclose(s, math.sin(math.radians(angle)), abs_tol=1e-12)
            assert math.isclose(c, math.cos(math.radians(angle)), abs_tol=1e-12)


def test_all_compass_points(spark):
    df = spark.createDataFrame([(p,) for p in P.COMPASS_POINTS], "Wind_Direction string")
    got = dict(rows(clean_wind(df), "Wind_Direction_clean", "wind_angle"))
    assert got == {p: i * 22.5 for i, p in enumerate(P.COMPASS_POINTS)}


def test_bool_flags(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "i int, Amenity boolean")
    out = bool_to_int(df, ["Amenity"]).orderBy("i")
    assert "Amenity" not in out.columns
    assert [r[0] for r in rows(out, "Amenity_num")] == [1, 0, 0]


def test_daynight_flags(spark):
    vals = ["Day", "day", "Night", "DAY", None, "night"]
    df = spark.createDataFrame(list(enumerate(vals)), "i int, Sunrise_Sunset string")
    out = daynight_to_int(df, ["Sunrise_Sunset"]).orderBy("i")
    assert [r[0] for r in rows(out, "Sunrise_Sunset_num")] == [1, 1, 0, -1, -1, 0]


def test_blank_defaults(spark):
    df = spark.createDataFrame([(1, None, None), (2, "", ""), (3, " ", "x")],
                               "i int, City string, Description string")
    out = default_text(df).orderBy("i")
    assert rows(out, "City", "Description") == [("Other", "No_description"),
                                                ("Other", "No_description"), (" ", "x")]
