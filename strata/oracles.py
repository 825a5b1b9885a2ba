"""Independent DuckDB SQL for every SQL-expressible registered query.

The texts are written from the operator semantics, not generated from the
Spark plans.  Shared CTEs (`acc`, `conv`, `stats`, `sj`, `ml`) are composed
in Python so that each oracle stays one SQL statement.  Rounding rules:
`R2` mirrors Spark's HALF_UP round of a double (decimal text, then round),
`R6` is the comparison rounding applied to every double output.
"""

from __future__ import annotations

from itertools import accumulate

from strata.fixture import view_sql


class P:
    """Fixed values of the oracles, written out here: nothing is taken from the
    presets or operators under test."""

    UNIT_CONVERSIONS = {
        "Distance(mi)": ("Distance_km", "mi_to_km"), "Temperature(F)": ("Temperature(C)", "f_to_c"),
        "Wind_Chill(F)": ("Wind_Chill(C)", "f_to_c"), "Visibility(mi)": ("Visibility_km", "mi_to_km"),
        "Wind_Speed(mph)": ("Wind_Speed_kmh", "mi_to_km"), "Precipitation(in)": ("Precipitation(cm)", "in_to_cm"),
    }
    DURATIONS = {
        "duration_minutes_accident": ("Start_Time", "End_Time"),
        "duration_minutes_record_weather": ("Start_Time", "Weather_Timestamp"),
    }
    TIME_COLUMNS = ["Start_Time", "End_Time", "Weather_Timestamp"]
    COMPASS = {"N": 0.0, "NNE": 22.5, "NE": 45.0, "ENE": 67.5, "E": 90.0, "ESE": 112.5, "SE": 135.0, "SSE": 157.5,
               "S": 180.0, "SSW": 202.5, "SW": 225.0, "WSW": 247.5, "W": 270.0, "WNW": 292.5, "NW": 315.0,
               "NNW": 337.5}
    BOOL_FLAGS = ["Amenity", "Bump", "Crossing", "Give_Way", "Junction", "No_Exit", "Railway", "Roundabout",
                  "Station", "Stop", "Traffic_Calming", "Traffic_Signal", "Turning_Loop"]
    DAYNIGHT_COLUMNS = ["Sunrise_Sunset", "Civil_Twilight", "Nautical_Twilight", "Astronomical_Twilight"]
    FLAG_SUFFIX = "_num"
    CATEGORICAL_FILL = {"Timezone": "UNKNOWN", "State": "UNKNOWN", "Weather_Condition": "UNKNOWN"}
    INDEX_COLUMNS = ["Timezone", "State", "Weather_Condition"]
    INDEX_SUFFIX = "_index"
    IMPUTE_MEAN = ["Temperature(C)", "Humidity(%)", "Pressure(in)", "Wind_Speed_kmh", "Visibility_km"]
    IMPUTE_ZERO = ["Precipitation(cm)", "duration_minutes_record_weather"]
    IMPUTE_MEDIAN = ["Wind_Chill(C)"]
    ML_DROP_TEXT = ["Description", "situation_date", "Airport_Code", "Source", "Street", "City", "Country",
                    "County", "Wind_Direction", "wind_angle", "Wind_Direction_clean"]
    ML_DROP_GEO = ["Start_Lat", "Start_Lng", "End_Lat", "End_Lng", "Start_Time", "End_Time", "Zipcode"]
    JOIN_DROP = ["situation_date", "Source", "Country", "Wind_Direction", "wind_angle", "County",
                 "wind_dir_sin", "wind_dir_cos"]
    TWILIGHT_REQUIRED = ["Sunrise_Sunset", "Civil_Twilight", "Nautical_Twilight", "Astronomical_Twilight"]
    DEFAULT_TEXT = [(["Zipcode", "Timezone", "Airport_Code", "Street", "City"], "Other"),
                    (["Description"], "No_description"), (["Weather_Condition"], "Other")]
    INFRA_FLAGS = ["Amenity", "Bump", "Railway", "Stop", "Junction", "Traffic_Signal"]
    DELIVERY_DATES = ["2025-06-15", "2025-06-16", "2025-06-17"]
    DELIVERY_WEIGHTS = [0.33, 0.33, 0.34]
    LATE_DATES = ["2025-06-15", "2025-06-16", "2025-06-17", "2025-06-14"]
    LATE_WEIGHTS = [0.3, 0.3, 0.3, 0.1]
    DROPPED = ["Description", "Street", "Country", "County", "Zipcode"]
    CITY_MART = (["City", "State"], {
        "total_accidents": ("count", "*"), "avg_severity": ("avg", "Severity"),
        "avg_distance": ("avg", "Distance_km"), "avg_duration": ("avg", "duration_minutes_accident")})
    WEATHER_MART = (["Weather_Condition"], {
        "total_accidents": ("count", "*"), "avg_severity": ("avg", "Severity"), "avg_temp": ("avg", "Temperature(C)"),
        "avg_precip": ("avg", "Precipitation(cm)"), "avg_visibility": ("avg", "Visibility_km")})
    SEVERE_WEATHER_MART = (["Weather_Condition"], {
        "nb_grave_accidents": ("count", "*"), "avg_temp": ("avg", "Temperature(C)"),
        "avg_wind": ("avg", "Wind_Speed_kmh"), "avg_humidity": ("avg", "Humidity(%)")})
    TIMEZONE_MART = (["Timezone"], {
        "accidents": ("count", "*"), "avg_wind_chill": ("avg", "Wind_Chill(C)"), "max_visibility": ("max", "Visibility_km"),
        "min_pressure": ("min", "Pressure(in)"), "total_precip": ("sum", "Precipitation(cm)")})
    ACC_TEXTS = ["ID", "Source", "Description", "Street", "City", "County", "State", "Zipcode", "Country", "Timezone",
                 "Airport_Code", "Wind_Direction", "Weather_Condition", *DAYNIGHT_COLUMNS]
    ACC_DOUBLES = ["Start_Lat", "Start_Lng", "End_Lat", "End_Lng", "Distance(mi)", "Temperature(F)", "Wind_Chill(F)",
                   "Humidity(%)", "Pressure(in)", "Visibility(mi)", "Wind_Speed(mph)", "Precipitation(in)"]
    TREES = 50


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def R2(expr: str) -> str:
    return f"round(CAST({expr} AS DECIMAL(30,12)), 2)::DOUBLE"


def R6(expr: str) -> str:
    return f"round(CAST({expr} AS DECIMAL(38,12)), 6)::DOUBLE"


def R12(expr: str) -> str:
    return f"round(CAST({expr} AS DECIMAL(38,16)), 12)::DOUBLE"


def md5_value(key: str) -> str:
    """A value below 2^28."""
    return f"('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 7))::BIGINT"


def cuts(weights: list[float]) -> list[int]:
    return [round(268435456 * w / sum(weights)) for w in accumulate(weights)]


ACC = f"acc AS ({view_sql('duckdb')})"

_CONV_FORMULA = {
    "mi_to_km": "({x} * 1.60934E0)",
    "f_to_c": "((({x} - 32) * 5.0E0) / 9.0E0)",
    "in_to_cm": "({x} * 2.54E0)",
}


def _conversions() -> list[str]:
    out = []
    for src, (tgt, kind) in P.UNIT_CONVERSIONS.items():
        out.append(f"{R2(_CONV_FORMULA[kind].format(x=q(src)))} AS {q(tgt)}")
    return out


def _duration(start: str, end: str) -> str:
    return R2(f"(floor(epoch({q(end)})) - floor(epoch({q(start)}))) / 60.0E0")


WIND_NORM = 'upper(trim("Wind_Direction"))'
WIND_CLEAN = (f"CASE WHEN {WIND_NORM} IN ('CALM', 'VARIABLE', 'VAR', 'NULL') THEN 'UNKNOWN' "
              f"WHEN {WIND_NORM} = 'EAST' THEN 'E' WHEN {WIND_NORM} = 'WEST' THEN 'W' "
              f"WHEN {WIND_NORM} = 'NORTH' THEN 'N' WHEN {WIND_NORM} = 'SOUTH' THEN 'S' "
              f"ELSE {WIND_NORM} END")
WIND_ANGLE = ("CASE \"Wind_Direction_clean\" " + " ".join(
    f"WHEN '{p}' THEN {a}E0" for p, a in P.COMPASS.items())
    + " ELSE NULL END")

_RAW_CONVERTED = [*P.UNIT_CONVERSIONS, *P.TIME_COLUMNS]

# conv0: units + durations; conv: + wind columns (the shared silver prefix)
CONV = (
    "conv0 AS (SELECT * EXCLUDE (" + ", ".join(q(c) for c in _RAW_CONVERTED) + "), "
    + ", ".join(_conversions()) + ", "
    + ", ".join(f"{_duration(s, e)} AS {q(o)}" for o, (s, e) in P.DURATIONS.items())
    + " FROM acc),\n"
    f"conv1 AS (SELECT *, {WIND_CLEAN} AS \"Wind_Direction_clean\" FROM conv0),\n"
    f"conv2 AS (SELECT *, {WIND_ANGLE} AS \"wind_angle\" FROM conv1),\n"
    "conv AS (SELECT *, coalesce(sin(radians(\"wind_angle\")), 0.0E0) AS \"wind_dir_sin\", "
    "coalesce(cos(radians(\"wind_angle\")), 0.0E0) AS \"wind_dir_cos\" FROM conv2)"
)

STATS = ("stats AS (SELECT "
         + ", ".join(f"avg({q(c)}) AS {q('mean_' + c)}" for c in P.IMPUTE_MEAN) + ", "
         + ", ".join(f"quantile_disc({q(c)}, 0.5) AS {q('median_' + c)}"
                     for c in P.IMPUTE_MEDIAN)
         + " FROM conv)")


def _imputed_exprs(mean=P.IMPUTE_MEAN, zero=P.IMPUTE_ZERO, median=P.IMPUTE_MEDIAN) -> list[str]:
    out = []
    for c in mean:
        out.append(f"{R2('coalesce(' + q(c) + ', s.' + q('mean_' + c) + ')')} AS {q(c)}")
    for c in zero:
        out.append(f"{R2('coalesce(' + q(c) + ', 0.0E0)')} AS {q(c)}")
    for c in median:
        out.append(f"{R2('coalesce(' + q(c) + ', s.' + q('median_' + c) + ')')} AS {q(c)}")
    return out


_IMPUTED = [*P.IMPUTE_MEAN, *P.IMPUTE_ZERO, *P.IMPUTE_MEDIAN]


def _blank(c: str, v: str) -> str:
    return f"CASE WHEN {q(c)} IS NULL OR {q(c)} = '' THEN '{v}' ELSE {q(c)} END AS {q(c)}"


_TEXT_DEFAULTS = [(c, v) for cols, v in P.DEFAULT_TEXT for c in cols]

SJ = (
    "sj AS (SELECT conv.* EXCLUDE (" + ", ".join(
        q(c) for c in [*P.JOIN_DROP, *_IMPUTED, *(c for c, _ in _TEXT_DEFAULTS)]
        if c != "situation_date")
    + "), " + ", ".join(_imputed_exprs()) + ", "
    + ", ".join(_blank(c, v) for c, v in _TEXT_DEFAULTS)
    + " FROM conv CROSS JOIN stats s WHERE "
    + " AND ".join(f"{q(c)} IS NOT NULL" for c in P.TWILIGHT_REQUIRED) + ")"
)


def _index_cte(col: str) -> str:
    lab = q(col)
    return (f"idx_{col} AS (SELECT {lab} AS label, CAST(row_number() OVER "
            f"(ORDER BY count(*) DESC, {lab}) - 1 AS DOUBLE) AS i FROM ml0 GROUP BY {lab})")


def _flag(c: str) -> str:
    return f"CASE WHEN {q(c)} = true THEN 1 ELSE 0 END AS {q(c + P.FLAG_SUFFIX)}"


def _daynight(c: str) -> str:
    return (f"CASE WHEN {q(c)} IN ('day', 'Day') THEN 1 WHEN {q(c)} IN ('night', 'Night') "
            f"THEN 0 ELSE -1 END AS {q(c + P.FLAG_SUFFIX)}")


_ML_DROPPED = [c for c in [*P.ML_DROP_TEXT, *P.ML_DROP_GEO]
               if c not in ("situation_date", "Start_Time", "End_Time")]

ML = (
    "ml0 AS (SELECT * REPLACE ("
    + ", ".join(f"coalesce({q(c)}, '{v}') AS {q(c)}" for c, v in P.CATEGORICAL_FILL.items())
    + ") FROM conv),\n"
    + ",\n".join(_index_cte(c) for c in P.INDEX_COLUMNS) + ",\n"
    "ml AS (SELECT ml0.* EXCLUDE (" + ", ".join(
        q(c) for c in [*_ML_DROPPED, *P.INDEX_COLUMNS, *P.BOOL_FLAGS, *P.DAYNIGHT_COLUMNS,
                       *_IMPUTED])
    + "), " + ", ".join(f"{c}_ix.i AS {q(c + P.INDEX_SUFFIX)}" for c in P.INDEX_COLUMNS) + ", "
    + ", ".join(_flag(c) for c in P.BOOL_FLAGS) + ", "
    + ", ".join(_daynight(c) for c in P.DAYNIGHT_COLUMNS) + ", "
    + ", ".join(_imputed_exprs())
    + " FROM ml0 CROSS JOIN stats s "
    + " ".join(f"JOIN idx_{c} {c}_ix ON {c}_ix.label = ml0.{q(c)}" for c in P.INDEX_COLUMNS)
    + ")"
)

# Baseline predictions: the majority class of the ML table (ties: smallest).
MAJ = ("maj AS (SELECT \"Severity\" AS majority_class FROM ml GROUP BY \"Severity\" "
       "ORDER BY count(*) DESC, \"Severity\" LIMIT 1)")
GOLD = ("gold AS (SELECT sj.*, CAST(maj.majority_class AS INTEGER) AS prediction_classe "
        "FROM sj JOIN ml ON ml.\"ID\" = sj.\"ID\" CROSS JOIN maj)")


def with_ctes(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


SILVER = (ACC, CONV, STATS)
GOLD_CTES = (ACC, CONV, STATS, SJ, ML, MAJ, GOLD)


def _hash_date(key: str, dates=P.DELIVERY_DATES, weights=P.DELIVERY_WEIGHTS) -> str:
    v = md5_value(key)
    return "CASE " + " ".join(f"WHEN {v} < {c} THEN '{d.replace('-', '_')}'"
                              for c, d in list(zip(cuts(weights), dates))[:-1]) \
        + f" ELSE '{dates[-1].replace('-', '_')}' END"


def _acc_r6(extra: str = "", exclude=()) -> str:
    """Every accident column, doubles in comparison rounding."""
    dbl = [c for c in P.ACC_DOUBLES if c not in exclude]
    ex = ", ".join(q(c) for c in [*dbl, *exclude])
    return (f"* EXCLUDE ({ex}), " + ", ".join(f"{R6(q(c))} AS {q(c)}" for c in dbl)
            + (", " + extra if extra else ""))


def _sj_r6() -> str:
    dbl = ["Start_Lat", "Start_Lng", "End_Lat", "End_Lng", "Humidity(%)", "Pressure(in)",
           "Distance_km", "Temperature(C)", "Wind_Chill(C)", "Visibility_km", "Wind_Speed_kmh",
           "Precipitation(cm)", "duration_minutes_accident", "duration_minutes_record_weather"]
    return (f"* EXCLUDE ({', '.join(q(c) for c in dbl)}), "
            + ", ".join(f"{R6(q(c))} AS {q(c)}" for c in dbl))


_ML_DOUBLES = ["Humidity(%)", "Pressure(in)", "Distance_km", "Temperature(C)", "Wind_Chill(C)",
               "Visibility_km", "Wind_Speed_kmh", "Precipitation(cm)", "duration_minutes_accident",
               "duration_minutes_record_weather", "wind_dir_sin", "wind_dir_cos"]


def _ml_r6() -> str:
    return (f"* EXCLUDE ({', '.join(q(c) for c in _ML_DOUBLES)}), "
            + ", ".join(f"{R6(q(c))} AS {q(c)}" for c in _ML_DOUBLES))


# The join table's columns, types and nullability.
_JOIN_SCHEMA = [
    ("ID", "string", True), ("Severity", "int", False),
    *((c, "double", True) for c in ("Start_Lat", "Start_Lng", "End_Lat", "End_Lng")),
    *((c, "string", True) for c in ("Description", "Street", "City", "State", "Zipcode", "Timezone", "Airport_Code")),
    ("Humidity(%)", "double", True), ("Pressure(in)", "double", True), ("Weather_Condition", "string", True),
    *((c, "boolean", c != "Turning_Loop") for c in P.BOOL_FLAGS),
    *((c, "string", True) for c in P.DAYNIGHT_COLUMNS),
    *((c, "double", True) for c in ("Distance_km", "Temperature(C)", "Wind_Chill(C)", "Visibility_km",
                                    "Wind_Speed_kmh", "Precipitation(cm)", "duration_minutes_accident",
                                    "duration_minutes_record_weather")),
    ("Wind_Direction_clean", "string", True),
]


def _null_counts() -> list[tuple[str, str]]:
    names = [*P.ACC_TEXTS, "Severity", *P.TIME_COLUMNS, *P.BOOL_FLAGS]
    return [(n, f"count(*) FILTER (WHERE {q(n)} IS NULL)") for n in names] \
        + [(n, f"count(*) FILTER (WHERE {q(n)} IS NULL OR isnan({q(n)}))") for n in P.ACC_DOUBLES]


def _mart(keys: list[str], measures: dict, where: str = "") -> str:
    sel = [q(k) for k in keys]
    for alias, (fn, c) in measures.items():
        if fn == "count":
            sel.append(f"count(*) AS {alias}")
        elif fn == "avg":
            sel.append(f"{R6('avg(' + q(c) + ')')} AS {alias}")
        else:
            sel.append(f"{R6(fn + '(' + q(c) + ')')} AS {alias}")
    w = f" WHERE {where}" if where else ""
    return (f"SELECT {', '.join(sel)} FROM gold{w} GROUP BY "
            + ", ".join(q(k) for k in keys))


def _infra() -> str:
    parts = [f"SELECT count(*) FILTER (WHERE {q(f)} = true) AS total_accidents, "
             f"{R6('avg(CASE WHEN ' + q(f) + ' = true THEN \"Severity\" END)')} AS avg_severity, "
             f"'{f}' AS infrastructure FROM gold" for f in P.INFRA_FLAGS]
    return " UNION ALL ".join(parts)


def _bronze_rows() -> str:
    return f"bz AS (SELECT *, {_hash_date(q('ID'))} AS batch_date FROM acc)"


def _sizes(src: str) -> str:
    return (f"SELECT batch_date, rows, CAST(sum(rows) OVER (ORDER BY batch_date) AS BIGINT) "
            f"AS snapshot_rows FROM (SELECT batch_date, count(*) AS rows FROM {src} "
            f"GROUP BY batch_date)")


def _late() -> tuple[str, str]:
    bz = f"bz AS (SELECT {_hash_date(q('ID'), P.LATE_DATES, P.LATE_WEIGHTS)} AS batch_date FROM acc)"
    return bz, "cnt AS (SELECT batch_date, count(*) AS rows FROM bz GROUP BY batch_date)"


def _incremental() -> str:
    run1 = ("SELECT batch_date, rows, 'ingested' AS status, 1 AS run FROM cnt "
            "WHERE batch_date IN ('2025_06_15', '2025_06_16')")
    run2 = ("SELECT batch_date, CASE WHEN batch_date = '2025_06_17' THEN rows END AS rows, "
            "CASE WHEN batch_date = '2025_06_17' THEN 'ingested' "
            "WHEN batch_date = '2025_06_14' THEN 'late' ELSE 'present' END AS status, 2 AS run "
            "FROM cnt")
    sizes = ("sz AS (SELECT batch_date, CAST(sum(rows) OVER (ORDER BY batch_date) AS BIGINT) "
             "AS snapshot_rows FROM cnt WHERE batch_date <> '2025_06_14')")
    return with_ctes(ACC, *_late(), sizes, select=(
        f"SELECT r.batch_date, r.rows, r.status, r.run, sz.snapshot_rows FROM ({run1} UNION ALL "
        f"{run2}) r LEFT JOIN sz ON sz.batch_date = r.batch_date"))


def _csv_roundtrip() -> str:
    return with_ctes(ACC, select=(
        "SELECT \"City\", count(*) AS rows, count(\"Description\") AS descriptions, "
        f"{R6('sum(\"Temperature(F)\")')} AS sum_temp_f, "
        "count(\"Weather_Timestamp\") AS weather_times, "
        "count(*) FILTER (WHERE \"Junction\") AS junctions FROM acc GROUP BY \"City\""))


def build() -> dict[str, str]:
    o: dict[str, str] = {}
    conv_sel = lambda cols: with_ctes(*SILVER, select=(
        "SELECT \"ID\", " + ", ".join(f"{R6(q(c))} AS {q(c)}" for c in cols) + " FROM conv"))
    o["unit_conversions"] = conv_sel([t for t, _ in P.UNIT_CONVERSIONS.values()])
    o["duration_minutes"] = conv_sel(list(P.DURATIONS))
    o["wind_clean"] = with_ctes(*SILVER, select=(
        "SELECT \"ID\", \"Wind_Direction\", \"Wind_Direction_clean\" FROM conv"))
    o["wind_vector"] = with_ctes(*SILVER, select=(
        f"SELECT \"ID\", \"wind_angle\", {R12('wind_dir_sin')} AS wind_dir_sin, "
        f"{R12('wind_dir_cos')} AS wind_dir_cos FROM conv"))
    o["bool_flags"] = with_ctes(ACC, select=(
        "SELECT \"ID\", " + ", ".join(_flag(c) for c in P.BOOL_FLAGS) + " FROM acc"))
    o["daynight_flags"] = with_ctes(ACC, select=(
        "SELECT \"ID\", " + ", ".join(_daynight(c) for c in P.DAYNIGHT_COLUMNS) + " FROM acc"))
    o["fill_constant"] = with_ctes(ACC, select=(
        "SELECT \"ID\", " + ", ".join(f"coalesce({q(c)}, '{v}') AS {q(c)}"
                                      for c, v in P.CATEGORICAL_FILL.items())
        + f", {R6('coalesce(\"Visibility(mi)\", 10.0E0)')} AS \"Visibility(mi)\" FROM acc"))
    o["default_text"] = with_ctes(ACC, select=(
        "SELECT \"ID\", " + ", ".join(_blank(c, v) for c, v in _TEXT_DEFAULTS) + " FROM acc"))
    o["dropna_subset"] = with_ctes(ACC, select=(
        "SELECT \"ID\", " + ", ".join(q(c) for c in P.TWILIGHT_REQUIRED) + " FROM acc WHERE "
        + " AND ".join(f"{q(c)} IS NOT NULL" for c in P.TWILIGHT_REQUIRED)))
    o["drop_tolerant"] = with_ctes(ACC, select=(
        "SELECT " + _acc_r6().replace("* EXCLUDE (", "* EXCLUDE (" + ", ".join(q(c) for c in P.DROPPED) + ", ", 1)
        + " FROM acc"))
    nums = [c for c in ["Severity", *P.ACC_DOUBLES] if c != "Severity"]
    o["numeric_columns"] = with_ctes(ACC, select=(
        "SELECT " + ", ".join(f"count({q(c)}) AS {q(c)}" for c in nums) + " FROM acc"))

    def imputed(mean=(), zero=(), median=()):
        exprs = _imputed_exprs(list(mean), list(zero), list(median))
        names = [*mean, *zero, *median]
        return with_ctes(*SILVER, select=(
            "SELECT \"ID\", " + ", ".join(f"{R6(e.rsplit(' AS ', 1)[0])} AS {q(n)}"
                                          for e, n in zip(exprs, names))
            + " FROM conv CROSS JOIN stats s"))
    o["impute_mean"] = imputed(mean=P.IMPUTE_MEAN)
    o["impute_zero"] = imputed(zero=P.IMPUTE_ZERO)
    o["impute_median"] = imputed(median=P.IMPUTE_MEDIAN)
    o["impute_all"] = imputed(P.IMPUTE_MEAN, P.IMPUTE_ZERO, P.IMPUTE_MEDIAN)
    inf, price = "'Infinity'::DOUBLE", "l_extendedprice::DOUBLE"
    middle = lambda e: f"round(quantile_disc({e}, 0.5) + 0.0, 6)"
    o["median_extremes"] = "SELECT " + ", ".join([
        middle(f"CASE l_orderkey % 4 WHEN 0 THEN {inf} WHEN 1 THEN -{inf} WHEN 2 THEN {price} ELSE -{price} END")
        + " AS both_infinite",
        middle(f"CASE WHEN l_orderkey % 3 = 0 THEN {price} ELSE {inf} END") + " AS mostly_infinite",
        "quantile_disc(l_linenumber, 0.5)::DOUBLE AS tiny",
        middle(f"CASE WHEN l_orderkey % 2 <> 0 THEN {price} END") + " AS huge_or_nan",
        "0.0::DOUBLE AS zeros", "NULL::DOUBLE AS nothing"]) + " FROM lineitem"
    o["impute_many_valued"] = (
        "WITH l AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 7 <> 0 THEN l_extendedprice::DOUBLE END "
        "AS price FROM lineitem) SELECT l_orderkey, l_linenumber, "
        + R2("coalesce(price, (SELECT quantile_disc(price, 0.5) FROM l))") + " AS price FROM l")
    nc = _null_counts()
    o["null_profile"] = with_ctes(ACC, select=(
        "SELECT " + ", ".join(f"{e} AS {q(n)}" for n, e in nc) + " FROM acc"))
    o["null_profile_long"] = with_ctes(ACC, select=" UNION ALL ".join(
        f"SELECT '{n}' AS column_name, {e} AS missing FROM acc" for n, e in nc))
    o["index_frequency"] = with_ctes(*SILVER, ML, select=(
        "SELECT \"ID\", " + ", ".join(q(c + P.INDEX_SUFFIX) for c in P.INDEX_COLUMNS)
        + " FROM ml"))
    o["index_joined"] = o["index_frequency"]
    o["index_many_labels"] = (
        "WITH l AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 11 <> 0 "
        "THEN l_extendedprice::DECIMAL(18,2)::VARCHAR END AS price FROM lineitem), "
        "k AS (SELECT price, row_number() OVER (ORDER BY count(*) DESC, price) - 1 AS i FROM l "
        "WHERE price IS NOT NULL GROUP BY price) "
        "SELECT l.*, coalesce(i, (SELECT count(*) FROM k))::DOUBLE AS price_idx FROM l LEFT JOIN k USING (price)")
    o["silver_join"] = with_ctes(*SILVER, SJ, select=f"SELECT {_sj_r6()} FROM sj")
    o["silver_ml"] = with_ctes(*SILVER, ML, select=f"SELECT {_ml_r6()} FROM ml")
    # the stage's wide-table storage must give the same two tables
    o["silver_stage_join"] = o["silver_join"]
    o["silver_stage_ml"] = o["silver_ml"]

    o["mart_city"] = with_ctes(*GOLD_CTES, select=_mart(*P.CITY_MART))
    o["mart_weather"] = with_ctes(*GOLD_CTES, select=_mart(*P.WEATHER_MART))
    o["mart_severe_weather"] = with_ctes(*GOLD_CTES, select=_mart(
        *P.SEVERE_WEATHER_MART, where="\"Severity\" = 4"))
    o["mart_infra"] = with_ctes(*GOLD_CTES, select=_infra())
    o["mart_generic"] = with_ctes(*GOLD_CTES, select=_mart(*P.TIMEZONE_MART, where="\"Severity\" >= 3"))
    o["enrich_join"] = with_ctes(*GOLD_CTES, select=f"SELECT {_sj_r6()} FROM gold")
    o["enrich_join_audit"] = with_ctes(*SILVER, SJ, ML, select=(
        "SELECT (SELECT count(*) FROM sj) AS left_rows, (SELECT count(*) FROM ml) AS right_rows, "
        "(SELECT count(*) FROM sj JOIN ml ON sj.\"ID\" = ml.\"ID\") AS matched_rows"))
    o["union_by_name"] = with_ctes(ACC, select=(
        "SELECT \"ID\", \"Severity\", \"City\", \"State\" FROM acc"))
    o["preview_topn"] = with_ctes(*SILVER, SJ, select=(
        f"SELECT {_sj_r6()} FROM sj ORDER BY \"ID\" LIMIT 10"))
    o["page_rows"] = with_ctes(*GOLD_CTES, select=(
        f"SELECT {_sj_r6()} FROM gold ORDER BY \"ID\" LIMIT 20 OFFSET 25"))

    o["page_indexed"] = with_ctes(*GOLD_CTES, select=(
        f"SELECT *, 0 AS page FROM (SELECT {_sj_r6()} FROM gold ORDER BY \"ID\" LIMIT 20 OFFSET 25) UNION ALL "
        f"SELECT *, 1 AS page FROM (SELECT {_sj_r6()} FROM gold ORDER BY \"ID\" LIMIT 30 OFFSET 700)"))
    o["page_after"] = with_ctes(*GOLD_CTES, select=(
        f"SELECT {_sj_r6()} FROM gold WHERE \"ID\" > 'A-200' ORDER BY \"ID\" LIMIT 20"))
    o["gold_full_copy"] = o["enrich_join"]
    groups = {"dm_accidents_by_city": "SELECT DISTINCT \"City\", \"State\" FROM gold",
              "dm_weather_accidents": "SELECT DISTINCT \"Weather_Condition\" FROM gold",
              "dm_accidents_by_infra": f"SELECT unnest(range({len(P.INFRA_FLAGS)}))",
              "dm_grave_accidents_weather": "SELECT DISTINCT \"Weather_Condition\" FROM gold WHERE \"Severity\" = 4",
              "gold_final_accidents": "SELECT 1 FROM gold"}
    o["publish_report"] = with_ctes(*GOLD_CTES, select=" UNION ALL ".join(
        f"SELECT '{n}' AS mart, 'ok' AS status, NULL::VARCHAR AS error, (SELECT count(*) FROM ({t})) AS rows"
        for n, t in groups.items()))

    o["scan_parquet"] = f"SELECT * REPLACE ({R6('value')} AS value) FROM events"
    o["scan_pushdown"] = (f"SELECT event_id, user_id, {R6('value')} AS value FROM events "
                          "WHERE event_type = 'click'")
    o["scan_csv_roundtrip"] = _csv_roundtrip()
    o["table_roundtrip"] = with_ctes(ACC, select=f"SELECT {_acc_r6()} FROM acc")
    bz = _bronze_rows()
    o["delivery_counts"] = with_ctes(ACC, bz, select=(
        "SELECT batch_date, count(*) AS rows, count(*) AS csv_rows FROM bz GROUP BY batch_date"))
    o["batch_dates"] = with_ctes(ACC, bz, select="SELECT DISTINCT batch_date FROM bz")
    o["latest_snapshot"] = with_ctes(ACC, bz, select=f"SELECT {_acc_r6()} FROM bz")
    o["bronze_snapshot"] = with_ctes(ACC, bz, select=(
        f"SELECT {_acc_r6()} FROM bz WHERE batch_date <= '2025_06_16'"))
    o["bronze_incremental"] = _incremental()
    o["bronze_rewrite_idempotent"] = with_ctes(ACC, bz, select=_sizes("bz"))
    o["bronze_stream"] = with_ctes(ACC, bz, select=_sizes("bz"))
    o["scan_csv_quarantine"] = (
        "SELECT reason, count(*) AS rows, sum(event_id)::BIGINT AS ids FROM (SELECT event_id, CASE event_id % 10 "
        "WHEN 3 THEN 'value' WHEN 4 THEN 'fields' WHEN 5 THEN 'fields' WHEN 6 THEN 'fields' ELSE 'good' END AS reason "
        "FROM events) GROUP BY reason")
    o["row_audit_committed"] = with_ctes(*SILVER, SJ, select=(
        "SELECT count(*) AS observed, count(*) AS committed, true AS equal FROM sj"))
    late = f"{_hash_date(q('ID'))} <> '2025_06_16' OR \"Severity\" < 3"
    o["marts_incremental"] = with_ctes(
        *GOLD_CTES, f"kept AS (SELECT * FROM gold WHERE {late})",
        f"w AS ({_mart(*P.WEATHER_MART).replace('FROM gold', 'FROM kept')})",
        "s AS (SELECT \"Weather_Condition\" AS c, count(*) AS nb_grave_accidents FROM kept WHERE \"Severity\" = 4 "
        "GROUP BY 1)",
        select="SELECT w.*, s.nb_grave_accidents FROM w LEFT JOIN s ON s.c IS NOT DISTINCT FROM w.\"Weather_Condition\"")
    o["bronze_mixed"] = with_ctes(ACC, bz, select=(
        "SELECT *, CASE batch_date WHEN '2025_06_16' THEN 'batch' ELSE 'stream' END AS writer "
        f"FROM ({_sizes('bz')})"))
    o["bronze_stream_late"] = with_ctes(ACC, *_late(), select=(
        "SELECT batch_date, CASE batch_date WHEN '2025_06_17' THEN 'ingested' WHEN '2025_06_14' THEN 'late' "
        "ELSE 'present' END AS status, CASE WHEN batch_date <> '2025_06_14' THEN rows END AS rows FROM cnt"))
    o["land_report"] = with_ctes(ACC, bz, select=(
        "SELECT batch_date, count(*) AS rows, 'landed' AS status FROM bz GROUP BY batch_date"))
    o["split_hash"] = with_ctes(ACC, select=(
        "SELECT \"ID\", CASE WHEN v < 88583700 THEN 0 WHEN v < 177167401 THEN 1 ELSE 2 END AS part "
        f"FROM (SELECT \"ID\", {md5_value(q('ID'))} AS v FROM acc)"))
    o["split_random"] = with_ctes(ACC, select=(
        "SELECT count(*) AS rows, count(DISTINCT \"ID\") AS ids, 3::BIGINT AS parts FROM acc"))
    o["stamp_batch"] = with_ctes(ACC, select=(
        f"SELECT {_acc_r6(extra=chr(39) + P.DELIVERY_DATES[0] + chr(39) + ' AS situation_date')} FROM acc"))
    o["repartition_by_key"] = with_ctes(ACC, select=(
        "SELECT \"State\", count(*) AS rows FROM acc GROUP BY \"State\""))
    o["repartition_exact"] = with_ctes(ACC, select=(
        "SELECT \"State\", count(*) AS rows, 1::BIGINT AS partitions, true AS within_ten FROM acc GROUP BY \"State\""))
    o["row_audit"] = with_ctes(*SILVER, SJ, select=(
        "SELECT 'raw' AS step, (SELECT count(*) FROM acc) AS rows UNION ALL "
        "SELECT 'silver_join', (SELECT count(*) FROM sj) UNION ALL "
        "SELECT 'mart_weather', (SELECT count(DISTINCT coalesce(\"Weather_Condition\", chr(0))) FROM sj)"))

    o["majority_baseline"] = with_ctes(*SILVER, ML, select=(
        "SELECT CAST(arg_max(\"Severity\", n * 100 - \"Severity\") AS INTEGER) AS majority_class, "
        "max(n) AS majority_rows, CAST(sum(n) AS BIGINT) AS rows, "
        f"{R6('max(n) / sum(n)')} AS majority_share "
        "FROM (SELECT \"Severity\", count(*) AS n FROM ml GROUP BY \"Severity\")"))
    split = f"{md5_value(q('ID'))} < 214748365"
    o["accuracy_metric"] = with_ctes(*SILVER, ML, select=(
        "SELECT count(*) AS rows, count(*) FILTER (WHERE \"Severity\" = m.c) AS correct, "
        f"{R6('avg(CASE WHEN \"Severity\" = m.c THEN 1.0E0 ELSE 0.0E0 END)')} AS accuracy "
        f"FROM ml, (SELECT \"Severity\" AS c FROM ml WHERE {split} GROUP BY \"Severity\" "
        "ORDER BY count(*) DESC, \"Severity\" LIMIT 1) m "
        f"WHERE NOT ({split})"))
    o["rf_train_metrics"] = with_ctes(*SILVER, ML, select=(
        f"SELECT count(*) AS rows, {P.TREES} AS trees, true AS beats_majority FROM ml WHERE NOT ({split})"))
    o["rf_predict"] = with_ctes(*SILVER, ML, select=f"SELECT {_ml_r6()}, true AS known_class FROM ml")
    o["rf_saved_model"] = with_ctes(*SILVER, ML, select="SELECT true AS same, count(*) AS rows FROM ml")
    numbers = [*(c + P.INDEX_SUFFIX for c in P.INDEX_COLUMNS), *(c + P.FLAG_SUFFIX for c in P.BOOL_FLAGS),
               *(c + P.FLAG_SUFFIX for c in P.DAYNIGHT_COLUMNS), *_ML_DOUBLES]
    o["assemble_features"] = with_ctes(*SILVER, ML, select=(
        f"SELECT \"ID\", {len(numbers)} AS n_features, round(CAST("
        + " + ".join(f"round(CAST({q(c)} AS DECIMAL(38,12)), 6)" for c in numbers) + " AS DECIMAL(38,12)), 4)::DOUBLE AS total FROM ml"))
    o["medallion_full"] = with_ctes(*GOLD_CTES, select=(
        f"SELECT {_sj_r6().replace('* EXCLUDE (', '* EXCLUDE (prediction_classe, ', 1)}, true AS known_class FROM gold"))
    o["schema_report"] = with_ctes(*SILVER, SJ, select=" UNION ALL ".join(
        f"SELECT {i} AS position, '{n}' AS column_name, '{t}' AS data_type, {b} AS nullable, "
        f"count(*) FILTER (WHERE {q(n)} IS NULL) AS missing FROM sj" for i, (n, t, b) in enumerate(_JOIN_SCHEMA)))
    city = _mart(["City", "State"], {"total_accidents": ("count", "*"), "avg_severity": ("avg", "Severity")})
    o["medallion_resumed"] = with_ctes(*GOLD_CTES, select=f"SELECT *, 0 AS stages_run, 4 AS stages_kept FROM ({city})")
    o["medallion_gold"] = with_ctes(*GOLD_CTES, select=_mart(*P.WEATHER_MART))
    return o


ORACLES = build()
