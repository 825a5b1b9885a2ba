"""Accident-shaped view over the driver's test tables.

The test tables carry no nulls, so the view injects them deterministically
by `event_id % prime`.  One SQL text serves both Spark and the DuckDB
oracle, which keeps the two sides identical by construction:
Spark quotes identifiers with back-ticks, DuckDB with double quotes and
spells STRING as VARCHAR.  The three scans are joined on their keys, so the
view's work grows with the tables (Spark picks the join strategies).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_VIEW = """
SELECT
  concat('A-', CAST(e.event_id AS STRING)) AS "ID",
  concat('Source', CAST(e.event_id % 3 + 1 AS STRING)) AS "Source",
  CAST(CASE WHEN e.event_id % 5 < 3 THEN 2 WHEN e.event_id % 5 = 3 THEN 3 WHEN e.event_id % 10 = 4 THEN 4 ELSE 1 END AS INT) AS "Severity",
  e.ts AS "Start_Time",
  e.ts + INTERVAL '45' MINUTE AS "End_Time",
  CASE WHEN e.event_id % 19 = 0 THEN NULL WHEN e.event_id % 2 = 0 THEN e.ts - INTERVAL '22' MINUTE ELSE e.ts + INTERVAL '13' MINUTE END AS "Weather_Timestamp",
  30.0E0 + (e.user_id % 15) AS "Start_Lat",
  -120.0E0 + (e.user_id % 40) AS "Start_Lng",
  CASE WHEN e.event_id % 2 = 0 THEN NULL ELSE 30.5E0 + (e.user_id % 15) END AS "End_Lat",
  CASE WHEN e.event_id % 2 = 0 THEN NULL ELSE -119.5E0 + (e.user_id % 40) END AS "End_Lng",
  (e.event_id % 300) / 100.0E0 AS "Distance(mi)",
  CASE WHEN e.event_id % 29 = 0 THEN NULL WHEN e.event_id % 31 = 0 THEN '' ELSE concat('event ', e.event_type) END AS "Description",
  CASE WHEN e.event_id % 37 = 0 THEN NULL ELSE concat('Street ', CAST(e.event_id % 50 AS STRING)) END AS "Street",
  CASE WHEN e.event_id % 41 = 0 THEN NULL WHEN e.event_id % 43 = 0 THEN '' ELSE c.c_mktsegment END AS "City",
  'County' AS "County",
  CASE WHEN e.event_id % 47 = 0 THEN NULL ELSE n.n_name END AS "State",
  CASE WHEN e.event_id % 23 = 0 THEN NULL ELSE CAST(10000 + e.user_id AS STRING) END AS "Zipcode",
  'US' AS "Country",
  CASE WHEN e.event_id % 53 = 0 THEN NULL WHEN e.user_id % 2 = 0 THEN 'US/Eastern' ELSE 'US/Pacific' END AS "Timezone",
  CASE WHEN e.event_id % 59 = 0 THEN NULL ELSE concat('K', CAST(e.user_id % 90 AS STRING)) END AS "Airport_Code",
  CASE WHEN e.event_id % 11 = 0 THEN NULL ELSE CAST(e.event_id % 110 AS DOUBLE) END AS "Temperature(F)",
  CASE WHEN e.event_id % 4 = 0 THEN NULL ELSE CAST(e.event_id % 97 AS DOUBLE) END AS "Wind_Chill(F)",
  CASE WHEN e.event_id % 13 = 0 THEN NULL ELSE CAST(e.event_id % 101 AS DOUBLE) END AS "Humidity(%)",
  CASE WHEN e.event_id % 17 = 0 THEN NULL ELSE 28.0E0 + (e.event_id % 300) / 100.0E0 END AS "Pressure(in)",
  CASE WHEN e.event_id % 7 = 0 THEN NULL ELSE CAST(e.event_id % 11 AS DOUBLE) END AS "Visibility(mi)",
  CASE e.event_id % 24 WHEN 0 THEN 'N' WHEN 1 THEN 'NNE' WHEN 2 THEN 'NE' WHEN 3 THEN 'ENE' WHEN 4 THEN 'E' WHEN 5 THEN 'ESE' WHEN 6 THEN 'SE' WHEN 7 THEN 'SSE' WHEN 8 THEN 'S' WHEN 9 THEN 'SSW' WHEN 10 THEN 'SW' WHEN 11 THEN 'WSW' WHEN 12 THEN 'W' WHEN 13 THEN 'WNW' WHEN 14 THEN 'NW' WHEN 15 THEN 'NNW' WHEN 16 THEN 'East' WHEN 17 THEN ' west ' WHEN 18 THEN 'North' WHEN 19 THEN 'South' WHEN 20 THEN 'Calm' WHEN 21 THEN 'VAR' WHEN 22 THEN 'Variable' ELSE NULL END AS "Wind_Direction",
  CASE WHEN e.event_id % 6 = 0 THEN NULL ELSE CAST(e.event_id % 35 AS DOUBLE) END AS "Wind_Speed(mph)",
  CASE WHEN e.event_id % 3 = 0 THEN NULL ELSE (e.event_id % 20) / 100.0E0 END AS "Precipitation(in)",
  CASE WHEN e.event_id % 61 = 0 THEN NULL WHEN e.event_id % 67 = 0 THEN '' ELSE e.event_type END AS "Weather_Condition",
  e.event_id % 8 = 0 AS "Amenity", e.event_id % 10007 < 0 AS "Bump", e.event_id % 9 = 0 AS "Crossing",
  e.event_id % 71 = 0 AS "Give_Way", CASE WHEN e.event_id % 73 = 0 THEN NULL ELSE e.event_id % 5 = 0 END AS "Junction",
  e.event_id % 79 = 0 AS "No_Exit", e.event_id % 83 = 0 AS "Railway", e.event_id % 89 = 0 AS "Roundabout",
  e.event_id % 25 = 0 AS "Station", e.event_id % 15 = 0 AS "Stop", e.event_id % 97 = 0 AS "Traffic_Calming",
  e.event_id % 6 = 0 AS "Traffic_Signal", false AS "Turning_Loop",
  CASE WHEN e.event_id % 101 = 0 THEN NULL WHEN hour(e.ts) BETWEEN 6 AND 17 THEN 'Day' ELSE 'Night' END AS "Sunrise_Sunset",
  CASE WHEN e.event_id % 103 = 0 THEN NULL WHEN hour(e.ts) BETWEEN 5 AND 18 THEN 'Day' ELSE 'Night' END AS "Civil_Twilight",
  CASE WHEN e.event_id % 101 = 0 THEN NULL WHEN hour(e.ts) BETWEEN 5 AND 19 THEN 'day' ELSE 'night' END AS "Nautical_Twilight",
  CASE WHEN e.event_id % 101 = 0 THEN NULL WHEN hour(e.ts) BETWEEN 4 AND 19 THEN 'Day' ELSE 'Night' END AS "Astronomical_Twilight"
FROM {events} e JOIN {customer} c ON c.c_custkey = e.user_id JOIN {nation} n ON n.n_nationkey = c.c_nationkey
"""

# The driver tables the view reads.
SOURCE_TABLES = ("events", "customer", "nation")

# Batch assignment used by the ingestion queries: event_id % 3 picks a date.
BATCH_OF_EVENT = ("2025_06_15", "2025_06_16", "2025_06_17")


def view_sql(dialect: str) -> str:
    """The view text for `spark` (table placeholders kept) or `duckdb`."""
    if dialect == "spark":
        return _VIEW.replace('"', "`")
    if dialect == "duckdb":
        return _VIEW.replace(" STRING)", " VARCHAR)").format(
            **{t: t for t in SOURCE_TABLES})
    raise ValueError(f"unknown dialect {dialect!r}")


def read_tables(spark: SparkSession, sf_dir: str, names=SOURCE_TABLES) -> dict:
    from strata.sources.files import read_parquet
    root = sf_dir.rstrip("/")
    return {n: read_parquet(spark, f"{root}/{n}.parquet") for n in names}


def accidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 46-column raw accident frame over `sf_dir`'s tables."""
    return spark.sql(view_sql("spark"), **read_tables(spark, sf_dir))
