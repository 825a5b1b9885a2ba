"""Property tests against plain-Python statements of the rules."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata import presets as P
from strata.functions import bool_as_int, canonical_direction, compass_angle, daynight_as_int
from strata.operators.features import assemble, index_categoricals
from strata.operators.ingest import split_hash

_WORDS = ["N", "nne", " e ", "East", "WEST", "north", "South", "calm", "VAR", "Variable",
          "NULL", "null", "XX", "", "  ", "ssw", "W N W", None]


def model_direction(x):
    if x is None:
        return None
    n = x.strip(" ").upper()
    if n in P.WIND_UNKNOWN:
        return "UNKNOWN"
    return P.WIND_WORDS.get(n, n)


def model_angle(clean):
    return P.COMPASS_POINTS.index(clean) * 22.5 if clean in P.COMPASS_POINTS else None


def model_daynight(x):
    return 1 if x in ("day", "Day") else 0 if x in ("night", "Night") else -1


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(_WORDS), st.text(alphabet="nsewNSEW ", max_size=4)),
                min_size=1, max_size=30))
def test_wind_rules(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, w string")
    clean = canonical_direction(F.col("w"))
    out = df.select("i", clean.alias("c"), compass_angle(clean).alias("a")).orderBy("i").collect()
    for v, r in zip(values, out):
        assert r["c"] == model_direction(v)
        assert r["a"] == model_angle(model_direction(v))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["day", "Day", "DAY", "night", "Night", "", None]),
                          st.sampled_from([True, False, None])), min_size=1, max_size=30))
def test_flag_rules(spark, values):
    df = spark.createDataFrame([(i, d, b) for i, (d, b) in enumerate(values)],
                               "i int, d string, b boolean")
    out = df.select("i", daynight_as_int(F.col("d")).alias("dn"),
                    bool_as_int(F.col("b")).alias("bi")).orderBy("i").collect()
    for (d, b), r in zip(values, out):
        assert r["dn"] == model_daynight(d)
        assert r["bi"] == (1 if b is True else 0)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(min_value=1, max_value=9), min_size=1, max_size=5))
def test_hash_split_partitions_the_rows(spark, weights):
    df = spark.range(300).select(F.col("id").cast("string").alias("k"))
    parts = split_hash(df, "k", weights)
    counts = [p.count() for p in parts]
    assert sum(counts) == 300
    keys = [r[0] for p in parts for r in p.collect()]
    assert len(keys) == len(set(keys)) == 300


def test_indexed_columns_reach_the_forest_as_categorical(spark):
    df = spark.createDataFrame([(f"A-{i}", 1 + i % 2, ["x", "y", "z"][i % 3], float(i))
                                for i in range(30)], "ID string, Severity int, State string, v double")
    indexed, _ = index_categoricals(df, ["State"])
    assembled, feats = assemble(indexed)
    meta = assembled.schema["features"].metadata["ml_attr"]["attrs"]
    nominal = [a["name"] for a in meta.get("nominal", [])]
    assert nominal == ["State_index"] and "v" in [a["name"] for a in meta["numeric"]]
