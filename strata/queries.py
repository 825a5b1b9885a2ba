"""Registered queries: one per operator of the inventory.

Each query takes `(spark, sf_dir)`, reads the driver's tables (through the
accident view or directly) and returns a DataFrame.  Doubles are rounded to
6 places at the very end (`_r6`) so that results compare with the DuckDB
oracle independently of summation order; the operators themselves never
round beyond what the pipeline specifies.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import presets as P
from strata.fixture import BATCH_OF_EVENT, accidents
from strata.functions import (bool_to_int, clean_wind, convert_all, convert_units,
                              add_durations, daynight_to_int, default_text)
from strata.operators import marts
from strata.operators.columns import drop_tolerant, numeric_columns
from strata.operators.features import assemble, index_categoricals
from strata.operators.ingest import (assign_deliveries, audited_write, repartition_by_key, row_audit,
                                     split_hash, split_label, split_random, stamp)
from strata.operators.joins import enrich, join_audit, union_by_name
from strata.operators.model import (accuracy_frame, load_model, majority_baseline, majority_class,
                                    partitions_for, predict_constant, save_model, train_test_split)
from strata.operators.nulls import (dropna_subset, fill_constant, imputation_stats, impute, null_profile,
                                    null_profile_long, schema_report)
from strata.operators.labels import fit_label_tables, index_by_table
from strata.operators.partial_marts import PartialMarts
from strata.operators.serve import build_page_index, page, page_after, preview
from strata.plans import bronze
from strata.plans.bronze_table import BATCH_PART, PART_COLUMN, read_bronze
from strata.plans.medallion import (baseline_predictions, fit_forest, forest_predictions, run_medallion,
                                    score_wide)
from strata.plans.silver import (indexer_from_labels, join_view, majority_from_counts, ml_view,
                                 prepare, profile, silver_join, silver_ml, silver_wide)
from strata.session import scratch_path, unique_name
from strata.sources.batches import latest_listed, listed_dates, snapshot
from strata.sources.files import load_csv, read_csv, read_parquet
from strata.sources.sinks import parquet_publisher, save_table, write_csv, write_partitioned
from strata.streaming import run_bronze_stream

BATCH = P.BATCH_COLUMN


def _r6(df: DataFrame) -> DataFrame:
    """Round every double column to 6 decimals (comparison form)."""
    exprs = [F.round(F.col(f"`{f.name}`"), 6).alias(f.name)
             if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
             for f in df.schema.fields]
    return df.select(exprs)


def _cols(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*[F.col(f"`{n}`") for n in names])


def _acc(spark, sf):
    return accidents(spark, sf)


# ---------------------------------------------------------------- silver ops

def q_unit_conversions(spark, sf):
    df = convert_units(_acc(spark, sf))
    return _r6(_cols(df, "ID", *[t for t, _ in P.UNIT_CONVERSIONS.values()]))


def q_duration_minutes(spark, sf):
    df = add_durations(_acc(spark, sf))
    return _r6(_cols(df, "ID", *P.DURATIONS))


def q_wind_clean(spark, sf):
    df = clean_wind(_acc(spark, sf))
    return _cols(df, "ID", "Wind_Direction", "Wind_Direction_clean")


def q_wind_vector(spark, sf):
    df = clean_wind(_acc(spark, sf))
    return df.select("ID", "wind_angle", F.round("wind_dir_sin", 12).alias("wind_dir_sin"),
                     F.round("wind_dir_cos", 12).alias("wind_dir_cos"))


def q_bool_flags(spark, sf):
    df = bool_to_int(_acc(spark, sf))
    return _cols(df, "ID", *[c + P.FLAG_SUFFIX for c in P.BOOL_FLAGS])


def q_daynight_flags(spark, sf):
    df = daynight_to_int(_acc(spark, sf))
    return _cols(df, "ID", *[c + P.FLAG_SUFFIX for c in P.DAYNIGHT_COLUMNS])


def q_fill_constant(spark, sf):
    df = fill_constant(_acc(spark, sf), {**P.CATEGORICAL_FILL, "Visibility(mi)": 10.0})
    return _r6(_cols(df, "ID", *P.CATEGORICAL_FILL, "Visibility(mi)"))


def q_default_text(spark, sf):
    df = default_text(_acc(spark, sf))
    cols = [c for cols, _ in P.DEFAULT_TEXT for c in cols]
    return _cols(df, "ID", *cols)


def q_dropna_subset(spark, sf):
    df = dropna_subset(_acc(spark, sf), P.TWILIGHT_REQUIRED)
    return _cols(df, "ID", *P.TWILIGHT_REQUIRED)


DROP_LIST = ["Description", "Street", "Country", "County", "Not_A_Column", "Zipcode"]


def q_drop_tolerant(spark, sf):
    return _r6(drop_tolerant(_acc(spark, sf), DROP_LIST))


def q_numeric_columns(spark, sf):
    df = _acc(spark, sf)
    chosen = numeric_columns(df, exclude=[P.LABEL])
    return df.select([F.count(F.col(f"`{c}`")).alias(c) for c in chosen])


def _imputed(spark, sf, mean=(), zero=(), median=()):
    df = convert_all(_acc(spark, sf))
    out = impute(df, mean=list(mean), zero=list(zero), median=list(median))
    return _r6(_cols(out, "ID", *mean, *zero, *median))


def q_impute_mean(spark, sf):
    return _imputed(spark, sf, mean=P.IMPUTE_MEAN)


def q_impute_zero(spark, sf):
    return _imputed(spark, sf, zero=P.IMPUTE_ZERO)


def q_impute_median(spark, sf):
    return _imputed(spark, sf, median=P.IMPUTE_MEDIAN)


def q_impute_all(spark, sf):
    return _imputed(spark, sf, P.IMPUTE_MEAN, P.IMPUTE_ZERO, P.IMPUTE_MEDIAN)


def q_impute_many_valued(spark, sf):
    """Median imputation of a column with about as many values as rows."""
    price = F.when(F.col("l_orderkey") % 7 != 0, F.col("l_extendedprice")).cast("double")
    df = read_parquet(spark, f"{sf}/lineitem.parquet").select("l_orderkey", "l_linenumber", price.alias("price"))
    return _r6(impute(df, mean=[], zero=[], median=["price"]))


EXTREMES = {
    "both_infinite": "CASE l_orderkey % 4 WHEN 0 THEN CAST('Infinity' AS DOUBLE) WHEN 1 THEN CAST('-Infinity' AS DOUBLE) "
                     "WHEN 2 THEN CAST(l_extendedprice AS DOUBLE) ELSE -CAST(l_extendedprice AS DOUBLE) END",
    "mostly_infinite": "CASE WHEN l_orderkey % 3 = 0 THEN CAST(l_extendedprice AS DOUBLE) "
                       "ELSE CAST('Infinity' AS DOUBLE) END",
    "tiny": "l_linenumber * CAST('4.9E-324' AS DOUBLE)",
    "huge_or_nan": "CASE WHEN l_orderkey % 2 = 0 THEN CAST('NaN' AS DOUBLE) "
                   "ELSE CAST(l_extendedprice AS DOUBLE) * CAST('1E300' AS DOUBLE) END",
    "zeros": "CASE WHEN l_orderkey % 2 = 0 THEN CAST('-0.0' AS DOUBLE) ELSE CAST('0.0' AS DOUBLE) END",
    "nothing": "CAST(NULL AS DOUBLE)",
}


def q_median_extremes(spark, sf):
    """Medians of columns with infinities, denormals, NaN, signed zeros and
    nothing at all, counted together (tiny and huge ones scaled to compare)."""
    df = read_parquet(spark, f"{sf}/lineitem.parquet").selectExpr(
        *[f"{e} AS {c}" for c, e in EXTREMES.items()])
    stats = imputation_stats(df, median=list(EXTREMES))
    scale = {"tiny": 5e-324, "huge_or_nan": 1e300}
    values = [None if (v := stats[f"median::{c}"]) is None else v / scale.get(c, 1.0) for c in EXTREMES]
    return _r6(spark.createDataFrame([tuple(values)], ", ".join(f"{c} double" for c in EXTREMES)))


def q_null_profile(spark, sf):
    return null_profile(_acc(spark, sf))


def q_null_profile_long(spark, sf):
    return null_profile_long(_acc(spark, sf))


def q_schema_report(spark, sf):
    return schema_report(silver_join(_acc(spark, sf)), with_missing=True)


def q_index_frequency(spark, sf):
    df, _ = index_categoricals(prepare(_acc(spark, sf)), drop_sources=False)
    return _cols(df, "ID", *[c + P.INDEX_SUFFIX for c in P.INDEX_COLUMNS])


def q_index_joined(spark, sf):
    """The same indices from label tables: no label reaches the driver."""
    df = fill_constant(prepare(_acc(spark, sf)), P.CATEGORICAL_FILL)
    for c, table in fit_label_tables(df, P.INDEX_COLUMNS).items():
        df = index_by_table(df, c, table, c + P.INDEX_SUFFIX)
    return _cols(df, "ID", *[c + P.INDEX_SUFFIX for c in P.INDEX_COLUMNS])


def q_index_many_labels(spark, sf):
    """Index of a column with a label per few rows (prices as text, with nulls):
    labels, ranks and the join are all distributed."""
    price = F.when(F.col("l_orderkey") % 11 != 0, F.col("l_extendedprice").cast("decimal(18,2)").cast("string"))
    df = read_parquet(spark, f"{sf}/lineitem.parquet").select("l_orderkey", "l_linenumber", price.alias("price"))
    return index_by_table(df, "price", fit_label_tables(df, ["price"])["price"], "price_idx")


def q_silver_join(spark, sf):
    return _r6(silver_join(_acc(spark, sf)))


def q_silver_ml(spark, sf):
    return _r6(_ml_table(spark, sf))


def _silver_stage(spark, sf):
    """The silver stage's storage path: both tables written once as a wide
    parquet table (shared scratch folder), read back as views."""
    raw = _acc(spark, sf)
    prof = profile(prepare(raw))
    wide, join_cols, ml_cols = silver_wide(raw, prof["stats"], prof["labels"])
    path = scratch_path(spark, "silver_wide")
    wide.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path), join_cols, ml_cols


def q_silver_stage_join(spark, sf):
    wide, join_cols, _ = _silver_stage(spark, sf)
    return _r6(join_view(wide, join_cols))


def q_silver_stage_ml(spark, sf):
    wide, _, ml_cols = _silver_stage(spark, sf)
    return _r6(ml_view(wide, ml_cols))


# ---------------------------------------------------------------- gold ops

def _silver_pair(spark, sf):
    """Both silver tables and the baseline predictions from one profile job."""
    raw = _acc(spark, sf)
    prof = profile(prepare(raw))
    ml, _ = silver_ml(raw, prof["stats"], indexer_from_labels(prof["labels"]))
    preds = baseline_predictions(ml, majority=majority_from_counts(prof["class_counts"]))
    return silver_join(raw, prof["stats"]), preds


def _gold(spark, sf) -> DataFrame:
    """Gold rows: the silver join table with the baseline model's class,
    scored in place (equal to the enrichment join; see `q_enrich_join`)."""
    raw = _acc(spark, sf)
    prof = profile(prepare(raw))
    wide, join_cols, _ = silver_wide(raw, prof["stats"], prof["labels"])
    return score_wide(wide, join_cols, majority=majority_from_counts(prof["class_counts"]))


def q_mart_city(spark, sf):
    return _r6(marts.mart_city(_gold(spark, sf)))


def q_mart_weather(spark, sf):
    return _r6(marts.mart_weather(_gold(spark, sf)))


def q_mart_infra(spark, sf):
    return _r6(marts.mart_infrastructure(_gold(spark, sf)))


def q_mart_severe_weather(spark, sf):
    return _r6(marts.mart_severe_weather(_gold(spark, sf)))


GENERIC_SPEC = (["Timezone"], {
    "accidents": ("count", "*"),
    "avg_wind_chill": ("avg", "Wind_Chill(C)"),
    "max_visibility": ("max", "Visibility_km"),
    "min_pressure": ("min", "Pressure(in)"),
    "total_precip": ("sum", "Precipitation(cm)"),
})


def q_mart_generic(spark, sf):
    keys, measures = GENERIC_SPEC
    return _r6(marts.build_mart(_gold(spark, sf), keys, measures,
                                where=F.col(P.LABEL) >= 3))


def q_enrich_join(spark, sf):
    sj, preds = _silver_pair(spark, sf)
    return _r6(enrich(sj, preds, P.KEY, [P.PREDICTION_CLASS]))


def q_enrich_join_audit(spark, sf):
    sj, preds = _silver_pair(spark, sf)
    return join_audit(sj, preds, P.KEY)


def q_union_by_name(spark, sf):
    df = _acc(spark, sf).select("ID", "Severity", "City", "State")
    a, b, c = split_hash(df, "ID", [1, 1, 1])
    parts = [a, b.select("State", "City", "Severity", "ID"), c.select("City", "ID", "State", "Severity")]
    return union_by_name(parts)


def q_preview_topn(spark, sf):
    return _r6(preview(silver_join(_acc(spark, sf)), 10))


def q_page_rows(spark, sf):
    return _r6(page(_gold(spark, sf), offset=25, limit=20))


def q_page_after(spark, sf):
    """The 20 gold rows after a key: the predicate reaches the scan."""
    return _r6(page_after(_gold(spark, sf), PAGE_KEY, 20))


PAGE_KEY = "A-200"


def q_page_indexed(spark, sf):
    """Two pages read through the position index: the first of `page_rows` and
    a deep one."""
    index = build_page_index(_gold(spark, sf), scratch_path(spark, "pages"))
    pages = [index.page(offset, limit).withColumn("page", F.lit(k))
             for k, (offset, limit) in enumerate([(25, 20), (700, 30)])]
    return _r6(pages[0].unionByName(pages[1]))


# ---------------------------------------------------------------- sources/sinks

def q_scan_parquet(spark, sf):
    return _r6(read_parquet(spark, f"{sf}/events.parquet"))


def q_scan_pushdown(spark, sf):
    """A pruned, filtered scan: the filter and the three columns reach parquet."""
    ev = read_parquet(spark, f"{sf}/events.parquet")
    return _r6(ev.filter(F.col("event_type") == "click").select("event_id", "user_id", "value"))


def q_scan_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv")
    write_csv(_acc(spark, sf), path)
    back = read_csv(spark, path, P.ACC_SCHEMA)
    return _r6(back.groupBy("City").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("Description").alias("descriptions"),
        F.sum("Temperature(F)").alias("sum_temp_f"),
        F.count("Weather_Timestamp").alias("weather_times"),
        F.count_if(F.col("Junction")).alias("junctions")))


CHECKED = T.StructType([T.StructField("id", T.LongType()), T.StructField("user", T.LongType()),
                        T.StructField("value", T.DoubleType()), T.StructField("kind", T.StringType())])


def q_scan_csv_quarantine(spark, sf):
    """Event lines with bad numbers, missing and extra fields and broken quotes:
    good and rejected rows by reason, with the sum of their ids."""
    line = F.concat_ws(",", F.col("event_id"), F.col("user_id"), F.lit("1.5"), F.col("event_type"))
    bad = (F.when(F.col("event_id") % 10 == 3, F.regexp_replace(line, ",1[.]5,", ",notanumber,"))
           .when(F.col("event_id") % 10 == 4, F.concat_ws(",", "event_id", "user_id"))
           .when(F.col("event_id") % 10 == 5, F.concat(line, F.lit(",more")))
           .when(F.col("event_id") % 10 == 6, F.regexp_replace(line, "^([0-9]+),", '$1,"'))
           .otherwise(line))
    path = scratch_path(spark, "lines")
    read_parquet(spark, f"{sf}/events.parquet").select(bad).write.text(path)
    good, rejected = load_csv(spark, path, scratch_path(spark, "checked"), CHECKED, header=False)
    ids = F.regexp_extract("record", "^([0-9]+)", 1).cast("long")
    return good.select(F.lit("good").alias("reason"), "id").unionByName(
        rejected.select("reason", ids.alias("id"))).groupBy("reason").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("id").alias("ids"))


def q_row_audit_committed(spark, sf):
    """Rows of a written table by the write's own counter and by the footers."""
    audit = audited_write(silver_join(_acc(spark, sf)), scratch_path(spark, "audited"))
    return spark.createDataFrame([(audit["observed"], audit["committed"], audit["equal"])],
                                 "observed bigint, committed bigint, equal boolean")


def q_table_roundtrip(spark, sf):
    name = unique_name("acc_table")
    save_table(_acc(spark, sf), name, path=scratch_path(spark, "table"))
    return _r6(spark.table(name))


def _deliver(spark, sf):
    """Land the accident rows as three dated deliveries (hash split by ID)."""
    raw_root = scratch_path(spark, "raw")
    bronze.write_deliveries(_acc(spark, sf), raw_root, P.KEY)
    return raw_root


def _deliver_and_accumulate(spark, sf):
    raw_root = _deliver(spark, sf)
    bronze_root = scratch_path(spark, "bronze")
    bronze.accumulate(spark, raw_root, bronze_root)
    return raw_root, bronze_root


def q_delivery_counts(spark, sf):
    root = scratch_path(spark, "deliveries")
    csv_root = scratch_path(spark, "deliveries_csv")
    counts = bronze.write_deliveries(_acc(spark, sf), root, P.KEY, csv_root=csv_root)
    csv_schema = T.StructType([*P.ACC_SCHEMA.fields, T.StructField(BATCH, T.StringType())])
    csv_counts = (read_csv(spark, csv_root, csv_schema).groupBy(BATCH)
                  .agg(F.count(F.lit(1)).alias("csv_rows")))
    return counts.join(csv_counts, BATCH, "full")


def q_batch_dates(spark, sf):
    _, bronze_root = _deliver_and_accumulate(spark, sf)
    return listed_dates(spark, bronze_root)


def q_latest_snapshot(spark, sf):
    _, bronze_root = _deliver_and_accumulate(spark, sf)
    return _r6(snapshot(read_bronze(spark, bronze_root), latest_listed(spark, bronze_root)))


SNAPSHOT_DATE = "2025_06_16"
LATE_DELIVERIES = (["2025-06-15", "2025-06-16", "2025-06-17", "2025-06-14"], [0.3, 0.3, 0.3, 0.1])


def q_bronze_snapshot(spark, sf):
    _, bronze_root = _deliver_and_accumulate(spark, sf)
    return _r6(bronze.bronze_snapshot(spark, bronze_root, SNAPSHOT_DATE))


def q_bronze_incremental(spark, sf):
    """Two ingestion runs: dates 1-2, then date 3 plus a late delivery."""
    acc = _acc(spark, sf)
    raw_root = scratch_path(spark, "raw")
    bronze_root = scratch_path(spark, "bronze")
    dated = assign_deliveries(acc, P.KEY, *LATE_DELIVERIES)
    first = dated.filter(F.col(BATCH).isin("2025_06_15", "2025_06_16"))
    later = dated.filter(~F.col(BATCH).isin("2025_06_15", "2025_06_16"))
    write_partitioned(first, raw_root)
    r1 = bronze.accumulate(spark, raw_root, bronze_root).withColumn("run", F.lit(1))
    write_partitioned(later, raw_root)
    r2 = bronze.accumulate(spark, raw_root, bronze_root).withColumn("run", F.lit(2))
    sizes = bronze.snapshot_sizes(read_bronze(spark, bronze_root))
    report = r1.unionByName(r2)
    return report.join(sizes.select(BATCH, F.col("snapshot_rows")), BATCH, "left")


def q_bronze_rewrite_idempotent(spark, sf):
    """Deliver, land, accumulate; then land date 2 again from its delivery
    and accumulate twice more: nothing may change."""
    deliveries = _deliver(spark, sf)
    sources = {d: f"{deliveries}/{BATCH}={d}" for d in BATCH_OF_EVENT}
    raw_root = scratch_path(spark, "landed")
    bronze_root = scratch_path(spark, "bronze")
    bronze.land(spark, sources, raw_root)
    bronze.accumulate(spark, raw_root, bronze_root)
    bronze.land(spark, {SNAPSHOT_DATE: sources[SNAPSHOT_DATE]}, raw_root)
    bronze.accumulate(spark, raw_root, bronze_root)
    bronze.accumulate(spark, raw_root, bronze_root)
    return bronze.snapshot_sizes(read_bronze(spark, bronze_root))


def q_bronze_stream(spark, sf):
    raw_root = _deliver(spark, sf)
    bronze_root = scratch_path(spark, "bronze_stream")
    ckpt = scratch_path(spark, "bronze_stream_ckpt")
    run_bronze_stream(spark, raw_root, bronze_root, ckpt)
    table, _ = run_bronze_stream(spark, raw_root, bronze_root, ckpt)  # second run: nothing new
    return bronze.snapshot_sizes(table)


def q_bronze_stream_late(spark, sf):
    """Two stream runs: dates 1-2, then date 3 plus a late delivery; the second
    report with bronze's rows per date."""
    raw_root, bronze_root = scratch_path(spark, "raw"), scratch_path(spark, "bronze_stream")
    ckpt = scratch_path(spark, "bronze_stream_ckpt")
    dated = assign_deliveries(_acc(spark, sf), P.KEY, *LATE_DELIVERIES)
    early = F.col(BATCH).isin("2025_06_15", "2025_06_16")
    write_partitioned(dated.filter(early), raw_root)
    run_bronze_stream(spark, raw_root, bronze_root, ckpt)
    write_partitioned(dated.filter(~early), raw_root)
    table, report = run_bronze_stream(spark, raw_root, bronze_root, ckpt, max_files_per_trigger=1)
    return report.join(table.groupBy(BATCH).agg(F.count(F.lit(1)).alias("rows")), BATCH, "left")


def q_bronze_mixed(spark, sf):
    """Stream, batch and stream again on one bronze root, a date each: rows per
    date, of the snapshot up to it, and which writer wrote them."""
    raw_root, bronze_root = scratch_path(spark, "raw"), scratch_path(spark, "bronze_mixed")
    ckpt = scratch_path(spark, "bronze_mixed_ckpt")
    dated = assign_deliveries(_acc(spark, sf), P.KEY)
    runs = [lambda: run_bronze_stream(spark, raw_root, bronze_root, ckpt, max_files_per_trigger=1),
            lambda: bronze.accumulate(spark, raw_root, bronze_root)]
    for k, date in enumerate(BATCH_OF_EVENT):
        write_partitioned(dated.filter(F.col(BATCH) == date), raw_root)
        runs[k % 2]()
    table = read_bronze(spark, bronze_root, parts=True)
    writers = table.groupBy(BATCH).agg(
        F.when(F.min(PART_COLUMN) == BATCH_PART, F.lit("batch")).otherwise(F.lit("stream")).alias("writer"))
    return bronze.snapshot_sizes(table).join(writers, BATCH)


def q_land_report(spark, sf):
    root = _deliver(spark, sf)
    raw_root = scratch_path(spark, "landed")
    sources = {d: f"{root}/{BATCH}={d}" for d in BATCH_OF_EVENT}
    return bronze.land(spark, sources, raw_root)


def q_split_hash(spark, sf):
    acc = _acc(spark, sf)
    return acc.select("ID", split_label("ID", P.DELIVERY_WEIGHTS, [0, 1, 2]).alias("part"))


def q_split_random(spark, sf):
    parts = split_random(_acc(spark, sf).select("ID"), P.DELIVERY_WEIGHTS, P.SPLIT_SEED)
    whole = union_by_name([p.withColumn("part", F.lit(i)) for i, p in enumerate(parts)])
    return whole.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("ID").alias("ids"),
                     F.count_distinct("part").alias("parts"))


def q_stamp_batch(spark, sf):
    return _r6(stamp(_acc(spark, sf), P.DELIVERY_DATES[0], "situation_date"))


def q_repartition_by_key(spark, sf):
    df = repartition_by_key(_acc(spark, sf), 10, "State")
    return df.groupBy("State").agg(F.count(F.lit(1)).alias("rows"))


def q_repartition_exact(spark, sf):
    """Exactly ten partitions by key: rows per state, and the partitions that
    hold them (one a state)."""
    df = repartition_by_key(_acc(spark, sf), 10, "State", balanced=False)
    return df.withColumn("p", F.spark_partition_id()).groupBy("State").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("p").alias("partitions"),
        (F.max("p") < 10).alias("within_ten"))


def q_row_audit(spark, sf):
    """Rows entering the join table and the weather mart, counted in the
    same passes that write them (no extra count jobs)."""
    raw = _acc(spark, sf)
    counted_raw, raw_obs = row_audit(raw, "raw")
    sj = silver_join(counted_raw)
    counted_sj, sj_obs = row_audit(sj, "silver_join")
    mart = marts.mart_weather(counted_sj)
    counted_mart, mart_obs = row_audit(mart, "mart_weather")
    counted_mart.write.mode("overwrite").parquet(scratch_path(spark, "audit_mart"))
    rows = [("raw", raw_obs.get["rows"]), ("silver_join", sj_obs.get["rows"]),
            ("mart_weather", mart_obs.get["rows"])]
    return spark.createDataFrame(rows, "step string, rows bigint")


# ---------------------------------------------------------------- ML ops

def _ml_table(spark, sf):
    """The ML table, its statistics and indexer labels from one profile job."""
    raw = _acc(spark, sf)
    prof = profile(prepare(raw))
    ml, _ = silver_ml(raw, prof["stats"], indexer_from_labels(prof["labels"]))
    return ml


def q_majority_baseline(spark, sf):
    return _r6(majority_baseline(_ml_table(spark, sf)))


def q_accuracy_metric(spark, sf):
    ml = _ml_table(spark, sf)
    train, test = train_test_split(ml, P.KEY)
    scored = predict_constant(test, majority_class(train))
    return _r6(accuracy_frame(scored))


def q_assemble_features(spark, sf):
    assembled, _ = assemble(_ml_table(spark, sf))
    values = vector_to_array("features")
    return assembled.select("ID", F.size(values).alias("n_features"), F.round(F.aggregate(
        values, F.lit(0.0), lambda a, x: a + F.round(x, 6)), 4).alias("total"))


def _stored_ml(spark, sf):
    """The ML table, written once so that fit and scoring read the same rows."""
    path = scratch_path(spark, "ml")
    _ml_table(spark, sf).write.parquet(path)
    return spark.read.parquet(path)


def _known(df: DataFrame) -> DataFrame:
    """Double columns in comparison form; the class only as whether it is one."""
    flag = F.col(P.PREDICTION_CLASS).between(1, 4).alias("known_class")
    return _r6(df.select(*[F.col(f"`{c}`") for c in df.columns if c != P.PREDICTION_CLASS], flag))


def q_rf_train_metrics(spark, sf):
    """Rows of the test part, trees, and whether the forest is at least as
    accurate there as the majority class of the training part."""
    ml = _stored_ml(spark, sf)
    info = fit_forest(ml)
    train, test = train_test_split(ml, P.KEY)
    base = accuracy_frame(predict_constant(test, majority_class(train)))
    return base.select("rows", F.lit(info["model"].getNumTrees).alias("trees"),
                       (F.lit(info["accuracy"]) >= F.col("accuracy") - 1e-9).alias("beats_majority"))


def q_rf_predict(spark, sf):
    ml = _stored_ml(spark, sf)
    info = fit_forest(ml)
    return _known(forest_predictions(ml, info["model"], info["feature_names"]))


def q_rf_saved_model(spark, sf):
    """A stored forest scores as the one that was fitted: rows by agreement."""
    ml = _stored_ml(spark, sf)
    info = fit_forest(ml, num_trees=10)
    path = scratch_path(spark, "model")
    save_model(info["model"], path)
    direct = forest_predictions(ml, info["model"], info["feature_names"])
    again = forest_predictions(ml, load_model(path), info["feature_names"])
    # partitions by rows: left alone, few partitions of small compressed rows are sorted in one task each
    n = partitions_for(spark, ml.count())
    pairs = direct.select("ID", F.col(P.PREDICTION_CLASS).alias("a")).repartition(n, "ID").join(
        again.select("ID", F.col(P.PREDICTION_CLASS).alias("b")).repartition(n, "ID"), "ID")
    return pairs.groupBy((F.col("a") == F.col("b")).alias("same")).agg(F.count(F.lit(1)).alias("rows"))


# ---------------------------------------------------------------- whole run

def q_marts_incremental(spark, sf):
    """Marts from states: three dates in turn, then the second date replaced by
    its less severe half."""
    dated = assign_deliveries(_gold(spark, sf), P.KEY)
    path = scratch_path(spark, "gold_dated")
    write_partitioned(dated, path)
    gold = spark.read.parquet(path)
    kept = PartialMarts(spark, scratch_path(spark, "mart_states"))
    for date in BATCH_OF_EVENT:
        kept.update(gold, [date])
    kept.update(gold.filter(F.col(P.LABEL) < 3), [SNAPSHOT_DATE])
    weather = kept.mart("dm_weather_accidents")
    severe = kept.mart("dm_grave_accidents_weather").select(
        F.col("Weather_Condition").alias("c"), "nb_grave_accidents")
    return _r6(weather.join(severe, F.col("Weather_Condition").eqNullSafe(F.col("c")), "left").drop("c"))


def q_medallion_gold(spark, sf):
    out = run_medallion(spark, _acc(spark, sf), scratch_path(spark, "medallion"), model="baseline")
    return _r6(out["dm_weather_accidents"])


def q_medallion_full(spark, sf):
    out = run_medallion(spark, _acc(spark, sf), scratch_path(spark, "medallion_full"), model="forest")
    return _known(out["gold"])


def q_medallion_resumed(spark, sf):
    """A resumable run, then the same again: the second run writes nothing and
    its gold is the first one's."""
    root = scratch_path(spark, "medallion_resumed")
    acc = _acc(spark, sf)
    run_medallion(spark, acc, root, model="baseline", resume=True)
    out = run_medallion(spark, acc, root, model="baseline", resume=True)
    gold = mart_counts(out["gold"])
    return gold.withColumn("stages_run", F.lit(len(out["stages_run"]))) \
        .withColumn("stages_kept", F.lit(len(out["stages_kept"])))


def mart_counts(gold):
    return _r6(marts.mart_city(gold).select("City", "State", "total_accidents", "avg_severity"))


def _published(spark, sf):
    """Every mart and the full copy through the parquet publisher."""
    root, path = scratch_path(spark, "marts"), scratch_path(spark, "gold")
    _gold(spark, sf).write.parquet(path)
    report = marts.build_all(spark.read.parquet(path), parquet_publisher(root), full_copy=marts.FULL_COPY)
    return root, report


def q_gold_full_copy(spark, sf):
    root, _ = _published(spark, sf)
    return _r6(spark.read.parquet(f"{root}/{marts.FULL_COPY}"))


def q_publish_report(spark, sf):
    """The report of the published marts, with the rows each holds."""
    root, report = _published(spark, sf)
    rows = [(name, status, error, spark.read.parquet(f"{root}/{name}").count()) for name, status, error in report]
    return spark.createDataFrame(rows, "mart string, status string, error string, rows bigint")


QUERIES = {
    # silver scalar transforms and quality
    "unit_conversions": q_unit_conversions,
    "duration_minutes": q_duration_minutes,
    "wind_clean": q_wind_clean,
    "wind_vector": q_wind_vector,
    "bool_flags": q_bool_flags,
    "daynight_flags": q_daynight_flags,
    "fill_constant": q_fill_constant,
    "default_text": q_default_text,
    "dropna_subset": q_dropna_subset,
    "drop_tolerant": q_drop_tolerant,
    "numeric_columns": q_numeric_columns,
    "impute_mean": q_impute_mean,
    "impute_zero": q_impute_zero,
    "impute_median": q_impute_median,
    "impute_all": q_impute_all,
    "impute_many_valued": q_impute_many_valued,
    "median_extremes": q_median_extremes,
    "null_profile": q_null_profile,
    "null_profile_long": q_null_profile_long,
    "schema_report": q_schema_report,
    "index_frequency": q_index_frequency,
    "index_joined": q_index_joined,
    "index_many_labels": q_index_many_labels,
    "silver_join": q_silver_join,
    "silver_ml": q_silver_ml,
    "silver_stage_join": q_silver_stage_join,
    "silver_stage_ml": q_silver_stage_ml,
    # gold
    "mart_city": q_mart_city,
    "mart_weather": q_mart_weather,
    "mart_infra": q_mart_infra,
    "mart_severe_weather": q_mart_severe_weather,
    "mart_generic": q_mart_generic,
    "enrich_join": q_enrich_join,
    "enrich_join_audit": q_enrich_join_audit,
    "union_by_name": q_union_by_name,
    "preview_topn": q_preview_topn,
    "page_rows": q_page_rows,
    "page_after": q_page_after,
    "page_indexed": q_page_indexed,
    "gold_full_copy": q_gold_full_copy,
    "publish_report": q_publish_report,
    # sources, sinks, ingestion
    "scan_parquet": q_scan_parquet,
    "scan_pushdown": q_scan_pushdown,
    "scan_csv_roundtrip": q_scan_csv_roundtrip,
    "scan_csv_quarantine": q_scan_csv_quarantine,
    "table_roundtrip": q_table_roundtrip,
    "delivery_counts": q_delivery_counts,
    "batch_dates": q_batch_dates,
    "latest_snapshot": q_latest_snapshot,
    "bronze_snapshot": q_bronze_snapshot,
    "bronze_incremental": q_bronze_incremental,
    "bronze_rewrite_idempotent": q_bronze_rewrite_idempotent,
    "bronze_stream": q_bronze_stream,
    "bronze_stream_late": q_bronze_stream_late,
    "bronze_mixed": q_bronze_mixed,
    "land_report": q_land_report,
    "split_hash": q_split_hash,
    "split_random": q_split_random,
    "stamp_batch": q_stamp_batch,
    "repartition_by_key": q_repartition_by_key,
    "repartition_exact": q_repartition_exact,
    "row_audit": q_row_audit,
    "row_audit_committed": q_row_audit_committed,
    # ML
    "majority_baseline": q_majority_baseline,
    "accuracy_metric": q_accuracy_metric,
    "assemble_features": q_assemble_features,
    "rf_train_metrics": q_rf_train_metrics,
    "rf_predict": q_rf_predict,
    "rf_saved_model": q_rf_saved_model,
    # whole run
    "marts_incremental": q_marts_incremental,
    "medallion_gold": q_medallion_gold,
    "medallion_full": q_medallion_full,
    "medallion_resumed": q_medallion_resumed,
}
