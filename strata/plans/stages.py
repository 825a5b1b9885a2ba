"""The pipeline as separately runnable stages over one lake root.

Layout under `root` (a shared folder, e.g. below `spark.checkpoint.dir` or
an object-store prefix):

    deliveries/   dated deliveries (batch_date partitions) [+ deliveries_csv/]
    raw/          landed raw batches (batch_date partitions)
    bronze/       append-only accumulation (batch_date partitions)
    silver/wide/  both silver tables in one physical table (one write pass);
                  the join table and the ML table are a filter/projection of it
    silver/columns/  their column lists (one row)
    model/forest/ the fitted forest, and model/features/ its columns
    gold/predictions/  ID + prediction_classe
    gold/final/   enriched table (marts and serving read it)
    marts/<name>/ published marts (+ the full copy)
    pages/<name>/ position index of the full copy (paged reads)

Every stage reads the previous stage's parquet and writes its own, so a
stage can be re-run alone; writes are overwrites (per partition for the
dated layers), hence idempotent.  `run_all(resume=True)` keeps the stages that
ended over the same input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import presets as P
from strata.operators import marts
from strata.operators.joins import enrich
from strata.operators.model import load_model, save_model
from strata.operators.serve import PageIndex, build_page_index, page
from strata.plans import bronze
from strata.plans.resume import NoLog, StageLog, fingerprint, stage_key
from strata.plans.medallion import baseline_predictions, fit_forest, forest_predictions
from strata.plans.silver import join_view, ml_view, prepare, profile, silver_wide
from strata.sources.batches import partition_values, path_exists
from strata.sources.sinks import parquet_publisher


def paths(root: str) -> dict:
    r = root.rstrip("/")
    return {
        "deliveries": f"{r}/deliveries", "deliveries_csv": f"{r}/deliveries_csv",
        "raw": f"{r}/raw", "bronze": f"{r}/bronze",
        "silver_wide": f"{r}/silver/wide", "silver_columns": f"{r}/silver/columns",
        "model": f"{r}/model/forest", "features": f"{r}/model/features",
        "predictions": f"{r}/gold/predictions", "gold": f"{r}/gold/final",
        "marts": f"{r}/marts", "pages": f"{r}/pages",
    }


def stage_deliver(spark: SparkSession, source: DataFrame, root: str, key: str = P.KEY,
                  csv_copy: bool = True) -> DataFrame:
    """Split a source table into dated deliveries (hash split by key)."""
    p = paths(root)
    return bronze.write_deliveries(source, p["deliveries"], key,
                                   csv_root=p["deliveries_csv"] if csv_copy else None)


def stage_land(spark: SparkSession, root: str, dates: list[str] | None = None) -> DataFrame:
    """Land the delivery dates that raw lacks (or the given `dates`, again);
    a failing date is reported, not fatal."""
    p = paths(root)
    if dates is None:
        landed = set(partition_values(spark, p["raw"]))
        dates = [d for d in partition_values(spark, p["deliveries"]) if d is not None and d not in landed]
    sources = {d: f"{p['deliveries']}/{P.BATCH_COLUMN}={d}" for d in dates}
    return bronze.land(spark, sources, p["raw"])


def stage_bronze(spark: SparkSession, root: str) -> DataFrame:
    """Append raw dates newer than bronze's high-water mark."""
    p = paths(root)
    return bronze.accumulate(spark, p["raw"], p["bronze"])


def stage_silver(spark: SparkSession, root: str, date: str | None = None) -> dict:
    """Both silver tables from the bronze snapshot as of `date` (latest).

    One statistics job (`profile`) and one write: the two tables share the
    converted and imputed measures, so they are stored as one wide table and
    read back as a filter (join table) or a projection (ML table); parquet
    column pruning then reads only each table's columns.
    """
    p = paths(root)
    # the latest snapshot is every row: no max-date job, no filter
    snap = bronze.bronze_snapshot(spark, p["bronze"], date).drop(P.BATCH_COLUMN)
    prof = profile(prepare(snap))  # statistics + indexer labels in one job
    wide, join_cols, ml_cols = silver_wide(snap, prof["stats"], prof["labels"])
    wide.write.mode("overwrite").parquet(p["silver_wide"])
    spark.createDataFrame([(join_cols, ml_cols)],
                          "join_columns array<string>, ml_columns array<string>") \
        .write.mode("overwrite").parquet(p["silver_columns"])
    return prof["stats"]


def read_silver(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The silver `"join"` or `"ml"` table of a lake root."""
    p = paths(root)
    cols = spark.read.parquet(p["silver_columns"]).first()
    wide = spark.read.parquet(p["silver_wide"])
    if table == "join":
        return join_view(wide, list(cols["join_columns"]))
    if table == "ml":
        return ml_view(wide, list(cols["ml_columns"]))
    raise ValueError(f"unknown silver table {table!r}")


def stage_predict(spark: SparkSession, root: str, model: str = "forest", **rf_params) -> dict:
    """Score every ML row: `"forest"` fits and stores a forest, `"stored"`
    scores with the stored one (a new batch without a refit), `"baseline"` is
    the majority class."""
    p = paths(root)
    ml = read_silver(spark, root, "ml")
    info: dict = {}
    if model == "forest":
        info = fit_forest(ml, **rf_params)
        save_model(info["model"], p["model"])
        spark.createDataFrame([(info["feature_names"],)], "names array<string>") \
            .write.mode("overwrite").parquet(p["features"])
        preds = forest_predictions(ml, info["model"], info["feature_names"])
    elif model == "stored":
        features = list(spark.read.parquet(p["features"]).first()["names"])
        preds = forest_predictions(ml, load_model(p["model"]), features)
    else:
        preds = baseline_predictions(ml)
    preds.write.mode("overwrite").parquet(p["predictions"])
    return info


def stage_enrich(spark: SparkSession, root: str, check_unique: bool = True) -> None:
    """Join the predicted class onto the silver join table; write gold."""
    p = paths(root)
    gold = enrich(read_silver(spark, root, "join"), spark.read.parquet(p["predictions"]),
                  P.KEY, [P.PREDICTION_CLASS], check_unique=check_unique)
    gold.write.mode("overwrite").parquet(p["gold"])


def stage_marts(spark: SparkSession, root: str, publish=None) -> list[tuple]:
    """Build and publish the marts and the full copy (parquet by default)."""
    p = paths(root)
    publish = publish or parquet_publisher(p["marts"])
    return marts.build_all(spark.read.parquet(p["gold"]), publish, full_copy=marts.FULL_COPY)


def stage_index(spark: SparkSession, root: str, table: str = marts.FULL_COPY) -> int:
    """The position index of a published table; returns its rows."""
    p = paths(root)
    return build_page_index(spark.read.parquet(f"{p['marts']}/{table}"), f"{p['pages']}/{table}").size()


def stage_page(spark: SparkSession, root: str, offset: int = 0, limit: int = 1,
               table: str = marts.FULL_COPY) -> DataFrame:
    """A page of the published full copy, in key order: from its position index
    if there is one, else by sorting."""
    p = paths(root)
    if path_exists(spark, f"{p['pages']}/{table}/starts/_SUCCESS"):
        return PageIndex(spark, f"{p['pages']}/{table}").page(offset, limit)
    return page(spark.read.parquet(f"{p['marts']}/{table}"), offset, limit)


def run_all(spark: SparkSession, source: DataFrame, root: str, model: str = "forest", resume: bool = False,
            state: str | None = None, **rf_params) -> dict:
    """Every stage in order; returns the reports of each.

    With `resume`, stages that ended over the same input and parameters are
    kept (landing and bronze add only what is new in any case); `state` names
    the source's state, by default the fingerprint of its files and plan."""
    log = StageLog(spark, root) if resume else NoLog()
    p = paths(root)
    listed = lambda df: [r.asDict() for r in df.collect()]
    key = stage_key("deliver", [state or (fingerprint(source) if resume else "")])
    out = {"deliveries": log.run("deliver", key, lambda: {"rows": listed(stage_deliver(spark, source, root))})["rows"]}
    out["land"] = listed(stage_land(spark, root))
    out["bronze"] = listed(stage_bronze(spark, root))
    key = stage_key("silver", [fingerprint(spark.read.parquet(p["bronze"])) if resume else ""])
    out["stats"] = log.run("silver", key, lambda: stage_silver(spark, root))
    key = stage_key("predict", [key], model=model, **rf_params)
    out["predict"] = log.run("predict", key, lambda: {
        k: v for k, v in stage_predict(spark, root, model, **rf_params).items() if k != "model"})
    key = stage_key("enrich", [key])
    log.run("enrich", key, lambda: stage_enrich(spark, root))
    key = stage_key("marts", [key])
    out["marts"] = [tuple(r) for r in log.run("marts", key, lambda: {"report": stage_marts(spark, root)})["report"]]
    out["paged_rows"] = log.run("index", stage_key("index", [key]), lambda: {"rows": stage_index(spark, root)})["rows"]
    out["gold_rows"] = spark.read.parquet(p["gold"]).agg(F.count(F.lit(1))).first()[0]
    if resume:
        out["stages_run"], out["stages_kept"] = log.ran, log.kept
    return out
