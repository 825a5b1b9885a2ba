"""The whole medallion run: silver -> (forest) -> enrichment -> gold marts.

Scale notes
* Raw is read once, into the converted table; statistics, both silver tables
  and everything after read that table or the wide silver table, each written
  once below `materialize_to`.  The writes also cut the lineage in the shared
  folder, so a lost executor only re-runs the stage it was in.
* One rule for keys: a key that occurs twice in raw raises `DuplicateKeyError`
  before anything is scored, whatever the strategy.
* Enrichment strategies:
  - "fused" (default): both silver tables are columns of one wide table, so
    the gold rows are scored in place.  No join, no shuffle.  Rows the ML
    table would not score (missing feature or label) are dropped, as the inner
    join drops them.
  - "bucketed": silver join table and predictions are written as tables
    bucketed by the key (same bucket count); the sort-merge join then has no
    exchange (the shuffle happens once, at write time, and every later join
    of those tables is free of it).
  - "join": the plain enrichment join; AQE picks the strategy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import presets as P
from strata.operators import marts
from strata.operators.cache import persisted
from strata.operators.features import assemble, seen_categories
from strata.operators.joins import assert_unique, enrich
from strata.operators.model import (accuracy, lay_out, load_model, majority_class, partitions_for, predict_all,
                                    predict_constant, save_model, train_forest, train_test_split)
from strata.plans.resume import NoLog, StageLog, fingerprint, stage_key
from strata.plans.silver import (TWILIGHT_COMPLETE, join_view, majority_from_counts, ml_view, prepare,
                                 profile, silver_wide)
from strata.session import unique_name
from strata.sources.sinks import save_table


def fit_forest(ml_table: DataFrame, key: str = P.KEY, label: str = P.LABEL,
               partitions: int | None = None, **rf_params) -> dict:
    """Train on the hash-split 80 % and measure on the rest: {"model",
    "accuracy", "features", "feature_names"}.

    The features are laid out by key (see `lay_out`), so the forest is the same
    on any number of cores, and stay persisted only while the fit runs.  Only
    key, label and vector are laid out, in partitions of bounded size, and
    nominal columns declare the categories that rows have (`seen_categories`)."""
    table, count = seen_categories(ml_table)
    assembled, features = assemble(table, label)
    slim = assembled.select(*[F.col(f"`{c}`") for c in (key, label, "features")])
    partitions = partitions or partitions_for(ml_table.sparkSession, count)
    with persisted(lay_out(slim, partitions, key)) as rows:
        train, test = train_test_split(rows, key)
        model = train_forest(train, label, **rf_params)
        measured = accuracy(model.transform(test), label)
    return {"model": model, "accuracy": measured, "features": len(features), "feature_names": features}


def forest_predictions(ml_table: DataFrame, model, features: list[str], label: str = P.LABEL) -> DataFrame:
    """Every scorable row's original columns and predicted class."""
    return predict_all(model, assemble(ml_table, label, features)[0], ml_table.columns)


def baseline_predictions(ml_table: DataFrame, label: str = P.LABEL,
                         majority=None) -> DataFrame:
    """Predictions from the majority-class model (deterministic stand-in).
    `majority` may come from `silver.profile` (saves the counting job)."""
    value = majority_class(ml_table, label) if majority is None else majority
    return predict_constant(ml_table, value).withColumn(
        P.PREDICTION_CLASS, F.col("prediction").cast("int")).drop("prediction")


def score_wide(wide: DataFrame, join_columns: list[str], model=None, majority=None,
               features: list[str] | None = None, label: str = P.LABEL) -> DataFrame:
    """Gold rows (silver join table + predicted class) scored in place.

    Equal to `enrich(join_view, predictions(ml_view))`, without the join: the
    ML columns stand in the same rows of the wide table.  `model=None` scores
    with the constant `majority` class instead.
    """
    if model is None:
        scored = wide.withColumn(P.PREDICTION_CLASS, F.lit(majority).cast("int"))
    else:
        scored = predict_all(model, assemble(wide, label, features)[0], wide.columns)
    return scored.filter(F.col(TWILIGHT_COMPLETE)).select(
        *[F.col(f"`{c}`") for c in join_columns], F.col(P.PREDICTION_CLASS))


def _bucketed(df: DataFrame, root: str, name: str, buckets: int, key: str) -> DataFrame:
    table = unique_name(name)
    save_table(df, table, path=f"{root}/{name}", bucket_by=(buckets, key))
    return df.sparkSession.table(table)


def run_medallion(spark: SparkSession, raw: DataFrame, materialize_to: str, model: str = "forest",
                  strategy: str = "fused", buckets: int | None = None, publish=None, resume: bool = False,
                  source: str | None = None, **rf_params) -> dict:
    """Run silver, prediction, enrichment and the four marts below the folder
    `materialize_to`.

    `model="forest"` trains the random forest; `"baseline"` scores with the
    majority class (no ML job).  `strategy` is "fused", "bucketed" or "join"
    (see the module notes).  `publish(name, frame)` writes each mart.  With
    `resume` a run goes on where an earlier one over the same input and
    parameters ended, stage by stage (see `resume`); `source` names the input's
    state, by default the fingerprint of raw's files and plan.  Returns a dict
    of the frames (and the forest's accuracy when trained); with `resume` also
    the stages that ran and those that were kept.
    """
    if strategy not in ("fused", "bucketed", "join"):
        raise ValueError(f"unknown strategy {strategy!r}")
    if buckets is None:
        # the shuffle partition count is what a cluster sizes to its data
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    log = StageLog(spark, materialize_to) if resume else NoLog()
    at = lambda name: f"{materialize_to.rstrip('/')}/{name}"

    def stored(name: str, key: str, build, **payload) -> DataFrame:
        def write():
            build().write.mode("overwrite").parquet(at(name))
            return payload
        log.run(name, key, write)
        return spark.read.parquet(at(name))

    state = source or (fingerprint(raw) if resume else "")
    keys = {"converted": stage_key("converted", [state])}
    converted = stored("converted", keys["converted"], lambda: prepare(raw))

    def measure():
        assert_unique(converted, P.KEY)
        prof = profile(converted)
        for c, labels in prof["labels"].items():
            if isinstance(labels, DataFrame):  # too many for the driver: kept as a table
                labels.write.mode("overwrite").parquet(at(f"labels/{c}"))
                prof["labels"][c] = {"table": at(f"labels/{c}")}
        return prof
    keys["profile"] = stage_key("profile", [keys["converted"]])
    prof = log.run("profile", keys["profile"], measure)
    labels = {c: spark.read.parquet(v["table"]) if isinstance(v, dict) else v for c, v in prof["labels"].items()}

    keys["silver_wide"] = stage_key("silver_wide", [keys["profile"]])
    wide, join_columns, ml_columns = silver_wide(converted, prof["stats"], labels, prepared=True)
    wide = stored("silver_wide", keys["silver_wide"], lambda w=wide: w)
    join_table, ml_table = join_view(wide, join_columns), ml_view(wide, ml_columns)
    out = {"stats": prof["stats"], "silver_join": join_table, "silver_ml": ml_table}
    majority = None
    if model == "forest":
        keys["model"] = stage_key("forest", [keys["silver_wide"]], **rf_params)

        def fit():
            info = fit_forest(ml_table, **rf_params)
            out["model"] = info.pop("model")
            if resume:
                save_model(out["model"], at("forest"))
            return info
        out.update(log.run("forest", keys["model"], fit))
        if "model" not in out:
            out["model"] = load_model(at("forest"))
        preds = forest_predictions(ml_table, out["model"], out["feature_names"])
    else:
        majority = majority_from_counts(prof["class_counts"])
        keys["model"] = stage_key("baseline", [keys["silver_wide"]], majority=majority)
        preds = baseline_predictions(ml_table, majority=majority)

    def enriched() -> DataFrame:
        if strategy == "fused":
            return score_wide(wide, join_columns, out.get("model"), majority, out.get("feature_names"))
        left, right = join_table, preds.select(P.KEY, P.PREDICTION_CLASS)
        if strategy == "bucketed":
            left = _bucketed(left, materialize_to, "silver_join", buckets, P.KEY)
            right = _bucketed(right, materialize_to, "predictions", buckets, P.KEY)
        # raw's keys are known to be unique, and so are those derived from them
        return enrich(left, right, P.KEY, [P.PREDICTION_CLASS], check_unique=False)
    keys["gold"] = stage_key("gold", [keys["model"]], strategy=strategy)
    out["gold"] = stored("gold", keys["gold"], enriched)
    out["predictions"] = preds
    for name, fn in marts.MARTS.items():
        out[name] = fn(out["gold"])
    if publish is not None:
        def publish_once(name: str, frame: DataFrame) -> None:
            log.run(f"publish {name}", stage_key(name, [keys["gold"]]), lambda: publish(name, frame))
        out["publish_report"] = marts.build_all(out["gold"], publish_once, full_copy=marts.FULL_COPY)
    if resume:
        out["stages_run"], out["stages_kept"] = log.ran, log.kept
    return out
