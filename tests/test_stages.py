"""The stages end to end over one lake root, as the original scripts ran."""

from strata import presets as P
from strata.cli import parse_args, run
from strata.fixture import accidents
from strata.plans import stages
from strata.queries import q_mart_weather
from strata.sources.sinks import write_csv
from tests.conftest import SMOKE, rows


def test_stages_end_to_end(spark, tmp):
    source_csv = f"{tmp}/source_csv"
    write_csv(accidents(spark, SMOKE), source_csv, null_value="")
    root = f"{tmp}/lake"
    source = run(spark, parse_args(["deliver", "--root", root, "--csv", source_csv]))
    assert sum(r["rows"] for r in source) == 1000
    landed = run(spark, parse_args(["land", "--root", root]))
    assert [r["status"] for r in landed] == ["landed"] * 3
    first = run(spark, parse_args(["bronze", "--root", root]))
    assert {r["status"] for r in first} == {"ingested"}
    again = run(spark, parse_args(["bronze", "--root", root]))
    assert {r["status"] for r in again} == {"present"}
    stats = run(spark, parse_args(["silver", "--root", root]))
    assert set(stats) == {f"mean::{c}" for c in P.IMPUTE_MEAN} | {f"median::{c}" for c in
                                                                    P.IMPUTE_MEDIAN}
    run(spark, parse_args(["predict", "--root", root, "--model", "baseline"]))
    run(spark, parse_args(["enrich", "--root", root]))
    report = run(spark, parse_args(["marts", "--root", root]))
    assert [s for _, s, _ in report] == ["ok"] * 5
    page = run(spark, parse_args(["page", "--root", root, "--offset", "2", "--limit", "3"]))
    assert len(page) == 3 and [r["ID"] for r in page] == sorted(r["ID"] for r in page)
    # the published weather mart equals the registered query on the same tables
    p = stages.paths(root)
    published = spark.read.parquet(f"{p['marts']}/dm_weather_accidents")
    from strata.queries import _r6
    assert sorted(rows(_r6(published)), key=str) == sorted(rows(q_mart_weather(spark, SMOKE)),
                                                           key=str)


def test_forest_stage(spark, tmp):
    root = f"{tmp}/lake"
    stages.stage_deliver(spark, accidents(spark, SMOKE), root, csv_copy=False)
    stages.stage_land(spark, root)
    stages.stage_bronze(spark, root)
    stages.stage_silver(spark, root)
    info = stages.stage_predict(spark, root, "forest", num_trees=5)
    assert 0.0 <= info["accuracy"] <= 1.0 and info["features"] == 32
    preds = spark.read.parquet(stages.paths(root)["predictions"])
    assert preds.count() == 1000
    assert preds.columns[-1] == P.PREDICTION_CLASS


def test_fused_gold_equals_enrichment_join(spark):
    from strata.operators.joins import enrich
    from strata.plans.medallion import baseline_predictions, fit_forest, forest_predictions, score_wide
    from strata.plans.silver import (indexer_from_labels, majority_from_counts, prepare, profile,
                                     silver_join, silver_ml, silver_wide)
    from tests.test_plans import plan
    raw = accidents(spark, SMOKE)
    prof = profile(prepare(raw))
    stats, labels = prof["stats"], prof["labels"]
    sj = silver_join(raw, stats)
    ml, _ = silver_ml(raw, stats, indexer_from_labels(labels))
    info = fit_forest(ml, num_trees=5)
    preds = forest_predictions(ml, info["model"], info["feature_names"])
    joined = enrich(sj, preds.select(P.KEY, P.PREDICTION_CLASS), P.KEY, [P.PREDICTION_CLASS])
    wide, columns, _ = silver_wide(raw, stats, labels)
    fused = score_wide(wide, columns, info["model"], None, info["feature_names"])
    assert fused.columns == joined.columns
    assert sorted(rows(fused), key=str) == sorted(rows(joined), key=str)
    # one read of each base table (the view's own joins); the joined form reads
    # them once per silver branch and adds the join on ID
    def scans(df):
        return plan(df).split("== Initial Plan ==")[0].count("FileScan parquet")
    assert scans(fused) == 3
    assert scans(joined) > scans(fused)
    majority = majority_from_counts(prof["class_counts"])
    base_joined = enrich(sj, baseline_predictions(ml, majority=majority), P.KEY,
                         [P.PREDICTION_CLASS])
    base_fused = score_wide(wide, columns, majority=majority)
    assert sorted(rows(base_fused), key=str) == sorted(rows(base_joined), key=str)


def test_medallion_strategies_agree(spark, tmp):
    from strata.plans.medallion import run_medallion
    from strata.queries import _r6
    raw = accidents(spark, SMOKE)
    results = {}
    for strategy in ("fused", "bucketed", "join"):
        out = run_medallion(spark, raw, f"{tmp}/{strategy}", model="baseline", strategy=strategy, buckets=4)
        results[strategy] = {name: sorted(rows(_r6(out[name])), key=str)
                             for name in ("dm_accidents_by_city", "dm_weather_accidents",
                                          "dm_accidents_by_infra", "dm_grave_accidents_weather")}
    assert results["fused"] == results["bucketed"] == results["join"]


def test_medallion_refuses_repeated_keys(spark, tmp):
    import pytest

    from strata.operators.joins import DuplicateKeyError
    from strata.plans.medallion import run_medallion
    raw = accidents(spark, SMOKE)
    refed = raw.union(raw.limit(3))
    for strategy in ("fused", "bucketed", "join"):
        with pytest.raises(DuplicateKeyError):
            run_medallion(spark, refed, f"{tmp}/{strategy}", model="baseline", strategy=strategy, buckets=4)


def test_only_new_dates_land_and_a_stored_forest_scores(spark, tmp):
    root = f"{tmp}/lake"
    stages.stage_deliver(spark, accidents(spark, SMOKE), root, csv_copy=False)
    assert stages.stage_land(spark, root).count() == 3
    assert stages.stage_land(spark, root).count() == 0
    assert stages.stage_land(spark, root, ["2025_06_16"]).count() == 1
    stages.stage_bronze(spark, root)
    stages.stage_silver(spark, root)
    stages.stage_predict(spark, root, "forest", num_trees=3)
    path = stages.paths(root)["predictions"]
    first = sorted(rows(spark.read.parquet(path).select(P.KEY, P.PREDICTION_CLASS)))
    assert stages.stage_predict(spark, root, "stored") == {}
    assert sorted(rows(spark.read.parquet(path).select(P.KEY, P.PREDICTION_CLASS))) == first


def test_cli_arguments():
    args = parse_args(["page", "--root", "/lake", "--offset", "5", "--limit", "2",
                       "--conf", "spark.sql.shuffle.partitions=64"])
    assert (args.stage, args.root, args.offset, args.limit) == ("page", "/lake", 5, 2)
    assert dict(c.split("=", 1) for c in args.conf) == {"spark.sql.shuffle.partitions": "64"}
    defaults = parse_args(["page", "--root", "/lake"])
    assert (defaults.offset, defaults.limit, defaults.model) == (0, 1, "forest")


def test_wide_silver_views_equal_the_two_tables(spark):
    from strata.plans.silver import (indexer_from_labels, join_view, ml_view, prepare, profile,
                                     silver_join, silver_ml, silver_wide)
    raw = accidents(spark, SMOKE)
    prof = profile(prepare(raw))
    wide, jc, mc = silver_wide(raw, prof["stats"], prof["labels"])
    sj = silver_join(raw, prof["stats"])
    ml, _ = silver_ml(raw, prof["stats"], indexer_from_labels(prof["labels"]))
    a, b = join_view(wide, jc), ml_view(wide, mc)
    assert a.columns == sj.columns and b.columns == ml.columns
    assert sorted(rows(a), key=str) == sorted(rows(sj), key=str)
    assert sorted(rows(b), key=str) == sorted(rows(ml), key=str)


def test_ml_view_keeps_nominal_metadata_through_parquet(spark, tmp):
    root = f"{tmp}/lake"
    stages.stage_deliver(spark, accidents(spark, SMOKE), root, csv_copy=False)
    stages.stage_land(spark, root)
    stages.stage_bronze(spark, root)
    stages.stage_silver(spark, root)
    ml = stages.read_silver(spark, root, "ml")
    for c in P.INDEX_COLUMNS:
        attr = ml.schema[c + P.INDEX_SUFFIX].metadata["ml_attr"]
        assert attr["type"] == "nominal" and None not in attr["vals"]
    assert len(ml.columns) == 34
    assert stages.read_silver(spark, root, "join").count() == 981
