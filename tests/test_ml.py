"""Indexing, assembly, forest, metrics."""

from strata.operators.features import assemble, index_categoricals
from strata.operators.model import (accuracy, accuracy_frame, majority_baseline, predict_all,
                                    predict_constant, train_forest, train_test_split)
from tests.conftest import rows


def test_frequency_index_ties_and_unseen(spark):
    df = spark.createDataFrame([(v,) for v in ["c", "c", "a", "b", ""]], "State string")
    out, model = index_categoricals(df, ["State"], fill={}, drop_sources=False)
    got = dict(rows(out, "State", "State_index"))
    assert got == {"c": 0.0, "": 1.0, "a": 2.0, "b": 3.0}
    unseen = spark.createDataFrame([("zz",), (None,)], "State string")
    out2, _ = index_categoricals(unseen, ["State"], fill={}, model=model, drop_sources=False)
    assert [r[0] for r in out2.select("State_index").collect()] == [4.0, 4.0]


def test_null_filled_before_indexing(spark):
    df = spark.createDataFrame([("x",), (None,), (None,)], "Timezone string")
    out, _ = index_categoricals(df, ["Timezone"])
    assert out.columns == ["Timezone_index"]
    assert sorted(r[0] for r in out.collect()) == [0.0, 0.0, 1.0]


def _frame(spark, n=400):
    data = [(f"A-{i}", 1 + (i % 3 == 0) + (i % 7 == 0), float(i % 3), float(i % 7), i % 2)
            for i in range(n)]
    return spark.createDataFrame(data, "ID string, Severity int, a double, b double, c int")


def test_assemble_drops_incomplete_rows(spark):
    df = _frame(spark).union(spark.createDataFrame([("X", 1, None, 1.0, 1)], _frame(spark).schema))
    assembled, feats = assemble(df)
    assert feats == ["a", "b", "c"]
    assert assembled.count() == 400


def test_forest_learns_and_scores_every_row(spark):
    df = _frame(spark)
    assembled, _ = assemble(df)
    train, test = train_test_split(assembled, "ID")
    model = train_forest(train, num_trees=5, max_bins=32)
    preds = predict_all(model, assembled, df.columns)
    assert preds.columns == [*df.columns, "prediction_classe"]
    assert preds.count() == 400
    acc = accuracy(model.transform(test))
    base = rows(majority_baseline(df), "majority_share")[0][0]
    assert acc >= base


def test_accuracy_forms_agree(spark):
    df = _frame(spark)
    scored = predict_constant(df, 1)
    rel = rows(accuracy_frame(scored), "accuracy")[0][0]
    assert abs(rel - accuracy(scored)) < 1e-12
    assert rows(majority_baseline(df), "majority_class")[0][0] == 1


def test_profile_indexer_equals_fitted_indexer(spark):
    from strata.operators.features import fit_indexer
    from strata.plans.silver import indexer_from_labels, majority_from_counts, profile
    df = spark.createDataFrame(
        [(v, w, s, float(i)) for i, (v, w, s) in enumerate(
            [("c", "x", 1), ("c", None, 2), ("a", "x", 2), ("b", "y", 3), ("", "y", 3),
             (None, "z", 3)])],
        "State string, Timezone string, Severity int, `Wind_Chill(C)` double")
    prof = profile(df, mean=[], median=["Wind_Chill(C)"], categorical=["State", "Timezone"],
                   fill={"Timezone": "UNKNOWN"})
    assert prof["labels"]["State"] == ["c", "", "a", "b"]
    fitted = fit_indexer(df.fillna({"Timezone": "UNKNOWN"}), ["State", "Timezone"]).stages[0]
    built = indexer_from_labels(prof["labels"])
    assert [m.labels for m in built.stages] == fitted.labelsArray
    # unseen and null go to the per-column "keep" index; metadata has no nulls
    probe = spark.createDataFrame([("zz", "x"), (None, None)], "State string, Timezone string")
    out = built.transform(probe)
    assert [tuple(r) for r in out.select("State_index", "Timezone_index").collect()] == [
        (4.0, 0.0), (4.0, 4.0)]
    vals = out.schema["Timezone_index"].metadata["ml_attr"]["vals"]
    assert None not in vals
    assert majority_from_counts(prof["class_counts"]) == 3
    assert prof["stats"]["median::Wind_Chill(C)"] == 2.0


def test_laid_out_forest_is_the_same_on_any_core_count(tmp):
    """The layout follows keys and partition count alone, so sessions with
    other core counts and input splits grow the same forest."""
    import json
    import os
    import subprocess
    import sys
    code = """
import json, sys
from strata.session import build_session
from strata.operators.features import assemble
from strata.operators.model import lay_out, predict_all, train_forest
n = int(sys.argv[1])
spark = build_session(master=f"local[{n}]", conf={"spark.sql.shuffle.partitions": "6", "spark.default.parallelism": str(n)})
rows = [(f"A-{i}", 1 + (i * 7 % 11 > 5) + (i % 7 == 0), float(i * 13 % 17), float(i * 5 % 23), i % 3) for i in range(600)]
df = spark.createDataFrame(rows, "ID string, Severity int, a double, b double, c int").repartition(n + 1)
made, _ = assemble(df)
model = train_forest(lay_out(made), num_trees=5, max_bins=32)
out = sorted((r.ID, r.prediction_classe) for r in predict_all(model, made, ["ID"]).collect())
print("OUT", json.dumps(out))
"""
    got = set()
    for n in (2, 4, 8):
        run = subprocess.run([sys.executable, "-c", code, str(n)], capture_output=True, text=True, timeout=300,
                             cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        got.add(next(x for x in run.stdout.splitlines() if x.startswith("OUT")))
    assert len(got) == 1 and len(json.loads(got.pop()[4:])) == 600


def test_profile_with_many_labels(spark):
    import pytest

    from strata.plans.silver import indexer_from_labels, profile
    df = spark.range(3000).selectExpr("concat('l', id % 300) AS State", "concat('c', id % 7) AS City",
                                      "cast(id % 4 AS int) AS Severity")
    prof = profile(df, categorical=["State", "City"], fill={})
    assert len(prof["labels"]["State"]) == 300
    # beyond the bound the labels stay in a table and the indices are the same
    wide = profile(df, categorical=["State", "City"], fill={}, max_labels=200)
    assert wide["labels"]["State"].count() == 300 and wide["labels"]["City"] == prof["labels"]["City"]
    assert wide["class_counts"] == prof["class_counts"]
    both = [sorted(map(tuple, indexer_from_labels(p["labels"]).transform(df).select(
        "State", "City", "State_index", "City_index").collect())) for p in (prof, wide)]
    assert both[0] == both[1]
    with pytest.raises(ValueError, match="classes"):
        profile(df, categorical=[], fill={}, max_labels=3)


def test_null_class_is_no_class(spark):
    from strata.plans.silver import majority_from_counts, profile
    df = spark.createDataFrame([(None,), (None,), (2,)], "Severity int")
    assert majority_from_counts(profile(df, mean=[], median=[], categorical=[])["class_counts"]) == 2


def test_median_of_many_values_is_exact(spark):
    import random
    import statistics

    from strata.operators.nulls import imputation_stats
    rng = random.Random(7)
    for n in (1, 2, 9, 5000, 20001):
        values = [rng.gauss(0, 1) * 10 ** rng.randrange(-3, 6) for _ in range(n)] + [3.0] * (n // 3)
        df = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "x double")
        assert imputation_stats(df, [], ["x"])["median::x"] == statistics.median_low(values)
    assert imputation_stats(spark.createDataFrame([(None,)], "x double"), [], ["x"])["median::x"] is None


def test_stored_model_scores_alike(spark, tmp):
    from strata.operators.model import load_model, save_model
    made, _ = assemble(_frame(spark))
    model = train_forest(made, num_trees=3, max_bins=32)
    save_model(model, f"{tmp}/m")
    save_model(model, f"{tmp}/m")  # replaces
    a, b = (sorted(rows(predict_all(m, made, ["ID"]))) for m in (model, load_model(f"{tmp}/m")))
    assert a == b


def test_forest_is_fitted_on_what_it_needs(spark, monkeypatch):
    """Only key, label and vector are laid out, in partitions of bounded size;
    a category no row has makes no candidate groupings."""
    from strata.operators import model
    from strata.plans import medallion
    words = ["a", "b", "c", "d"]
    df = spark.createDataFrame([(f"A-{i}", 1 + (words[i * 7 % 4] in "ac"), words[i * 7 % 4], float(i % 9), "text")
                                for i in range(400)], "ID string, Severity int, State string, x double, note string")
    ml, _ = index_categoricals(df, ["State"], fill={})
    assert len(ml.schema["State_index"].metadata["ml_attr"]["vals"]) == 5  # one for unseen labels
    given = []
    monkeypatch.setattr(medallion, "train_forest", lambda train, *a, **k: given.append(train) or train_forest(train, *a, **k))
    monkeypatch.setattr(model, "PARTITION_ROWS", 40, raising=False)
    info = medallion.fit_forest(ml, num_trees=5)
    assert given[0].columns == ["ID", "Severity", "features"]
    assert given[0].rdd.getNumPartitions() == 10
    attrs = given[0].schema["features"].metadata["ml_attr"]["attrs"]["nominal"]
    assert [len(a["vals"]) for a in attrs] == [4]
    assert info["accuracy"] == 1.0 and info["feature_names"] == ["x", "State_index"]
    # rows with the category for unseen labels keep it
    unseen = spark.createDataFrame([("B-1", 2, 4.0, 1.0)], "ID string, Severity int, State_index double, x double")
    both = ml.select("ID", "Severity", "State_index", "x").union(unseen)
    medallion.fit_forest(both, num_trees=2)
    assert [len(a["vals"]) for a in given[1].schema["features"].metadata["ml_attr"]["attrs"]["nominal"]] == [5]
    scored = medallion.forest_predictions(both, info["model"], ["x", "State_index"])
    assert scored.count() == 401
