"""Runs that go on where an earlier one ended."""

import os

import pytest
from pyspark.sql import functions as F

from strata.fixture import accidents
from strata.operators import marts
from strata.plans import stages
from strata.plans.medallion import run_medallion
from strata.plans.resume import StageLog, fingerprint
from strata.sources.sinks import parquet_publisher
from tests.conftest import SMOKE, rows


def _killed_at(monkeypatch, n):
    """The n-th record of a run cannot be written."""
    real, calls = StageLog._add, []

    def add(self, *args):
        calls.append(args)
        if len(calls) == n:
            raise KeyboardInterrupt
        real(self, *args)
    monkeypatch.setattr(StageLog, "_add", add)


STAGES = ["converted", "profile", "silver_wide", "forest", "gold"] + [
    f"publish {m}" for m in [*marts.MARTS, marts.FULL_COPY]]


def _run(spark, root, **kw):
    return run_medallion(spark, accidents(spark, SMOKE), f"{root}/m", publish=parquet_publisher(f"{root}/out"),
                         resume=True, num_trees=3, **kw)


@pytest.fixture(scope="module")
def clean(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("clean"))
    out = _run(spark, root)
    assert out["stages_run"] == STAGES and out["stages_kept"] == []
    return sorted(rows(spark.read.parquet(f"{root}/out/{marts.FULL_COPY}")), key=str)


@pytest.mark.parametrize("n", [5, 8, 13])
def test_a_killed_run_goes_on(spark, tmp, monkeypatch, clean, n):
    with monkeypatch.context() as m:
        _killed_at(m, n)  # records come in pairs: begun, ended
        with pytest.raises(KeyboardInterrupt):
            _run(spark, tmp)
    out = _run(spark, tmp)
    done = (n - 1) // 2
    assert out["stages_kept"] == STAGES[:done] and out["stages_run"] == STAGES[done:]
    assert {s for _, s, _ in out["publish_report"]} == {"ok"}
    assert sorted(rows(spark.read.parquet(f"{tmp}/out/{marts.FULL_COPY}")), key=str) == clean
    assert out["accuracy"] > 0 and out["model"].getNumTrees == 3


def test_kept_stages_write_nothing(spark, tmp):
    _run(spark, tmp)
    stamp = lambda: {os.path.join(d, f): os.path.getmtime(os.path.join(d, f))
                     for d, _, fs in os.walk(tmp) for f in fs}
    before = stamp()
    out = _run(spark, tmp)
    assert out["stages_run"] == [] and out["stages_kept"] == STAGES and stamp() == before


def test_parameters_and_input_change_what_follows(spark, tmp):
    src = f"{tmp}/src"
    accidents(spark, SMOKE).write.parquet(src)
    go = lambda **kw: run_medallion(spark, spark.read.parquet(src), f"{tmp}/m", resume=True, **kw)
    assert go(model="baseline")["stages_kept"] == []
    other = go(model="baseline", strategy="join")
    assert other["stages_run"] == ["gold"] and other["stages_kept"] == ["converted", "profile", "silver_wide"]
    more = spark.read.parquet(src).limit(300).withColumn("ID", F.concat(F.lit("B"), "ID"))
    more.write.parquet(f"{tmp}/more")
    spark.read.parquet(f"{tmp}/more").write.mode("append").parquet(src)
    again = go(model="baseline", strategy="join")
    assert again["stages_kept"] == [] and again["silver_ml"].count() == 1300


def test_a_frame_without_files_needs_a_name(spark, tmp):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError, match="fingerprint"):
        fingerprint(df)


def test_fingerprints(spark, tmp):
    spark.range(10).write.parquet(f"{tmp}/a")
    a = lambda: spark.read.parquet(f"{tmp}/a")
    assert fingerprint(a()) == fingerprint(a())
    assert fingerprint(a()) != fingerprint(a().filter("id > 3"))
    assert fingerprint(a().filter("id > 4")) != fingerprint(a().filter("id > 3"))
    before = fingerprint(a())
    spark.range(1).write.mode("append").parquet(f"{tmp}/a")
    assert fingerprint(a()) != before
    assert fingerprint(accidents(spark, SMOKE)) == fingerprint(accidents(spark, SMOKE))


def test_half_written_records_do_not_count(spark, tmp):
    log = StageLog(spark, tmp)
    assert log.run("a", "k", lambda: {"x": 1}) == {"x": 1}
    os.makedirs(f"{tmp}/_stages/0000000003")  # a record that was never committed
    again = StageLog(spark, tmp)
    assert again.run("a", "k", lambda: {"x": 2}) == {"x": 1} and again.kept == ["a"]
    assert again.run("a", "k2", lambda: {"x": 3}) == {"x": 3}
    assert StageLog(spark, tmp).run("a", "k2", lambda: {"x": 4}) == {"x": 3}


def test_the_lake_run_resumes(spark, tmp, monkeypatch):
    src = accidents(spark, SMOKE)
    with monkeypatch.context() as m:
        m.setattr(stages, "stage_enrich", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            stages.run_all(spark, src, f"{tmp}/lake", "baseline", resume=True)
    out = stages.run_all(spark, src, f"{tmp}/lake", "baseline", resume=True)
    assert out["stages_kept"] == ["deliver", "silver", "predict"]
    assert out["stages_run"] == ["enrich", "marts", "index"]
    whole = stages.run_all(spark, src, f"{tmp}/clean", "baseline")
    assert {k: v for k, v in whole.items() if k not in ("land", "bronze")} == {
        k: v for k, v in out.items() if k not in ("land", "bronze", "stages_run", "stages_kept")}
    gold = [sorted(rows(spark.read.parquet(stages.paths(f"{tmp}/{r}")["gold"])), key=str) for r in ("lake", "clean")]
    assert gold[0] == gold[1]
    page = stages.stage_page(spark, f"{tmp}/lake", 5, 3)
    assert len(page.inputFiles()) <= 2 and page.count() == 3
