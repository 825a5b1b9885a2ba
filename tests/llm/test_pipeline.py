"""The pipeline's stages against brute force, each on its own input."""

import random

import pytest

import corpus_pipeline
from strata.llm import quality_mcd
from tests.llm import helpers as H
from tests.llm.test_quality_and_leaks import ITEM, sentence


def documents():
    rng = random.Random(21)
    rows = [(i, "\n".join(sentence(rng, rng.randrange(20, 35)) for _ in range(4)), "en", f"s{i % 2}") for i in range(90)]
    rows += [(100 + i, rows[i][1], "en", "s0") for i in range(10)]                      # exact copies
    rows += [(120 + i, rows[20 + i][1].replace(".\n", ",\n", 1), "en", "s1") for i in range(5)]  # near copies
    rows += [(130 + i, " ".join(f"{w}###" for w in rows[i][1].split()), "en", "s0") for i in range(4)]  # junk
    rows += [(140, rows[50][1] + "\n" + ITEM, "en", "s0"), (141, rows[51][1], None, None), (142, None, "en", "s1"),
             (143, "", "en", "s1"), (144, "word " * 30000, "en", "s1"), (None, rows[52][1] + " extra", "en", "s0"),
             (5, rows[5][1], "en", "s1")]
    return rows


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """[(name, input rows, output frame)] of a run, stage by stage."""
    root = str(tmp_path_factory.mktemp("sf"))
    H.docs(spark, documents()).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    docs, out = spark.read.parquet(f"{root}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, root).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
        out.append((name, before, docs))
    return root, out


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_names_and_columns(stages):
    _, found = stages
    assert [n for n, _, _ in found] == ["quality_rules", "dedup_lines", "near_duplicates", "decontaminate", "mix_sources"]
    for name, before, after in found[:-1]:
        assert after.columns == before.columns, name
    assert found[-1][2].columns[-1] == "copies"


def test_quality_stage(stages):
    before, after = stages[1][0][1:]
    kept = {r.doc_id for r in quality_mcd.quality_report(before).filter("kept").collect()}
    got = pairs(after)
    assert {i for i, _ in got} == kept
    assert set(range(90)) <= kept and not kept & {130, 131, 132, 133, 142, 143, 144}
    assert [t for i, t in got if i == 5] == [documents()[5][1]] * 2


def test_line_stage(stages):
    before, after = stages[1][1][1:]
    rows = [(i, t) for i, t in pairs(before) if i is not None]
    known = [(i, t) for i, t in pairs(after) if i is not None]
    # the row without an id comes first, so it takes its lines from the others
    null_text = [t for i, t in pairs(before) if i is None]
    want = H.dedup_lines(list(dict(rows).items()) + [(-1, t) for t in null_text])
    assert dict(known) == {i: t for i, t in want.items() if i != -1}
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_near_duplicate_stage(stages):
    before, after = stages[1][2][1:]
    rows = list(dict((i, t) for i, t in pairs(before) if i is not None).items())
    classes = H.jaccard_classes(rows)
    want = {v[0] for k, v in classes.items() if H.words(rows[k][1])}
    blank = [i for i, t in rows if not H.words(t)]
    got = [i for i, _ in pairs(after)]
    assert sorted(i for i in got if i is not None) == sorted(want | ({min(blank)} if blank else set()))


def test_decontamination_stage(stages):
    before, after = stages[1][3][1:]
    gone = {i for i, _ in pairs(before)} - {i for i, _ in pairs(after)}
    assert gone == {i for i, t in pairs(before) if ITEM in (t or "")}


def test_mixing_stage(stages):
    before, after = stages[1][4][1:]
    rows = {i: t for i, t in pairs(before)}
    assert all(rows[r.doc_id] == r.text and r.copies >= 1 for r in after.select("doc_id", "text", "copies").collect())
    tokens = {i: len(H.words(t)) for i, t in rows.items()}
    used = sum(tokens[r.doc_id] * r.copies for r in after.select("doc_id", "copies").collect())
    assert 0.9 * sum(tokens.values()) <= used <= sum(tokens.values())


def test_run_equals_the_stages(spark, stages):
    root, found = stages
    assert sorted(map(str, pairs(corpus_pipeline.run(spark, root)))) == sorted(map(str, pairs(found[-1][2])))


def test_run_over_an_empty_table(spark, tmp_path):
    H.docs(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
