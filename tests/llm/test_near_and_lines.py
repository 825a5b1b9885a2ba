"""Operators 1, 6: similarity join and line dedup against brute force."""

import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from strata.llm import common, line_dedup, ngram_join
from tests.llm import helpers as H


def prose(rng, n):
    return [f"w{rng.randrange(400)}" for _ in range(n)]


def near_copies(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    rows = [" ".join(prose(rng, rng.randrange(1, 120))) for _ in range(60)]
    common = " ".join(prose(rng, 14))
    rows += [common + "\n" + " ".join(prose(rng, 60)) for _ in range(40)]
    rows += near_copies(rng, prose(rng, 150), 80, 4)       # one large group
    rows += ["same words in one text here"] * 30           # exact copies
    rows += ["", None, "  \n\t ", "a b", "a b", "one two three four", "y " * 30000]
    return [(i, t) for i, t in enumerate(rows)]


def test_classes_and_links_equal_brute_force(spark, corpus):
    want = H.jaccard_classes(corpus)
    # a small limit forces splits and blocks
    for limit, block in ((200, 800), (10, 16)):
        before, ngram_join.BLOCK = ngram_join.BLOCK, block
        try:
            got = ngram_join.jaccard_join(H.docs(spark, corpus), limit=limit).collect()
        finally:
            ngram_join.BLOCK = before
        assert {r.doc_id: (r.class_id, r.class_docs, r.n_links, r.n_set_links) for r in got} \
            == {corpus[i][0]: v for i, v in want.items()}


def test_runs_meet_the_recall():
    n = ngram_join.runs_for(0.9999)
    assert ngram_join.expected_recall(0.8, n) >= 0.9999 > ngram_join.expected_recall(0.8, n - 1)


def test_keep_one_row_per_class(spark, corpus):
    want = {v[0] for i, v in H.jaccard_classes(corpus).items() if H.words(corpus[i][1])}
    want.add(min(i for i, t in corpus if not H.words(t)))
    df = H.docs(spark, corpus + [corpus[3], (None, "unknown id but some words here")])
    kept = ngram_join.keep_one(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == sorted(want) and ids.count(None) == 1


def test_components_of_a_long_chain(spark):
    edges = [(bytes([i // 256, i % 256]), bytes([(i + 1) // 256, (i + 1) % 256])) for i in range(40)]
    edges += [(b"\x09\x00", b"\x09\x01")]
    got = ngram_join.components(spark.createDataFrame(edges, "set_id binary, other binary")).collect()
    assert {bytes(r.node): bytes(r.root) for r in got} == {
        **{bytes([0, i]): b"\x00\x00" for i in range(1, 41)}, b"\x09\x01": b"\x09\x00"}


def test_jaccard_block_equals_sets():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(30)]
    ok = np.triu(np.ones((30, 30), bool), 1)
    got = ngram_join._jaccard(sets, ok, 0.5)
    for i in range(30):
        for j in range(i + 1, 30):
            a, b = set(sets[i].tolist()), set(sets[j].tolist())
            assert got[i, j] == (len(a & b) >= 0.5 * len(a | b))


def test_empty_tables(spark):
    none = H.docs(spark, [])
    assert ngram_join.jaccard_join(none).count() == 0
    assert ngram_join.keep_one(none).count() == 0
    assert line_dedup.line_dedup(none).count() == 0


@pytest.fixture(scope="module")
def lines():
    rng = random.Random(9)
    pool = [prose(rng, rng.randrange(1, 30)) for _ in range(60)]
    rows = []
    for i in range(80):
        text = []
        for _ in range(rng.randrange(6)):
            w = list(rng.choice(pool))
            act = rng.randrange(6)
            if act == 0:
                w.insert(rng.randrange(len(w) + 1), f"n{rng.randrange(50)}")
            elif act == 1 and len(w) > 1:
                del w[rng.randrange(len(w))]
            elif act == 2:
                w[rng.randrange(len(w))] = f"n{rng.randrange(50)}"
            text.append(" ".join(w) + rng.choice(["", " ", "\r"]))
        rows.append((i, "\n".join(text)))
    return rows + [(200, None), (201, ""), (202, "b b b c d e f g h i j k"), (203, "b b c d e f g h i j k"),
                   (204, "z " * 50000 + "\n" + "z " * 50000)]


def test_lines_equal_brute_force(spark, lines):
    df = H.docs(spark, lines)
    got = line_dedup.line_dedup(df)
    assert got.columns == [c for c in df.columns if c != "n_lines_removed"] + ["n_lines_removed", "n_near_removed"]
    rows = got.collect()
    assert {r.doc_id: r.text for r in rows} == H.dedup_lines(lines)
    assert all((r.n_lines_removed > 0) == (r.text != dict(lines)[r.doc_id]) for r in rows)


def test_lines_without_any_broadcast(spark, lines, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    got = line_dedup.line_dedup(H.docs(spark, lines)).collect()
    assert {r.doc_id: r.text for r in got} == H.dedup_lines(lines)


def test_row_bytes_follow_the_values(spark, monkeypatch):
    df = spark.createDataFrame([(1, "é" * 10, [1, 2, 3], ("ab", [b"xyz", None])), (2, None, None, None)],
                               "a long, b string, c array<long>, d struct<e: string, f: array<binary>>")
    sizes = {r.a: r.n for r in df.select("a", common.row_bytes(df).alias("n")).collect()}
    # every string, binary, array and struct takes 16 bytes and what it holds
    assert sizes == {1: 16 + 8 + (16 + 20) + (16 + 24) + (16 + (16 + 2) + (16 + (16 + 3) + 16)), 2: 16 + 8 + 16 + 16 + 48}
    small = df.select("a")
    for limit, hinted in ((48, True), (47, False)):
        monkeypatch.setattr(common, "BROADCAST_BYTES", limit)
        plan = df.join(common.broadcast_if_bounded(small), "a")._jdf.queryExecution().logical().toString()
        assert ("broadcast" in plan.lower()) == hinted
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    assert common.broadcast_if_bounded(df.filter(F.lit(False))).count() == 0


def test_repeated_rows_keep_the_same_lines(spark):
    text = "one line of several words\none line of several words"
    other = "one line of several words"
    got = line_dedup.line_dedup(H.docs(spark, [(1, text), (1, text), (1, other), (None, "x y z w q")])).collect()
    # of the two texts with one id the line stays in one, and both copies of a text end alike
    mine = sorted(r.text for r in got if r.doc_id == 1)
    assert mine in (["", "", other], ["", other, other])
    assert [r.text for r in got if r.doc_id is None] == ["x y z w q"]


def test_one_variant_shared_by_many_lines(spark):
    lines = [(i, f"a b c d e f g h i j k v{i}") for i in range(300)]
    got = {r.doc_id: r.text for r in line_dedup.line_dedup(H.docs(spark, lines)).collect()}
    assert got[0] == lines[0][1] and all(got[i] == "" for i in range(1, 300))
