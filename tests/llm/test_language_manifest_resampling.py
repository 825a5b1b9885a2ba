"""Language mixtures, the Merkle manifest and importance resampling against
brute-force versions, with odd inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from strata.llm import language_mixture, merkle, resampling
from tests.llm.helpers import DOC, docs

SMOKE = "/root/testdata/sf0.001"


def frame(spark, full):
    """Documents from whole rows, with columns whose names operators use."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(full, DOC)
    for name in ("tree", "pos", "size", "leaf", "digest", "block", "score", "rank", "weight", "held_out", "at"):
        df = df.withColumn(name, F.lit("7"))
    return df


# ---------------------------------------------------------------- Merkle manifest

def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, lower=False):
    doc_id, text, lang, source, n_chars = row
    if lower and text is not None:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return H(*map(enc, (doc_id, source, lang, n_chars, text)))


def tree(leaves):
    """Root, and per leaf its (place, run) on every level."""
    paths, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        runs = [level[k:k + 16] for k in range(0, len(level), 16)]
        for i, a in enumerate(at):
            paths[i].append((a % 16, runs[a // 16]))
        at, level = [a // 16 for a in at], [H(*r) for r in runs]
    return level[0], paths


def manifest_by_hand(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[3]].append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[s] = tree([leaf_of(r) for r in by[s]])
    root, upper = tree([trees[s][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for r, path in zip(by[s], trees[s][1]):
            whole = path + upper[k]
            proof = H(*["".join(run[:a] + run[a + 1:]) for a, run in whole])
            forged = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            node = leaf_of(r, forged)
            for a, run in whole:
                node = H(*run[:a], node, *run[a + 1:])
            out.append((r[0], leaf_of(r), trees[s][0], root, proof, node, node == root))
    return out


def test_manifest_equals_the_tree_built_by_hand(spark):
    rng = random.Random(3)
    rows = [(i, f"Text {i} É", "en", "hot", 9) for i in range(300)]           # two superblocks
    rows += [(1000 + i, f"One {i}", None, f"s{i}", i) for i in range(270)]    # sources beyond a superblock
    rows += [(2000 + i, "x" * i, "de", "sixteen", None) for i in range(16)]
    rows += [(3000 + i, None, "de", None, 1) for i in range(17)]              # null source
    rows += [(None, "No Id", "fr", "hot", 5), (None, None, None, None, None), (7, "Text 7 again", "en", "hot", 9)]
    rows += [(5, "Text 5 É", "en", "hot", 9)] * 3                             # repeated rows
    rows += [(4000, "", "en", "", 0), (4001, "Long Word " * 120_000, "en", "", 0), (-4, "NEGATIVE", "en", "é", 1)]
    rng.shuffle(rows)
    got = sorted(map(tuple, merkle.manifest(frame(spark, rows), merkle.tampered_fifth()).collect()), key=repr)
    assert got == sorted(manifest_by_hand(rows), key=repr)
    assert not all(r[-1] for r in got) and any(r[-1] for r in got)


def test_manifest_without_tampering_verifies_every_row(spark):
    rows = [(i, f"T{i}", "en", f"s{i % 3}", 2) for i in range(40)]
    assert all(r["verified"] for r in merkle.manifest(frame(spark, rows)).collect())


def test_manifest_of_one_row_is_its_leaf(spark):
    [row] = merkle.manifest(frame(spark, [(1, "Only", "en", "s", 4)])).collect()
    assert row["leaf"] == row["subroot"] == row["root"] == leaf_of((1, "Only", "en", "s", 4))
    assert row["proof_sha256"] == H("") and row["verified"]


def test_manifest_of_no_rows(spark):
    out = merkle.manifest(frame(spark, []), merkle.tampered_fifth())
    assert out.collect() == [] and out.columns[-1] == "verified"


# ---------------------------------------------------------------- importance resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, runs):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return w, [" ".join(w[k:k + n]) for n in range(1, runs + 1) for k in range(len(w) - n + 1)]


def resample_by_hand(rows, target, runs=1, buckets=10_000, percent=10, min_words=20, seed=2024):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in rows for f in features(t, runs)[1])
    t = Counter(bucket(f) for x in target for f in features(x, runs)[1])
    S, T, scored = sum(s.values()), sum(t.values()), []
    for doc_id, text in rows:
        words, feats = features(text, runs)
        total = sum(math.floor(1000 * math.log(float(t[b] + 1) * (S + buckets) / (float(s[b] + 1) * (T + buckets))))
                    for b in map(bucket, feats))
        weight = total // len(feats) if feats else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append((doc_id, len(feats), weight, score, len(words)))
    order = sorted((r for r in scored if r[4] >= min_words),
                   key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    out = [(*r[:4], k + 1) for k, r in enumerate(order[:percent * len(order) // 100])]
    rest = order[percent * len(order) // 100:] + [r for r in scored if r[4] < min_words]
    return out + [(*r[:4], None) for r in rest]


def _texts(n, seed=5):
    rng = random.Random(seed)
    vocabulary = ["alpha", "Beta", "x1", "naïve", "日本語", "end.", "re-do", "ÉTÉ", "w" * 40, "q" * 90, "1,000"]
    return [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 60)))) for i in range(n)]


@pytest.mark.parametrize("runs,percent", [(1, 10), (3, 35)])
def test_resampling_equals_the_draw_by_hand(spark, runs, percent):
    rows = _texts(400) + [(900, None), (901, ""), (902, "\x00\x7f ;"), (None, "alpha " * 30), (None, None),
                          (17, _texts(400)[17][1]), (17, _texts(400)[17][1]), (903, "Beta alpha " * 50_000)]
    target = ["alpha Beta x1", None, "", "ÉTÉ été naïve " * 5]
    bench = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    out = resampling.resample(docs(spark, rows), bench, runs=runs, percent=percent)
    got = sorted(map(tuple, out.collect()), key=repr)
    assert got == sorted(resample_by_hand(rows, target, runs, percent=percent), key=repr)


def test_resampling_on_empty_tables_and_short_texts(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert resampling.resample(docs(spark, []), bench).collect() == []
    out = resampling.resample(docs(spark, [(1, "too short"), (2, None)]), bench).collect()
    assert sorted(r["doc_id"] for r in out) == [1, 2] and all(r["rank"] is None for r in out)


def test_a_bracket_that_misses_is_widened(spark, monkeypatch):
    rows = spark.range(3000).selectExpr("id * 7 % 3000 as score")
    monkeypatch.setattr(resampling, "MARGIN", 1e-9)  # the sketch's own error is greater
    monkeypatch.setattr(resampling, "SKETCH_K", 8)
    low, high, above = resampling._bracket(rows, 3000, 300)
    exact = sorted((r[0] for r in rows.collect()), reverse=True)
    assert low <= exact[299] <= high and above == sum(x > high for x in exact)


def test_equal_scores_are_cut_by_id(spark):
    rows = spark.createDataFrame([(i, 25, 25, 0) for i in range(50)],
                                 "doc_id long, n_words long, n_features long, weight long")
    from pyspark.sql import functions as F
    tied = resampling.gumbel_score
    try:
        resampling.gumbel_score = lambda seed: F.lit(5).cast("long")
        out = resampling.draw(rows, percent=20)
        assert sorted((r["rank"], r["doc_id"]) for r in out.collect() if r["rank"]) == [(k + 1, k) for k in range(10)]
    finally:
        resampling.gumbel_score = tied


# ---------------------------------------------------------------- language mixtures

def trigrams(text):
    """Per word (runs of ASCII letters and bytes from 0x80) its trigrams."""
    out, word = [], []
    for b in [*(text or "").lower().encode(), 0]:
        if 97 <= b <= 122 or b >= 128:
            word.append(b - 96 if b < 128 else b - 101)
        elif word:
            padded = [0, *word, 0]
            out.append([(((p * 155 + c) * 155 + n) * 0x9E3779B97F4A7C15 % (1 << 64)) >> 48
                        for p, c, n in zip(padded, padded[1:], padded[2:])])
            word = []
    return out


def learn_by_hand(rows):
    counts = defaultdict(lambda: np.full(1 << 16, 0.5))
    for _, text, lang in rows:
        if lang is not None:
            for b in (b for w in trigrams(text) for b in w):
                counts[lang][b] += 1
    names = sorted(counts)
    return names, {n: np.log(counts[n] / counts[n].sum()) for n in names}


def mixture_by_hand(text, names, model):
    words = trigrams(text)
    if not words or not re.search(r"[^\W\d_]", text):
        return "und", 0.0
    ll = np.array([[sum(model[n][b] for b in w) for n in names] for w in words])

    def fit(share):
        for _ in range(language_mixture.STEPS):
            joint = np.exp(ll - ll.max(1, keepdims=True)) * share
            new = (joint / joint.sum(1, keepdims=True)).mean(0)
            moved, share = np.abs(new - share).max(), new
            if moved <= language_mixture.SETTLED:
                break
        joint = np.exp(ll - ll.max(1, keepdims=True)) * share
        return share, (np.log(joint.sum(1)) + ll.max(1)).sum()
    best, value = np.eye(len(names))[ll.sum(0).argmax()], ll.sum(0).max()
    free, _ = fit(np.full(len(names), 1 / len(names)))
    order = np.argsort(-free, kind="stable")
    for size in range(2, len(names) + 1):
        start = np.zeros(len(names))
        start[order[:size]] = np.maximum(free[order[:size]], 1e-3)
        share, likelihood = fit(start / start.sum())
        likelihood -= language_mixture.PENALTY * math.log(len(words) + 1) * (size - 1)
        if likelihood <= value:
            break
        best, value = share, likelihood
    return names[best.argmax()], float(best.max())


def _languages(n=90, seed=8):
    rng = random.Random(seed)
    lists = {"en": "the of and that with from this have which people water house".split(),
             "de": "der und nicht über schön straße wasser haus leute gehen müssen".split(),
             "fr": "être avec pour leçon très maison eau gens où français déjà".split()}
    rows = []
    for i in range(n):
        lang = ("en", "de", "fr")[i % 3]
        words = [rng.choice(lists[lang]) for _ in range(rng.randrange(20, 120))]
        if i % 5 == 0:  # a passage in another language
            other = ("en", "de", "fr")[(i + 1) % 3]
            words += [rng.choice(lists[other]) for _ in range(rng.randrange(5, 25))]
        rows.append((i, " ".join(words) + ".", None if i % 11 == 0 else lang))
    return rows


ODD = [(500, None, "en"), (501, "", "en"), (502, "12 !? —", "fr"), (503, "der", None), (504, "Ω 日本語", None),
       (505, "THE PEOPLE " * 30_000 + "water", None), (None, "the people", None), (506, "the people", "en"),
       (506, "the people", "en")]


def test_mixture_equals_the_estimate_by_hand(spark):
    rows = _languages() + ODD
    out = language_mixture.identify(docs(spark, [r[:3] for r in rows]))
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 4 == 2
    names, model = learn_by_hand([r for r in rows if not held(r[0])])
    want = sorted(((i, held(i), *mixture_by_hand(t, names, model)) for i, t, _ in rows), key=repr)
    got = sorted(((r["doc_id"], r["held_out"], r["lang_pred"], r["score"]) for r in out.collect()), key=repr)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(abs(g[3] - w[3]) < 5e-3 for g, w in zip(got, want))
    assert {r[2] for r in got if r[0] in (500, 501, 502)} == {"und"}


def test_a_passage_in_another_language_is_part_of_the_set(spark):
    rows = _languages()
    found = {r["doc_id"]: r["languages"] for r in language_mixture.identify(docs(spark, rows)).collect()}
    mixed = {i for i in range(90) if i % 5 == 0}
    assert {i for i, v in found.items() if "," in v} == mixed


def test_nothing_to_learn_and_nothing_to_predict(spark):
    out = language_mixture.identify(docs(spark, [(1, "some words", None), (2, None, None)])).collect()
    assert {(r["lang_pred"], r["score"]) for r in out} == {("und", 0.0)}
    assert language_mixture.identify(docs(spark, [])).collect() == []


def test_held_out_accuracy_and_labels_are_no_input(spark):
    from pyspark.sql import functions as F
    table = spark.read.parquet(f"{SMOKE}/documents.parquet")
    first = language_mixture.identify(table)
    held = first.filter("held_out").join(table.select("doc_id", "lang"), "doc_id").filter("lang IS NOT NULL")
    right, n = held.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count(F.lit(1))).first()
    assert n >= 20 and right >= 0.98 * n
    # wrong labels on the held-out rows change nothing
    wrong = table.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit("xx"))
                             .otherwise(F.col("lang")))
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, language_mixture.identify(wrong).collect()))


def test_too_many_languages_is_an_error(spark):
    rows = [(i, "text", f"l{i}") for i in range(600)]
    with pytest.raises(ValueError, match="languages"):
        language_mixture.identify(docs(spark, rows))
