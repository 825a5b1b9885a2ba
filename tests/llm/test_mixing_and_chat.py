"""Operators 7, 9: mixing against SQL and by hand, chat by exact round trip."""

import hashlib
import math
import random
import re

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strata.llm import chat_windows, mixing, oracles
from tests.llm import helpers as H


@pytest.fixture(scope="module")
def skewed():
    rng = random.Random(2)
    rows = [(i, "w " * rng.randrange(1, 4000), "en", rng.choice(["hot"] * 6 + ["a", "b", None])) for i in range(500)]
    return rows + [(900, None, "en", "a"), (901, "", "en", "hot"), (None, "x y", "en", "b"), (5, rows[5][1], "en", rows[5][3])]


def test_mixture_equals_sql(spark, skewed):
    got = mixing.mixture(H.docs(spark, skewed)).toPandas()
    con = duckdb.connect()
    con.register("documents", pd.DataFrame([r[:4] for r in skewed], columns=["doc_id", "text", "lang", "source"])
                 .astype({"doc_id": "Int64"}))
    want = con.execute(oracles.MIXING).fetchall()
    key = lambda r: tuple(str(x) for x in r)
    rows = [tuple(None if pd.isna(x) else x for x in r) for r in got.itertuples(index=False)]
    norm = lambda rs: sorted(key([None if r[0] is None else int(r[0]), *r[1:]]) for r in rs)
    assert norm(rows) == norm(want)


def test_entropy_and_budget(spark, skewed):
    df = H.docs(spark, skewed)
    use = {r.source: r.t for r in mixing.mixture(df, block_tokens=3000).groupBy("source")
           .agg(F.sum("n_tokens").alias("t")).collect()}
    have = {}
    for r in skewed:
        have[r[3]] = have.get(r[3], 0) + len((r[1] or "").split())
    total, used = sum(have.values()), sum(use.values())
    longest = max(len((r[1] or "").split()) for r in skewed)
    assert total - longest * len(have) <= used <= total
    entropy = -sum(t / used * math.log(t / used) for t in use.values())
    natural = -sum(t / total * math.log(t / total) for t in have.values())
    assert natural < mixing.TARGET * math.log(len(have)) and entropy >= 0.98 * mixing.TARGET * math.log(len(have))
    assert use["hot"] < have["hot"] and use["a"] > have["a"]


def test_repetition_limit_wins(spark):
    shares = spark.createDataFrame([("big", 10_000), ("tiny", 1)], "source string, tokens long")
    a = mixing.exponent(shares, target=1.0, max_epochs=4.0)
    z = 10_000 ** a + 1
    assert 0 < a < 1 and 10_001 / z <= 4.0 + 0.01


def test_mix_documents_uses_the_same_rows(spark, skewed):
    df = H.docs(spark, skewed)
    uses = mixing.mixture(df, block_tokens=3000).groupBy("doc_id").count()
    got = mixing.mix_documents(df, block_tokens=3000)
    assert got.columns == [c for c in df.columns if c != "copies"] + ["copies"]
    per = got.groupBy("doc_id").agg(F.sum("copies").alias("count"))
    assert sorted(map(str, per.collect())) == sorted(map(str, uses.collect()))


def test_empty_tables(spark):
    none = H.docs(spark, [])
    assert mixing.mixture(none).count() == 0 and mixing.mix_documents(none).count() == 0
    assert mixing.mixture(H.docs(spark, [(1, ""), (2, None)])).count() == 2
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_windows.read_back(chat_windows.windows(empty)).count() == 0


CHAT = "conv_id long, turn long, role string, text string, id long, window long, key string, p string"


def chat(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "k", "p") for r in rows], CHAT)


def expected(rows):
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r[1:])
    out = {}
    for k, v in by.items():
        v = sorted(v, key=lambda t: (t[0] is not None, t[0] or 0, t[1] or "", t[2] or ""))
        turns = "".join(f"{r or ''}\n{t or ''}\n" for _, r, t in v)
        loss = "".join(t or "" for _, r, t in v if r == "assistant")
        out[k] = (len(v), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.fixture(scope="module")
def talk():
    rng = random.Random(4)
    bits = ["\\", "<", "[", "]", "l", "b", "c", "</s>", "<s>[", "a b", "é", "\n", "\\l"]
    rows = [(rng.choice([1, 2, 3, None]), rng.choice([0, 1, 2, 3, 4, None]),
             rng.choice(["user", "assistant", "system", "to]ol[<", None]),
             "".join(rng.choice(bits) for _ in range(rng.randrange(40))) if rng.random() < 0.9 else None)
            for _ in range(90)]
    return rows + [(7, 0, "assistant", "long " * 30000), (8, 0, "system", ""), (7, 0, "assistant", "long " * 30000)]


@pytest.mark.parametrize("budget,history", [(768, 256), (20, 8), (5, 5), (60, 0)])
def test_round_trip(spark, talk, budget, history):
    got = chat_windows.read_back(chat_windows.windows(chat(spark, talk), budget=budget, history=history)).collect()
    assert {r.conv_id: tuple(r)[1:5] for r in got} == expected(talk)


def test_windows_keep_the_budget(spark):
    rows = [(1, 0, "system", "be kind")] + [(1, i, "user" if i % 2 else "assistant", "w " * (i % 13)) for i in range(1, 200)]
    for w in chat_windows.windows(chat(spark, rows), budget=60, history=30).collect():
        turns = re.findall(r"<s>\[(.*?)\]\n([^<]*)</s>\n", w.text)
        size = [len(t.split()) + chat_windows.TURN_TOKENS for _, t in turns]
        assert "".join(f"<s>[{r}]\n{t}</s>\n" for r, t in turns) == w.text
        assert sum(size[w.repeated:]) <= 60
        if w.window:
            assert turns[0] == ("system", "be kind") and sum(size[1:w.repeated]) <= 30
        targets = [w.text[x.s:x.e] for x in w.targets]
        assert targets == [t for r, t in turns[w.repeated:] if r == "assistant"]


def test_probe_holds_no_mark(spark):
    text = chat_windows.windows(chat_windows.with_probe(chat(spark, []))).first().text
    assert "[INST]" not in text and text.count("</s>") == 2
