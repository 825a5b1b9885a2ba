"""Regular sequences that a polynomial modulo 2^64 cannot tell apart."""

import random

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import decontam, line_dedup, ngram_join, quality_mcd, token_counts
from strata.llm import textbatch as tb
from tests.llm import helpers as H


def thue_morse(n, a="a", b="b"):
    bits = [bin(k).count("1") % 2 for k in range(n)]
    return [a if x else b for x in bits], [b if x else a for x in bits]


def _hash(text):
    data = np.frombuffer(text.encode(), np.uint8)
    return int(tb.hash_spans(data, np.array([0]), np.array([len(data)]))[0])


@pytest.mark.parametrize("n", [64, 65, 1024, 2048, 4096, 1 << 16])
def test_spans_of_bytes(n):
    x, y = ("".join(v) for v in thue_morse(n))
    assert _hash(x) != _hash(y)
    assert _hash(x) != _hash(x[:-1]) and _hash(x + "a") != _hash(x)


def test_a_span_hashes_alike_wherever_it_stands():
    rng = random.Random(2)
    spans = [bytes(rng.randrange(97, 100) for _ in range(n)) for n in (1, 63, 64, 65, 127, 128, 129, 5000)]
    seen = {}
    for _ in range(5):
        rng.shuffle(spans)
        data = np.frombuffer(b"".join(b"-" * rng.randrange(1, 9) + s for s in spans), np.uint8)
        starts, ends, at = [], [], 0
        raw = data.tobytes()
        for s in spans:
            at = raw.index(s, at)
            while raw[at - 1:at] != b"-":
                at = raw.index(s, at + 1)
            starts.append(at)
            ends.append(at + len(s))
            at += len(s)
        for s, h in zip(spans, tb.hash_spans(data, np.array(starts), np.array(ends))):
            assert seen.setdefault(s, h) == h
    assert len(set(seen.values())) == len(spans)


def test_token_counts(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    path = public_tokenizers.path("byte_bpe_50k.json")
    x, y = ("".join(v) for v in thue_morse(2048))
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(path)
    text = f"{x} and {y}"
    [row] = token_counts.token_counts(H.docs(spark, [(1, text)]), path).collect()
    assert row.n_tokens == len(library.encode(text, add_special_tokens=False))


def test_lines_of_regular_words(spark):
    x, y = (" ".join(v) for v in thue_morse(2048, "left", "right"))
    got = {r.doc_id: r.text for r in line_dedup.line_dedup(H.docs(spark, [(1, x), (2, y), (3, y)])).collect()}
    assert got == {1: x, 2: y, 3: ""}


def test_duplicate_lines_of_regular_bytes():
    x, y = ("".join(v) for v in thue_morse(4096))
    counts = quality_mcd.text_counts(pa.array([f"{x}\n{y}", f"{x}\n{x}"])).to_pylist()
    assert [c["n_dup_lines"] for c in counts] == [0, 1]


def test_shingles_and_leaks_of_regular_words(spark):
    x, y = ("".join(v) for v in thue_morse(2048))
    one, two = f"w {x} e r t", f"w {y} e r t"
    rows = {r.doc_id: r for r in ngram_join.jaccard_join(H.docs(spark, [(1, one), (2, two), (3, one)])).collect()}
    classes = {i: r[next(k for k in r.asDict() if "class" in k)] for i, r in rows.items()}
    assert classes[1] == classes[3] != classes[2]
    item = " ".join(f"{x} is one of many words here".split() * 2)
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    leaks = decontam.find_leaks(H.docs(spark, [(1, item), (2, item.replace(x, y))]), bench)
    assert {r.doc_id for r in leaks.collect()} == {1}
