"""Operators 2, 10: robust outliers and decontamination."""

import random

import numpy as np
import pytest

from strata.llm import decontam, quality_mcd
from tests.llm import helpers as H


def sentence(rng, n):
    w = [rng.choice("abcdefghij") * rng.randrange(1, 4) + f"{rng.choice('klmnop')}{rng.choice('qrst')}" + rng.choice("uvwxyz")
         for _ in range(n)]
    return " ".join(w).capitalize() + "."


@pytest.fixture(scope="module")
def mixed():
    rng = random.Random(3)
    rows = []
    for i in range(700):
        text = "\n".join(sentence(rng, rng.randrange(20, 40)) for _ in range(5))
        if i % 10 == 0:
            text = " ".join(f"{w}###" for w in text.split())
        elif i % 25 == 1:
            text = text.upper()
        rows.append((i, text, "en", "hot" if i % 3 else f"s{i % 5}"))
    return rows + [(900, None, None, None), (901, "", "en", None), (902, "w " * 60000, "en", "hot"),
                   (903, "a\na\n\n a", None, "hot")]


def test_base_counts_equal_brute_force(spark, mixed):
    got = quality_mcd.quality_report(H.docs(spark, mixed)).collect()
    assert len(got) == len(mixed)
    text = {r[0]: r[1] for r in mixed}
    for r in got:
        n = H.base_counts(text[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
        assert r.base_failed == (n[0] < 50 or 100 * n[4] > 50 * n[0])
        if r.base_failed:
            assert not r.kept


def test_outliers_go_and_clean_texts_stay(spark, mixed):
    df = H.docs(spark, mixed)
    kept = {r.doc_id for r in quality_mcd.quality_report(df).filter("kept").collect()}
    for i in range(700):
        junk = i % 10 == 0 or i % 25 == 1
        assert (i in kept) != junk, i
    good = quality_mcd.keep_good(df)
    assert good.columns == df.columns and {r.doc_id for r in good.collect()} == kept


@pytest.mark.parametrize("junk", [lambda t: " ".join(f"{w}###" for w in t.split()), str.upper])
def test_junk_in_two_fifths_of_a_group_goes(spark, junk):
    rng = random.Random(8)
    rows = []
    for i in range(500):
        text = "\n".join(sentence(rng, rng.randrange(20, 40)) for _ in range(5))
        rows.append((i, junk(text) if i % 5 < 2 else text, "en", "hot"))
    kept = {r.doc_id for r in quality_mcd.quality_report(H.docs(spark, rows)).filter("kept").collect()}
    assert not [i for i in kept if i % 5 < 2]
    assert len(kept) >= 0.98 * 300


def test_empty_and_tiny_tables(spark):
    assert quality_mcd.quality_report(H.docs(spark, [])).count() == 0
    assert quality_mcd.keep_good(H.docs(spark, [])).count() == 0
    rows = quality_mcd.quality_report(H.docs(spark, [(1, "a b"), (1, "a b")])).collect()
    assert [r.kept for r in rows] == [False, False]


def test_estimate_equals_numpy(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(500, quality_mcd.DIM))
    df = spark.createDataFrame([("g", x.tolist()) for x in v], "grp string, v array<double>")
    row = quality_mcd._moments(df).mapInPandas(
        quality_mcd._estimates, "grp string, centre array<double>, whiten array<double>").first()
    cov = np.cov(v.T, bias=True) * quality_mcd._consistency(quality_mcd.SUPPORT) \
        + np.diag(np.array(list(quality_mcd.FEATURES.values())) ** 2)
    whiten = np.zeros((quality_mcd.DIM,) * 2)
    whiten[np.tril_indices(quality_mcd.DIM)] = row.whiten
    assert np.allclose(row.centre, v.mean(axis=0)) and np.allclose(whiten.T @ whiten, np.linalg.inv(cov))


ITEM = "Alice drove 120 km from Paris to meet Bob who had waited there for 3 hours with his dog near the station."
OTHER = ITEM.replace("Alice", "Carol").replace("120", "450").replace("Paris", "Rome")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, ITEM), (2, "a short item of six words"), (3, None), (4, ""), (5, "too few")],
                                 "item_id long, text string")


def leaks(spark, bench, rows):
    return {(r.doc_id, r.item_id): r for r in decontam.find_leaks(H.docs(spark, rows), bench).collect()}


def test_verbatim_and_reparameterised_items_are_found(spark, bench):
    got = leaks(spark, bench, [
        (10, "Some text before. " + ITEM + " And some after."), (11, "Before it, then: " + OTHER),
        (12, "nothing to see here " * 20), (13, "we have a short item of six words here"), (14, None), (15, ""),
        (16, ("filler " * 40000) + ITEM), (None, ITEM)])
    assert set(got) == {(10, 1), (11, 1), (13, 2), (16, 1), (None, 1)}
    assert got[(10, 1)].changed_slots == 0 and got[(11, 1)].changed_slots > 0


def test_opening_capital_of_a_quoted_item(spark):
    bench = spark.createDataFrame([(1, "Which river flows through the old town centre"),
                                   (2, "Seven of the small grey birds sat on Anna and"),
                                   (3, "Lines of the tall wall 3 4 5 6")], "item_id long, text string")
    got = leaks(spark, bench, [
        (10, "they asked: Which river flows through the old town centre and left"),
        (11, "they asked Which river flows through the old town centre and left"),
        (12, "they asked which river flows through the old town centre and left"),
        (13, "we heard that Seven of the small grey birds sat on Bela and flew"),
        (14, "they asked Which river flows under the old town centre and left"),
        (15, "so Lines of the tall wall 3 4 5 6 were set")])
    assert set(got) == {(10, 1), (11, 1), (12, 1), (13, 2), (15, 3)}
    assert all((r.changed_slots > 0) == (k == (13, 2)) for k, r in got.items())


def test_inconsistent_slots_do_not_count(spark):
    # a value of the item has two in the text, so no refill explains the text
    item = "we sold 12 red apples at noon and then 12 green pears in the cold evening rain"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = leaks(spark, bench, [(1, item.replace("12 red", "15 red")), (2, item.replace("12", "15"))])
    assert {k: r.changed_slots for k, r in got.items() if r.changed_slots} == {(2, 1): 1}
    assert (1, 1) not in got or got[(1, 1)].found < got[(2, 1)].found


def test_two_values_may_become_one(spark):
    item = "she had 12 small coins and he had 7 large coins so they put them all together"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = leaks(spark, bench, [(1, item.replace("12", "5").replace("7", "5"))])
    assert got[(1, 1)].changed_slots == 2 and got[(1, 1)].found == got[(1, 1)].item_windows


def test_names_of_several_words(spark):
    item = "On that day Alice went with her brother to see Karl near the old mill"
    bench = spark.createDataFrame([(1, item), (2, "Mary Ann Smith lost her keys")], "item_id long, text string")
    got = leaks(spark, bench, [
        (10, "so " + item.replace("Alice", "Mary Smith").replace("Karl", "Otto van Bern")),
        (11, "so " + item.replace("Alice", "Mary Smith").replace("Karl", "Otto Bern")),
        (12, "so " + item.replace("Alice", "Mary, Smith")),
        (13, "I heard Bob Jones lost her keys"), (14, "we know: Bob found her keys"),
        (15, "then old Mary Ann Smith lost her keys again")])
    assert {(11, 1), (15, 2), (10, 1)} <= set(got) and (14, 2) not in got
    assert got[(11, 1)].changed_slots == 2 and got[(11, 1)].found == got[(11, 1)].item_windows
    assert got[(15, 2)].changed_slots == 0
    # with a comma they are two names
    assert (12, 1) not in got or got[(12, 1)].found < got[(11, 1)].found


def test_items_of_a_few_words_are_whole_lines_or_sentences(spark):
    bench = spark.createDataFrame([(1, "What is gravity?"), (2, "Photosynthesis"), (3, "Yes. It does."), (4, "...")],
                                  "item_id long, text string")
    got = leaks(spark, bench, [
        (10, "They asked: What is gravity? Nobody knew."), (11, "so what is gravity anyway"),
        (12, "a line\nwhat is gravity\nanother"), (13, "on photosynthesis in plants"), (14, "notes\nPHOTOSYNTHESIS:\nmore"),
        (15, "Does it? Yes. It does. So."), (16, "Yes. It does not."), (17, "what is gravity"), (18, "... ..."), (19, None)])
    assert set(got) == {(10, 1), (12, 1), (14, 2), (15, 3), (17, 1)}
    assert all(r.found == r.item_windows == 1 and r.changed_slots == 0 for r in got.values())


def test_one_item_many_times_in_a_text(spark):
    item = "Alice drove 120 km from there to meet Bob who had waited for 3 hours with his dog"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = leaks(spark, bench, [(1, " and ".join(item.replace("120", str(k)) for k in range(300)))])
    once = leaks(spark, bench, [(1, item)])[(1, 1)]
    assert got[(1, 1)].found == once.found == once.item_windows


def test_items_full_of_slots_are_found_verbatim(spark):
    sums = "12 plus 30 is 42 and 7 times 6 is 42 or 84 by 2"
    names = "the list holds Anna Bela Carl Dora Emil Frau Gerd Hans Ines"
    tail = " ".join(str(k) for k in range(100, 130))
    half = "the farmer walked slowly along 3 roads to find his lost sheep " + tail
    bench = spark.createDataFrame([(1, sums), (2, names), (3, half)], "item_id long, text string")
    got = leaks(spark, bench, [
        (10, "some text before " + sums + " and after"), (11, "some text before " + names + " and after"),
        (12, "some text before " + sums.replace("12", "13").replace("6", "9") + " and after"),
        (13, "so " + half), (14, "so " + half.replace(" 3 ", " 9 ").replace(tail, " ".join(tail[::-1].split())))])
    assert set(got) == {(10, 1), (11, 2), (13, 3), (14, 3)}
    assert got[(10, 1)].item_windows == got[(10, 1)].found == 8
    assert all((r.changed_slots > 0) == (k == (14, 3)) for k, r in got.items())


def test_long_passage_of_a_longer_item_is_found(spark):
    w = [f"{a}{b}ing" for a in "bcdfghklmnprstvw" for b in ("a", "e", "i", "o", "u", "ai", "ei", "ou", "au", "ee",
                                                           "oa", "ia", "io", "eo", "ui", "ue")][:250]
    bench = spark.createDataFrame([(1, " ".join(w))], "item_id long, text string")
    got = leaks(spark, bench, [
        (10, "before it " + " ".join(w[60:160]) + " after it"), (11, "before it " + " ".join(w[60:110]) + " after it"),
        (12, "before it " + " ".join(w[60:109]) + " after it"),
        # many short pieces are no passage
        (13, " between ".join(" ".join(w[k:k + 20]) for k in range(0, 100, 25)))])
    assert set(got) == {(10, 1), (11, 1)}
    assert (got[(10, 1)].found, got[(11, 1)].found, got[(10, 1)].item_windows) == (93, 43, 243)


def test_drop_contaminated(spark, bench):
    df = H.docs(spark, [(1, ITEM), (1, ITEM), (2, "clean text"), (3, None), (None, "clean"), (1, "same id but clean")])
    got = decontam.drop_contaminated(df, bench)
    assert got.columns == df.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in got.collect()) == sorted(
        [("2", "clean text"), ("3", "None"), ("None", "clean"), ("1", "same id but clean")])
    assert decontam.drop_contaminated(H.docs(spark, []), bench).count() == 0
    assert decontam.find_leaks(df, bench.limit(0)).count() == 0
