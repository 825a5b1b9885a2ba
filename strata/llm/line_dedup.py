"""Line dedup by a deletion-neighbourhood join.

The symbols of a line are its words.  Two lines are duplicates when they hold
the same words, or, from `near_words` words on, when one word inserted,
deleted or replaced turns one into the other.  A line goes when an earlier
line (by document id, then line number) is its duplicate.

1. Equal lines meet in a count per line hash; the earliest is kept.
2. Lines one edit apart share their first or their last k words, where k is at
   most half of the shorter line, so only distinct lines with such an end in
   common are candidates.  k doubles with the length, so it is at least about a
   quarter of a line.
3. Each candidate emits the hashes of all variants with at most one word
   deleted.  Equal variants join: two lines that drop the word at the same
   place differ in that word, and a line equal to another's variant lacks one
   word.  Per variant and place only the earliest line is kept, so a variant
   that thousands of lines share costs a row per line and no pairs.
4. The words of a line and of its earliest partner are compared before the
   line goes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm import textbatch as tb
from strata.llm.common import bounded_batches, broadcast_if_bounded, materialize, own

MIN_WORDS = 1               # lines without a word are left alone
NEAR_WORDS = 10             # shorter lines have equal duplicates only

_H = tb.odd_constants(4, 0x6E)


def _line_words(t: tb.Texts, min_words: int):
    """(text, line number in its text, first word, past last word) of the lines
    with enough words."""
    starts, ends, first = t.lines()
    a, b = np.searchsorted(t.starts, starts), np.searchsorted(t.starts, ends)
    text = np.repeat(np.arange(t.n), np.diff(first))
    number = np.arange(len(starts)) - first[:-1][text]
    ok = b - a >= min_words
    return text[ok], number[ok], a[ok], b[ok]


_PRIME = np.uint64((1 << 31) - 1)
_BASES = (np.uint64(0x2545F491), np.uint64(0x5BD1E995))  # below the prime


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """The powers 0 .. n of a base modulo the prime, by doubling."""
    out, step = np.ones(1, np.uint64), base
    while len(out) <= n:
        out = np.concatenate((out, out * step % _PRIME))
        step = step * step % _PRIME
    return out[:n + 1]


class _Spans:
    """Hashes of word ranges, as differences of running polynomials: two, over
    the two halves of the words' hashes, modulo a prime (modulo a power of two,
    regular sequences of words would get equal values)."""

    def __init__(self, words: np.ndarray) -> None:
        n, self._sides = len(words), []
        for half, base in zip((words >> np.uint64(32), words & np.uint64(0xFFFFFFFF)), _BASES):
            up = _powers(base, n)
            down = _powers(np.uint64(pow(int(base), -1, int(_PRIME))), n)
            run = np.concatenate((np.zeros(1, np.uint64), np.cumsum((half + np.uint64(1)) % _PRIME * up[:n] % _PRIME)))
            self._sides.append((up, down, run))

    def raw(self, a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
        return [(run[b] - run[a]) % _PRIME * down[a] % _PRIME for _, down, run in self._sides]

    def without(self, a: np.ndarray, at: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Hash of the words from a to b but for the one at `at`."""
        # words before the gap, then those after it moved down by one place
        sides = [(x + y * up[at - a]) % _PRIME for x, y, (up, _, _) in zip(
            self.raw(a, at), self.raw(at + 1, b), self._sides)]
        return self._mixed(sides, b - a - 1)

    def hash(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self._mixed(self.raw(a, b), b - a)

    @staticmethod
    def _mixed(sides: list[np.ndarray], n: np.ndarray) -> np.ndarray:
        return tb.mix((sides[0] << np.uint64(32) | sides[1]) ^ tb.mix(n.astype(np.uint64) * _H[0]))


def _end_keys(spans: _Spans, a: np.ndarray, b: np.ndarray, k: np.ndarray) -> list[np.ndarray]:
    """Hashes of the first and last k words, told apart by side."""
    return [tb.mix(spans.hash(a, a + k) ^ _H[2]), tb.mix(spans.hash(b - k, b) ^ _H[3])]


def _line_rows(near_words: int, min_words: int):
    """Per line: document key, number, hash and the keys of its ends."""
    least = max(1, near_words // 2)

    def run(batches):
        for batch in batches:
            ids, marks = batch.column(0), batch.column(1)
            for i, j, t in tb.slices(batch, "text"):
                text, number, a, b = _line_words(t, min_words)
                if not len(text):
                    continue
                spans = _Spans(t.words)
                n = b - a
                near = n >= max(near_words, 2)
                # the greatest k = least * 2^i with 2k <= n, for the line itself
                # and, where it differs, for a partner one word shorter
                k = least << np.floor(np.log2(np.maximum(n, 2 * least) / (2 * least)) + 1e-9).astype(np.int64)
                own = np.flatnonzero(near)
                shorter = np.flatnonzero(near & (n == 2 * k) & (k > least))
                line = np.concatenate((own, own, shorter, shorter))
                keys = np.concatenate(_end_keys(spans, a[own], b[own], k[own])
                                      + _end_keys(spans, a[shorter], b[shorter], k[shorter] // 2))
                order = np.argsort(line, kind="stable")
                offsets = np.searchsorted(line[order], np.arange(len(n) + 1))
                take = pa.array(text + i)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(take), marks.take(take), pa.array(number, pa.int32()),
                     pa.array(tb.as_long(tb.hash_runs(t.words, a, b)), pa.int64()),
                     tb.list_array(tb.as_long(keys[order]), offsets, pa.int64())],
                    names=["id", "mark", "line", "h", "ends"])
    return run


def _word_rows(near_words: int):
    """Per line long enough: hash and word hashes."""
    def run(batches):
        for batch in batches:
            for _, _, t in tb.slices(batch, "text"):
                _, _, a, b = _line_words(t, near_words)
                if not len(a):
                    continue
                h = tb.hash_runs(t.words, a, b)
                at = np.concatenate([np.arange(x, y) for x, y in zip(a.tolist(), b.tolist())])
                offsets = np.concatenate(([0], np.cumsum(b - a)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tb.as_long(h), pa.int64()),
                     tb.list_array(tb.as_long(t.words[at]), offsets, pa.int64())], names=["h", "words"])
    return run


def _variants(batches):
    """(rank, v, place): the line itself (place -1) and each one-word deletion."""
    for batch in batches:
        rank = batch.column(0).to_numpy()
        lists = batch.column(1)
        words = lists.flatten().to_numpy().view(np.uint64)
        off = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        n = np.diff(off)
        if not len(words):
            continue
        spans = _Spans(words)
        line = np.repeat(np.arange(len(n)), n)
        at = np.arange(len(words))
        a, b = off[:-1][line], off[1:][line]
        gone = spans.without(a, at, b)
        full = spans.hash(off[:-1], off[1:])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate((rank, rank[line])), pa.int64()),
             pa.array(tb.as_long(np.concatenate((full, gone))), pa.int64()),
             pa.array(np.concatenate((np.full(len(n), -1), at - a)), pa.int32())],
            names=["rank", "v", "place"])


def _within_one(a: pa.Array, b: pa.Array) -> pa.Array:
    """Whether two lists of word hashes are at most one word edit apart."""
    out = []
    for x, y in zip(a, b):
        x, y = x.values.to_numpy(), y.values.to_numpy()
        if len(x) > len(y):
            x, y = y, x
        m = len(x)
        head = int(np.argmin(np.append(x == y[:m], False)))
        gap = len(y) - m
        out.append(gap <= 1 and bool(np.array_equal(x[head + 1 - gap:], y[head + 1:])))
    return pa.array(out, pa.bool_())


_within_one_udf = F.arrow_udf(_within_one, T.BooleanType())


def _removed(lines: DataFrame, slim: DataFrame, near_words: int) -> DataFrame:
    """(h, first, times, near): the distinct lines, where each stands first, how
    often it occurs, and whether an earlier line is its near duplicate."""
    distinct = materialize(
        lines.groupBy("h").agg(F.min(F.struct("id", "line", "mark")).alias("first"),
                               F.count(F.lit(1)).alias("times"), F.first("ends").alias("ends")), "op6-distinct")
    ends = distinct.select("h", "first", F.explode("ends").alias("key"))
    shared = materialize(ends.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key"),
                         "op6-shared")
    whole = distinct.select("h", "first", "times")
    if shared.isEmpty():
        return whole.withColumn("near", F.lit(False))
    flagged = ends.join(broadcast_if_bounded(shared), "key", "left_semi") \
        .drop("key").dropDuplicates(["h"])
    # one ascending number per candidate line, in the order that decides
    flagged = materialize(flagged.orderBy("first.id", "first.line", "first.mark", "h")
                          .withColumn("rank", F.monotonically_increasing_id()), "op6-flagged")

    # words of the flagged lines, from the documents that hold them first
    docs = flagged.select("first.id", "first.mark")
    docs = broadcast_if_bounded(docs.distinct(), docs)
    texts = slim.alias("t").join(docs.alias("d"), F.col("t.id").eqNullSafe(F.col("d.id"))
                                 & F.col("t.mark").eqNullSafe(F.col("d.mark")), "left_semi")
    words = materialize(
        texts.mapInArrow(_word_rows(near_words), "h long, words array<long>")
        .join(broadcast_if_bounded(flagged.select("h", "rank")), "h")
        .dropDuplicates(["rank"]), "op6-words")
    variants = words.select("rank", "words").mapInArrow(_variants, "rank long, v long, place int")
    met = materialize(variants.groupBy("v").agg(F.min("rank").alias("a"), F.max("rank").alias("b"))
                      .filter("a < b").select("v"), "op6-met")
    variants = materialize(variants.join(broadcast_if_bounded(met), "v", "left_semi"),
                           "op6-variants")
    # earliest line per variant and place; place -1 meets every place
    by_place = variants.groupBy("v", "place").agg(F.min("rank").alias("best"))
    by_variant = by_place.groupBy("v").agg(
        F.min(F.when(F.col("place") == -1, F.col("best"))).alias("whole"),
        F.min(F.when(F.col("place") >= 0, F.col("best"))).alias("cut"))
    met = (by_place.join(by_variant, "v")
           .select("v", "place", F.when(F.col("place") >= 0, F.least("best", "whole"))
                   .otherwise(F.least("best", "cut")).alias("best"))
           .join(variants, ["v", "place"]).filter(F.col("best") < F.col("rank")))
    partner = met.groupBy("rank").agg(F.min("best").alias("p"))
    pairs = (partner.join(words.select("rank", "h", F.col("words").alias("x")), "rank")
             .join(words.select(F.col("rank").alias("p"), F.col("words").alias("y")), "p"))
    near = pairs.filter(_within_one_udf(F.col("x"), F.col("y"))).select("h", F.lit(True).alias("near"))
    return whole.join(near, "h", "left").withColumn("near", F.coalesce("near", F.lit(False)))


def _cut_lines(text: pa.Array, drop: pa.Array) -> pa.Array:
    out = []
    for t, d in zip(text.to_pylist(), drop.to_pylist()):
        if t is None or d is None:
            out.append(None)
            continue
        gone = set(d)
        out.append("\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone))
    return pa.array(out, pa.string())


_cut_lines_udf = F.arrow_udf(_cut_lines, T.StringType())


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_words: int = MIN_WORDS, near_words: int = NEAR_WORDS) -> DataFrame:
    """The input with its duplicate lines cut from text_col, plus
    n_lines_removed and n_near_removed (those without an equal earlier line).

    Lines with fewer than `min_words` words stay.  A null text stays null; an
    empty text, and one whose lines all go, is empty.  Rows that repeat both id
    and text are one document: all keep the same lines.  Rows with one id and
    different texts are ordered by a hash of the text.  Null ids come first.
    """
    bounded_batches(docs.sparkSession)
    i, m, removed, near = own("id"), own("mark"), "n_lines_removed", "n_near_removed"
    base = docs.drop(removed, near)
    mark = F.xxhash64(F.col(text_col))
    slim = base.select(F.col(id_col).alias("id"), mark.alias("mark"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    lines = materialize(
        slim.mapInArrow(_line_rows(near_words, min_words),
                        f"id {kind}, mark long, line int, h long, ends array<long>"), "op6-lines")
    plan = _removed(lines, slim, near_words)
    plan = materialize(plan.filter("near or times > 1"), "op6-plan")
    plan = broadcast_if_bounded(plan)
    here = F.struct("id", "line", "mark")
    gone = (lines.select("id", "mark", "line", "h").join(plan, "h")
            .withColumn("is_first", here.eqNullSafe(F.col("first")))
            .filter(F.col("near") | ~F.col("is_first"))
            .groupBy("id", "mark").agg(
                F.collect_set("line").alias("drop"),
                F.count_distinct(F.when(F.col("near") & F.col("is_first"), F.col("line"))).alias("n_near")))
    gone = materialize(gone.select(F.col("id").alias(i), F.col("mark").alias(m), "drop", "n_near"), "op6-gone")
    gone = broadcast_if_bounded(gone).withColumnRenamed("drop", d := own("drop")) \
        .withColumnRenamed("n_near", c := own("near"))
    joined = base.withColumn(own_mark := own("m"), mark).join(
        gone, F.col(id_col).eqNullSafe(F.col(i)) & F.col(own_mark).eqNullSafe(F.col(m)), "left")
    cut = _cut_lines_udf(F.when(F.col(d).isNotNull(), F.col(text_col)), F.col(d))
    out = joined.withColumn(t := own("text"), cut)
    names = [F.when(F.col(d).isNotNull(), F.col(t)).otherwise(F.col(text_col)).alias(x)
             if x == text_col else F.col(f"`{x}`") for x in base.columns]
    return out.select(*names, F.coalesce(F.size(d), F.lit(0)).cast("long").alias(removed),
                      F.coalesce(c, F.lit(0)).cast("long").alias(near))
