"""Importance resampling towards a target distribution.

Features are runs of words, hashed into buckets.  The log ratio of a bucket's
share in the target to its share in the corpus is its gain; a document's weight
is the mean gain of its features, read from one array of the buckets' gains.
With Gumbel noise added, the documents of the greatest scores are a draw without
replacement in proportion to exp(weight).  Their cutoff is found by bracketing:
a quantile sketch gives two scores around it, exact counts outside show whether
it lies between them (if not, the bracket is widened), and only the rows between
them are sorted.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import bounded_batches, materialize
from strata.operators.ranking import with_positions

BUCKETS = 10_000
RUNS = 1        # features are runs of 1 to RUNS words
MIN_WORDS = 20  # documents with fewer are not drawn
PERCENT = 10    # of the others, so many in a hundred are
SEED = 2024
SKETCH_K = 800      # size of the quantile sketches
SKETCH_PARTS = 64   # of which so many are merged in the end
MARGIN = 0.01       # first half-width of the bracket, in ranks

_SLICE = 1 << 18
_STEP = 32  # bytes of a word that are hashed column by column

_WORD = np.zeros(256, dtype=bool)
_WORD[0x30:0x3A] = _WORD[0x41:0x5B] = _WORD[0x61:0x7B] = _WORD[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def _crc_on(state: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Running crc32 states (inverted form) taken on over byte spans."""
    lengths = ends - starts
    order = np.argsort(-np.minimum(lengths, _STEP).astype(np.int8), kind="stable")
    now, at, left = state[order], starts[order], lengths[order]
    for k in range(min(_STEP, int(left.max(initial=0)))):
        n = int(np.searchsorted(-np.minimum(left, _STEP), -k, "left"))
        now[:n] = _CRC[(now[:n] ^ data[at[:n] + k]) & 0xFF] ^ (now[:n] >> np.uint32(8))
    for i in np.flatnonzero(left > _STEP):
        rest = data[at[i] + _STEP:at[i] + left[i]].tobytes()
        now[i] = np.uint32(zlib.crc32(rest, int(now[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF)
    out = np.empty_like(now)
    out[order] = now
    return out


def feature_buckets(data: np.ndarray, offsets: np.ndarray, runs: int, buckets: int
                    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features of the texts in `data`, the text of each, and
    the number of words per text."""
    data = _LOWER[data]
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = _WORD[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    here = inside[1:-1]
    starts = np.flatnonzero(here & (~inside[:-2] | edge[:-1]))
    ends = np.flatnonzero(here & (~inside[2:] | edge[1:])) + 1
    text = np.searchsorted(offsets, starts, "right") - 1
    state, owners, out, where = np.full(len(starts), 0xFFFFFFFF, np.uint32), text, [], []
    for r in range(min(runs, max(1, len(starts)))):
        if r:  # the runs of r words, one space, and the word after
            go_on = text[r:] == text[:len(text) - r]
            state = state[:len(go_on)]
            state = _CRC[(state ^ np.uint32(0x20)) & 0xFF] ^ (state >> np.uint32(8))
            state = _crc_on(state, data, starts[r:], ends[r:])
            keep, owners = go_on, text[:len(go_on)][go_on]
        else:
            state, keep = _crc_on(state, data, starts, ends), slice(None)
        out.append(((state[keep] ^ np.uint32(0xFFFFFFFF)) % np.uint32(buckets)).astype(np.int64))
        where.append(owners)
    return np.concatenate(out), np.concatenate(where), np.bincount(text, minlength=len(offsets) - 1)


def _slices(col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from, to, bytes, offsets) of a text column in bounded slices; a longer
    text is a slice of its own, a null text is empty."""
    col = col.cast(pa.large_string()).fill_null("")
    bufs, n = col.buffers(), len(col)
    offsets = np.frombuffer(bufs[1], dtype=np.int64)[col.offset:col.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None else np.empty(0, np.uint8)
    i = 0
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(offsets, offsets[i] + _SLICE, "right")) - 1))
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def bucket_counts(df: DataFrame, runs: int = RUNS, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall in each bucket.  Tasks count into
    an array of the buckets; one row per bucket reaches the driver."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, data, offsets in _slices(batch.column(0)):
                total += np.bincount(feature_buckets(data, offsets, runs, buckets)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    bounded_batches(df.sparkSession)
    rows = df.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in rows.collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket the floor of 1000 times the log ratio of its smoothed shares."""
    n = float(len(corpus))
    up = (target + 1.0) * (corpus.sum() + n)
    return np.floor(1000.0 * np.log(up / ((corpus + 1.0) * (target.sum() + n)))).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, runs: int = RUNS) -> DataFrame:
    """(doc_id, n_words, n_features, weight) per document."""
    buckets = len(gain)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            words, features, weight = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            for i, j, data, offsets in _slices(batch.column(1)):
                bucket, text, words[i:j] = feature_buckets(data, offsets, runs, buckets)
                features[i:j] = np.bincount(text, minlength=j - i)
                # sums of integers far below 2^53 are exact in doubles
                total = np.bincount(text, weights=gain[bucket], minlength=j - i).astype(np.int64)
                weight[i:j] = total // np.maximum(features[i:j], 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words), pa.array(features), pa.array(weight)],
                names=["doc_id", "n_words", "n_features", "weight"])

    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        score, "doc_id long, n_words long, n_features long, weight long")


def gumbel_score(seed: int) -> Column:
    """weight plus 1000 times Gumbel noise drawn from a hash of the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    noise = F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))
    return F.col("weight") + F.floor(F.lit(-1000.0) * noise).cast("long")


_ORDER = ["score", "doc_id", "n_features"]  # greatest score, then least id (null last), then fewest features


def _order() -> list[Column]:
    return [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features").asc()]


def _bracket(rows: DataFrame, n: int, k: int) -> tuple[int, int, int]:
    """Scores (low, high) with the k-th greatest among them, and how many rows
    lie above.  The sketch only proposes; exact counts decide."""
    sketches = rows.groupBy(F.pmod(F.spark_partition_id(), F.lit(SKETCH_PARTS)).alias("p")).agg(
        F.kll_sketch_agg_bigint("score", F.lit(SKETCH_K)).alias("s"))
    margin = MARGIN
    merged = materialize(sketches.agg(F.kll_merge_agg_bigint("s").alias("s")), "resampling-sketch")
    lowest, highest = rows.agg(F.min("score"), F.max("score")).first()
    while True:
        ends = [max(0.0, (n - k) / n - margin), min(1.0, (n - k) / n + margin)]
        low, high = merged.select(*[F.kll_sketch_get_quantile_bigint("s", F.lit(p)) for p in ends]).first() \
            if margin < 1 else (lowest, highest)
        above, among = rows.agg(F.count_if(F.col("score") > high),
                                F.count_if(F.col("score").between(low, high))).first()
        if above < k <= above + among:
            return low, high, above
        margin *= 4


def draw(weighted: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank): of the documents with at
    least `min_words` words the floor of `percent` in a hundred with the
    greatest scores, ranked from 1; rank is null for all others."""
    scored = materialize(weighted.withColumn("score", gumbel_score(seed)), "resampling-scores")
    fits = F.col("n_words") >= min_words
    rows = scored.filter(fits)
    n = rows.count()
    k = percent * n // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    if not k:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    low, high, above = _bracket(rows.select("score"), n, k)
    among = with_positions(rows.filter(F.col("score").between(low, high)).select(*_ORDER), _order(),
                           position="at", name="resampling-bracket")
    cut = among.filter(F.col("at") == k - above - 1).first()
    # rows up to the cutoff in the order, among them all that tie with it
    ahead = F.when(F.col("score") != cut["score"], F.col("score") > cut["score"])
    same = F.col("doc_id").eqNullSafe(F.lit(cut["doc_id"]).cast("long"))
    before = F.col("doc_id").isNotNull() if cut["doc_id"] is None \
        else F.coalesce(F.col("doc_id") < F.lit(cut["doc_id"]), F.lit(False))
    drawn = fits & ahead.when(same, F.col("n_features") <= cut["n_features"]).otherwise(before)
    ranked = with_positions(scored.filter(drawn).select(*columns), _order(), position="at", name="resampling-drawn")
    place = (F.col("at") + 1).cast("long")
    return ranked.select(*columns, F.when(place <= k, place).alias("rank")).unionByName(
        scored.filter(~drawn).select(*columns, F.lit(None).cast("long").alias("rank")))


def resample(docs: DataFrame, target: DataFrame, runs: int = RUNS, buckets: int = BUCKETS, percent: int = PERCENT,
             min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """Documents drawn towards the texts of `target`: one row per document with
    n_features, weight, score and rank (null when not drawn).

    A null or empty text has no feature and weight 0.  Texts of any length are
    read whole.  A null id hashes as the empty text and loses ties.  Repeated
    rows are rows of their own; rows that tie in score and id are taken by
    fewest features, and beyond that are alike.  Empty tables give no rows (or,
    for `target`, shares from smoothing alone); other columns are not read.
    """
    gain = gains(bucket_counts(docs, runs, buckets), bucket_counts(target, runs, buckets))
    return draw(weigh(docs, gain, runs), percent, min_words, seed)
