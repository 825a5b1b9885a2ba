"""Language identification by mixture inference.

A document is taken for a mixture: each of its words comes from one of the
languages, drawn by the document's proportions, with the likelihood of the
word's letter trigrams in that language.  Expectation-maximisation estimates
the proportions; which languages the document has is then decided by
likelihood less a penalty per language, over the sets of the one best, two best,
... languages, each with its own estimate.  Documents are worked on together:
every step is one pass over the words of a slice of texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import bounded_batches

BUCKETS = 1 << 16    # hashed trigrams
SMOOTHING = 0.5      # added to the count of each
STEPS = 20           # most steps of one estimate
SETTLED = 1e-3       # it ends when no proportion moves by more
# Words repeat and their trigrams overlap, so likelihoods overstate what they
# know: a language must pay more than the half log of the plain criterion.
PENALTY = 3.0        # times the log of the words, per further language
MAX_LANGUAGES = 256  # the model has BUCKETS x languages values (64 MB at most); beyond, an error

_SLICE = 1 << 18
_WORDS = 1 << 16     # words that are worked on at a time

_CLASS = np.zeros(256, dtype=np.int64)  # 0: no letter
_CLASS[0x61:0x7B] = np.arange(1, 27)
_CLASS[0x80:] = np.arange(27, 155)
_N = 155


class Words:
    """Words (runs of letters) of a slice of lower-cased texts, and the bucket
    of the trigram around each letter; a word's ends count as a symbol."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        kind = np.zeros(len(data) + 2, dtype=np.int64)
        kind[1:-1] = _CLASS[data]
        first_byte = np.zeros(len(data) + 1, dtype=bool)
        first_byte[offsets] = True
        here = kind[1:-1]
        before = np.where(first_byte[:-1], 0, kind[:-2])
        after = np.where(first_byte[1:], 0, kind[2:])
        letters = np.flatnonzero(here)
        key = ((before * _N + here) * _N + after)[letters].astype(np.uint64)
        self.buckets = ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int64)
        starts = np.flatnonzero(before[letters] == 0)
        #: letter k of word w has first_letter[w] <= k < first_letter[w + 1]
        self.first_letter = np.append(starts, len(letters))
        #: word w of text t has first_word[t] <= w < first_word[t + 1]
        self.first_word = np.searchsorted(letters[starts] if len(starts) else starts, offsets)
        self.text_of_letter = np.searchsorted(offsets, letters, "right") - 1


def slices(col: pa.Array) -> Iterator[tuple[int, int, Words]]:
    """(from, to, words) over a text column; a null text is empty.  A text
    longer than a slice is one of its own."""
    col = pc.utf8_lower(col.cast(pa.large_string()).fill_null(""))
    bufs, n = col.buffers(), len(col)
    offsets = np.frombuffer(bufs[1], dtype=np.int64)[col.offset:col.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None else np.empty(0, np.uint8)
    i = 0
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(offsets, offsets[i] + _SLICE, "right")) - 1))
        yield i, j, Words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
        i = j


def learn(rows: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages (ascending) and log likelihoods (bucket, language) from the
    texts of `rows` and their non-null `lang`.

    Tasks count (language, bucket) pairs; the sums, at most BUCKETS rows a
    language, reach the driver once the number of languages has been checked.
    """
    rows = rows.filter(F.col("lang").isNotNull())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            coded = batch.column(1).dictionary_encode()
            names, codes = coded.dictionary.to_pylist(), np.asarray(coded.indices)
            for i, j, words in slices(batch.column(0)):
                lang = codes[i:j][words.text_of_letter]
                pairs = np.bincount(lang * BUCKETS + words.buckets, minlength=len(names) * BUCKETS)
                for name, found in zip(names, pairs.reshape(len(names), BUCKETS)):
                    if name in totals:
                        totals[name] += found
                    else:
                        totals[name] = found.copy()
        for name, found in totals.items():
            some = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(some), pa.string()), pa.array(some), pa.array(found[some])],
                names=["lang", "bucket", "n"])

    languages = sorted(r[0] for r in rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    counts = rows.select("text", "lang").mapInArrow(count, "lang string, bucket long, n long") \
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    table = np.full((BUCKETS, len(languages)), SMOOTHING)
    place = {name: k for k, name in enumerate(languages)}
    table[counts["bucket"], counts["lang"].map(place)] += counts["n"].to_numpy()
    return languages, np.log(table / table.sum(0, keepdims=True)).astype(np.float32)


def _word_scores(words: Words, model: np.ndarray) -> np.ndarray:
    """Log likelihood of each word in each language."""
    first, n = words.first_letter, len(words.first_letter) - 1
    out = np.empty((n, model.shape[1]), np.float32)
    for a in range(0, n, _WORDS):
        b = min(n, a + _WORDS)
        lo, hi = first[a], first[b]
        out[a:b] = np.add.reduceat(model[words.buckets[lo:hi]], first[a:b] - lo, axis=0)
    return out


def _sums(blocks: Iterator[tuple[int, int, np.ndarray]], first: np.ndarray, shape: tuple) -> np.ndarray:
    """Sums per document of values that come in blocks of words."""
    out = np.zeros(shape)
    for a, b, values in blocks:
        lo, hi = int(np.searchsorted(first, a, "right")) - 1, int(np.searchsorted(first, b, "left"))
        cuts = np.maximum(first[lo:hi], a) - a
        out[lo:hi] += np.add.reduceat(values, cuts, axis=0)
    return out


def estimate(weight: np.ndarray, peak: np.ndarray, first: np.ndarray, share: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation from the proportions `share` (a zero stays
    zero); returns them and each document's log likelihood.  `weight` is a
    word's likelihood over its greatest one, exp(`peak`)."""
    n = np.diff(first)
    doc = np.repeat(np.arange(len(n)), n)

    def blocks(share: np.ndarray, posterior: bool) -> Iterator[tuple[int, int, np.ndarray]]:
        for a in range(0, len(weight), _WORDS):
            b = min(len(weight), a + _WORDS)
            joint = weight[a:b] * share[doc[a:b]].astype(np.float32)
            total = np.maximum(joint.sum(1), np.float32(1e-30))
            yield a, b, joint / total[:, None] if posterior else np.log(total) + peak[a:b]

    for _ in range(STEPS):
        new = _sums(blocks(share, True), first, share.shape) / n[:, None]
        moved = np.abs(new - share).max(initial=0.0)
        share = new
        if moved <= SETTLED:
            break
    return share, _sums(blocks(share, False), first, (len(n),))


def infer(scores: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Proportions (document, language) over the chosen set of languages, for
    documents that have a word each."""
    n, count = np.diff(first), scores.shape[1]
    peak = scores.max(1)
    weight = np.exp(scores - peak[:, None])
    alone = _sums(((a, min(len(scores), a + _WORDS), scores[a:a + _WORDS])
                   for a in range(0, len(scores), _WORDS)), first, (len(n), count))
    best = np.zeros((len(n), count))
    best[np.arange(len(n)), alone.argmax(1)] = 1.0
    value = alone.max(1)
    free, _ = estimate(weight, peak, first, np.full((len(n), count), 1.0 / count))
    rank = np.argsort(np.argsort(-free, axis=1, kind="stable"), axis=1)
    cost = PENALTY * np.log(n + 1.0)
    active = np.arange(len(n))
    for size in range(2, count + 1):
        # the documents that the last language helped are tried with one more
        lengths = n[active]
        at = np.concatenate(([0], np.cumsum(lengths)))
        word = np.repeat(first[active] - at[:-1], lengths) + np.arange(at[-1])
        start = np.where(rank[active] < size, np.maximum(free[active], 1e-3), 0.0)
        share, likelihood = estimate(weight[word], peak[word], at, start / start.sum(1, keepdims=True))
        likelihood -= cost[active] * (size - 1)
        better = likelihood > value[active]
        active, share = active[better], share[better]
        value[active], best[active] = likelihood[better], share
        if not len(active):
            break
    return best


def predict(docs: DataFrame, languages: list[str], model: np.ndarray) -> DataFrame:
    """`docs` (doc_id, text, held_out) with lang_pred, score (its proportion)
    and languages (all of the chosen set with their proportions)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, score, mixture = ["und"] * batch.num_rows, np.zeros(batch.num_rows), [""] * batch.num_rows
            lettered = np.asarray(batch.column(3).fill_null(False))
            for i, j, words in slices(batch.column(1)):
                known = np.flatnonzero((np.diff(words.first_word) > 0) & lettered[i:j]) if languages else []
                if not len(known):
                    continue
                scores = _word_scores(words, model)
                lengths = np.diff(words.first_word)[known]
                first = np.concatenate(([0], np.cumsum(lengths)))
                if len(known) < j - i:
                    scores = scores[np.repeat(words.first_word[known] - first[:-1], lengths) + np.arange(first[-1])]
                shares = infer(scores, first)
                for at, share in zip(known + i, shares):
                    top = int(share.argmax())
                    label[at], score[at] = languages[top], min(1.0, share[top])
                    order = [k for k in np.argsort(-share, kind="stable") if share[k] >= 0.005]
                    mixture[at] = ",".join(f"{languages[k]}:{share[k]:.2f}" for k in order)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(label, pa.string()), pa.array(score),
                 pa.array(mixture, pa.string())],
                names=["doc_id", "held_out", "lang_pred", "score", "languages"])

    letter = F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False))
    return docs.select("doc_id", "text", "held_out", letter.alias("lettered")).mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double, languages string")


def identify(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score and languages.

    The model learns from texts with a language whose crc32(doc_id as text) is
    not 2 modulo 4; predictions read the text alone.  A null text, one without a
    letter (`\\p{L}`) and every text when nothing could be learnt are `und` with
    score 0.  A null id counts as the empty text (not held out).  Ties go to the
    first language by name.  A very long text is read whole: memory is four
    bytes a word and language beside its own bytes.  Repeated rows get equal
    answers; an empty table gives no rows; other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang",
                       (F.crc32(ident) % 4 == 2).alias("held_out"))
    languages, model = learn(rows.filter(~F.col("held_out")))
    return predict(rows, languages, model)
