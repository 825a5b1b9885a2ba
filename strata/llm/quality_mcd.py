"""Quality rules: robust multivariate outliers by minimum covariance determinant.

Each text gives a vector of transformed statistics.  For every language and
source the minimum-covariance-determinant estimate (the centre and scatter of
the half of the rows with the least scatter) is found by concentration steps
from three starts, of which the least determinant is kept; it is then refined
by all rows near it.  A row is rejected when its Mahalanobis distance under the
refined estimate is beyond a chi-square cut.  Resting on half of the rows, the
estimate withstands junk of one kind in up to almost half of a group.

The starts are fixed by the data: the medians and quartiles, the shortest half
of each statistic, and the shortest halves along the principal axes of the
directions from that centre.

Every step runs over all rows: quantiles and counts per group are aggregates,
the subset of a step is a cut in a histogram of distances (so no group is
sorted or collected), and only one small row per group and start reaches Python
to be inverted.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm import textbatch as tb
from strata.llm.common import bounded_batches, clashes, materialize, own

MIN_WORDS = 50        # base rule: fewer words fail
MAX_REPEAT = 50       # base rule: per cent of words in repeated 3-word windows
SUPPORT = 0.5         # share of a group's rows that an estimate rests on
REFINE = 0.975        # share of clean rows that the refined estimate rests on
GRID = 40             # quantile steps of a start, a multiple of 4
MIN_GROUP = 200       # smaller groups are pooled by language, then altogether
STEPS = 5             # concentration steps
CUT_Z = 3.4           # normal deviate of the chi-square cut
BINS = 32             # histogram bins per doubling of a distance

# Statistics of a vector and the least spread each may have, in its own unit:
# below it, differences are the writer's business and not an outlier's.
FEATURES = {
    "word_length": 0.12,   # log of code points per word
    "symbols": 0.035,      # arcsine root of symbols per code point in words
    "dup_lines": 0.40,     # arcsine root of repeated lines per line with a word
    "repeats": 0.25,       # arcsine root of words in repeated 3-word windows
    "capitals": 0.08,      # arcsine root of capitals per ASCII letter
    "stops": 0.10,         # arcsine root of sentence marks per word
}
DIM = len(FEATURES)

_LEAD = np.ones(256, dtype=bool)
_LEAD[0x80:0xC0] = False
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[0x41:0x5B] = True
_LETTER = _UPPER.copy()
_LETTER[0x61:0x7B] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[list(b".!?")] = True
_FULL = ~tb._BLANK

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_upper", "n_letters", "n_stops"]


def text_counts(col: pa.Array) -> pa.Array:
    """The counts of each text; null counts as empty."""
    out = {c: [] for c in COUNTS}
    for _, _, t in tb.slices_of(col):
        out["n_words"].append(t.n_words)
        out["word_chars"].append(t.totals(_LEAD[t.data] & _FULL[t.data]))
        out["n_symbols"].append(t.totals(_SYMBOL[t.data]))
        out["n_upper"].append(t.totals(_UPPER[t.data]))
        out["n_letters"].append(t.totals(_LETTER[t.data]))
        out["n_stops"].append(t.totals(_STOP[t.data]))
        lines, repeated = _dup_lines(t)
        out["n_lines"].append(lines)
        out["n_dup_lines"].append(repeated)
        out["n_repeat_words"].append(_repeat_words(t))
    arrays = [pa.array(np.concatenate(out[c]) if out[c] else np.empty(0), pa.int64()) for c in COUNTS]
    return pa.StructArray.from_arrays(arrays, names=COUNTS)


def _salted(values: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Hashes that are equal only within one text."""
    return tb.mix(values ^ tb.mix(text.astype(np.uint64) + np.uint64(1)))


def _dup_lines(t: tb.Texts) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = t.lines()
    has = np.searchsorted(t.starts, ends) > np.searchsorted(t.starts, starts)
    text = np.repeat(np.arange(t.n), np.diff(first))[has]
    keys = _salted(tb.hash_spans(t.data, starts[has], ends[has]), text)
    order = np.argsort(keys, kind="stable")
    again = np.zeros(len(keys), dtype=bool)
    again[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    return np.bincount(text, minlength=t.n), np.bincount(text[again], minlength=t.n)


def _repeat_words(t: tb.Texts) -> np.ndarray:
    hashes, at = t.windows(3)
    if not len(at):
        return np.zeros(t.n, dtype=np.int64)
    keys = _salted(hashes, t.text_of_word[at])
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    twice = np.zeros(len(keys), dtype=bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    word = np.zeros(len(t.starts), dtype=bool)
    for k in range(3):
        word[at[twice] + k] = True
    run = np.concatenate(([0], np.cumsum(word)))
    return run[t.first[1:]] - run[t.first[:-1]]


# Marked so that the planner evaluates it once per row: it would otherwise copy
# it into the filter on its own result, at the price of a second Python worker.
_counts_udf = F.arrow_udf(text_counts, T.StructType(
    [T.StructField(c, T.LongType()) for c in COUNTS])).asNondeterministic()


def _share(a: str, b: str) -> F.Column:
    ratio = F.col(a) / F.greatest(F.col(b), F.lit(1))
    return F.asin(F.sqrt(F.least(ratio, F.lit(1.0))))


def _vector() -> list:
    return [
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1))),
        _share("n_symbols", "word_chars"),
        _share("n_dup_lines", "n_lines"),
        _share("n_repeat_words", "n_words"),
        _share("n_upper", "n_letters"),
        _share("n_stops", "n_words"),
    ]


def _base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs plus the five counts of the contract, base_failed and the vector v."""
    bounded_batches(docs.sparkSession)
    got = own("counts")
    df = clashes(docs, *COUNTS, "base_failed", "v").withColumn(got, _counts_udf(F.col(text_col)))
    df = df.select("*", *[F.col(got)[c].alias(c) for c in COUNTS]).drop(got)
    return df.withColumn("base_failed", _base_failed()).withColumn("v", F.array(*_vector()))


# --------------------------------------------------------------- estimates

def _distance(v: str = "v"):
    """Squared length of W (v - centre), W lower triangular by rows."""
    z = [F.col(v)[i] - F.col("centre")[i] for i in range(DIM)]
    total, k = F.lit(0.0), 0
    for i in range(DIM):
        row = F.lit(0.0)
        for j in range(i + 1):
            row = row + F.col("whiten")[k] * z[j]
            k += 1
        total = total + row * row
    return total


def _bin(d):
    return F.floor(F.log2(F.greatest(d, F.lit(1e-6))) * BINS).cast("int")


def _cuts(scored: DataFrame, share: float) -> DataFrame:
    """(grp, cut): the histogram bin that holds the given share of a group."""
    # stored first: counted by (group, bin), so that a group's tasks' counts do
    # not meet in the one task that then cuts its short histogram
    hist = materialize(scored.groupBy("grp", "bin").agg(F.count(F.lit(1)).alias("c")), "op2-histogram")
    w = Window.partitionBy("grp")
    upto = w.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    return (hist.select("grp", "bin", F.sum("c").over(upto).alias("below"), F.sum("c").over(w).alias("n"))
            .filter(F.col("below") >= F.ceil(F.col("n") * share))
            .groupBy("grp").agg(F.min("bin").alias("cut")))


def _moments(kept: DataFrame) -> DataFrame:
    v = [F.col("v")[i] for i in range(DIM)]
    sums = [F.sum(v[i]).alias(f"s{i}") for i in range(DIM)]
    prods = [F.sum(v[i] * v[j]).alias(f"p{i}_{j}") for i in range(DIM) for j in range(i + 1)]
    return kept.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), *sums, *prods)


def _products(r: dict) -> np.ndarray:
    """The mean products of a row of moments."""
    out = np.empty((DIM, DIM))
    for i in range(DIM):
        for j in range(i + 1):
            out[i, j] = out[j, i] = r[f"p{i}_{j}"] / r["n"]
    return out


def _estimator(share: float):
    def run(frames):
        """Centre and whitening matrix of each group's moments, floors applied."""
        for pdf in frames:
            out = []
            for r in pdf.to_dict("records"):
                mean = np.array([r[f"s{i}"] for i in range(DIM)]) / r["n"]
                # the subset of the least distances understates the spread
                cov = (_products(r) - np.outer(mean, mean)) * _consistency(share)
                out.append((r["grp"], mean.tolist(), _whiten(cov)))
            yield pd.DataFrame(out, columns=["grp", "centre", "whiten"])
    return run


_estimates = _estimator(SUPPORT)


def _whiten(cov: np.ndarray) -> list[float]:
    floor = np.array(list(FEATURES.values())) ** 2
    return _rows(np.linalg.inv(np.linalg.cholesky(cov + np.diag(floor))))


def _rows(w: np.ndarray) -> list[float]:
    return [float(w[i, j]) for i in range(DIM) for j in range(i + 1)]


def _chi2(p: int, z: float) -> float:
    """Chi-square quantile at a normal deviate (Wilson and Hilferty)."""
    return p * (1 - 2 / (9 * p) + z * math.sqrt(2 / (9 * p))) ** 3


def _consistency(share: float) -> float:
    """share / P(chi2_{p+2} <= q) with q the chi2_p quantile of the share."""
    q, p = _chi2(DIM, NormalDist().inv_cdf(share)), DIM + 2
    t = ((q / p) ** (1 / 3) - (1 - 2 / (9 * p))) / math.sqrt(2 / (9 * p))
    return share / (0.5 * (1 + math.erf(t / math.sqrt(2))))


# ------------------------------------------------------------------ starts

_EST = "grp string, centre array<double>, whiten array<double>"
_DIAGONAL = [i * (i + 3) // 2 for i in range(DIM)]


def _quantiles(rows: DataFrame, axes: list) -> DataFrame:
    steps = [k / GRID for k in range(GRID + 1)]
    return rows.groupBy("grp").agg(*[F.percentile_approx(c, steps, 1000).alias(f"q{i}") for i, c in enumerate(axes)])


def _shortest_half(q: np.ndarray) -> tuple[float, float]:
    """Centre and spread of the shortest interval between quantiles that holds
    half of the rows; of equal ones the middle one."""
    half = GRID // 2
    width = q[half:] - q[:-half]
    k = np.flatnonzero(width <= width.min() + 1e-12)
    k = int(k[len(k) // 2])
    return float(q[k + half // 2]), float(width[k]) / 1.349


def _axis_starts(frames):
    """Starts 0 (medians and quartiles) and 1 (shortest halves) of each group;
    the start's number and a colon come before the group."""
    for pdf in frames:
        out = []
        for r in pdf.to_dict("records"):
            q = [np.array(r[f"q{i}"], dtype=float) for i in range(DIM)]
            middle = [(x[GRID // 2], (x[3 * GRID // 4] - x[GRID // 4]) / 1.349) for x in q]
            for k, pairs in enumerate((middle, [_shortest_half(x) for x in q])):
                centre, spread = map(np.array, zip(*pairs))
                out.append((f"{k}:{r['grp']}", centre.tolist(), _whiten(np.diag(spread ** 2))))
        yield pd.DataFrame(out, columns=["grp", "centre", "whiten"])


def _axes(frames):
    """Principal axes of each group's directions, by rows."""
    for pdf in frames:
        yield pd.DataFrame([(r["grp"], np.linalg.eigh(_products(r))[1].T.ravel().tolist())
                            for r in pdf.to_dict("records")], columns=["grp", "axes"])


def _turned_start(frames):
    """Start 2 of each group: shortest halves along its axes."""
    for pdf in frames:
        out = []
        for r in pdf.to_dict("records"):
            centre, spread = map(np.array, zip(*[_shortest_half(np.array(r[f"q{i}"], dtype=float))
                                                 for i in range(DIM)]))
            scale = 1 / np.array(r["whiten"])[_DIAGONAL]
            turn = scale[:, None] * np.array(r["axes"]).reshape(DIM, DIM).T
            out.append((f"2:{r['grp']}", (np.array(r["centre"]) + turn @ centre).tolist(),
                        _whiten(turn @ np.diag(spread ** 2) @ turn.T)))
        yield pd.DataFrame(out, columns=["grp", "centre", "whiten"])


def _starts(rows: DataFrame) -> DataFrame:
    """(grp, centre, whiten) of each group's starts."""
    v = [F.col("v")[i] for i in range(DIM)]
    by_axis = materialize(_quantiles(rows, v).mapInPandas(_axis_starts, _EST), "op2-starts")
    halves = by_axis.filter(F.col("grp").startswith("1:")).withColumn("grp", F.expr("substring(grp, 3)"))
    z = rows.join(halves, "grp").select("grp", F.array(*[
        F.col("whiten")[k] * (x - F.col("centre")[i]) for i, (k, x) in enumerate(zip(_DIAGONAL, v))]).alias("v"))
    length = F.sqrt(F.greatest(sum((x * x for x in v), F.lit(0.0)), F.lit(1e-12)))
    signs = z.select("grp", F.array(*[x / length for x in v]).alias("v"))
    axes = materialize(_moments(signs).mapInPandas(_axes, "grp string, axes array<double>"), "op2-axes")
    along = [sum((F.col("axes")[k * DIM + i] * v[i] for i in range(DIM)), F.lit(0.0)) for k in range(DIM)]
    turned = _quantiles(z.join(axes, "grp"), along).join(halves, "grp").join(axes, "grp")
    return by_axis.unionByName(turned.mapInPandas(_turned_start, _EST))


def _group(lang: str, source: str):
    """Text keys of a row's three pools, null-safe."""
    return (F.to_json(F.struct(F.col(lang).alias("l"), F.col(source).alias("s"))),
            F.to_json(F.struct(F.col(lang).alias("lang"))), F.lit("all"))


def fit(stats: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(g1, grp, centre, whiten) for each language and source of a statistics
    table; grp names the pool that the estimate rests on."""
    g1, g2, g3 = _group(lang_col, source_col)
    rows = stats.filter(~F.col("base_failed")).select(g1.alias("g1"), g2.alias("g2"), "v")
    # pools: a group below MIN_GROUP rows joins its language's pool
    n1 = rows.groupBy("g1", "g2").agg(F.count(F.lit(1)).alias("n"))
    named = n1.withColumn("pool", F.when(F.col("n") >= MIN_GROUP, F.col("g1")).otherwise(F.col("g2")))
    n2 = named.groupBy("pool").agg(F.sum("n").alias("m"))
    pools = materialize(
        named.join(n2, "pool").select("g1", F.when(F.col("m") >= MIN_GROUP, F.col("pool")).otherwise(g3)
                                      .alias("grp")), "op2-pools")
    rows = rows.join(pools, "g1").select("grp", "v")

    est = materialize(_starts(rows), "op2-start")
    rows = rows.withColumnRenamed("grp", "pool")
    for step in range(STEPS):
        keyed = est.withColumn("pool", F.expr("substring(grp, 3)"))
        scored = rows.join(keyed, "pool").select("grp", "v", _bin(_distance()).alias("bin"))
        kept = scored.join(_cuts(scored, SUPPORT), "grp").filter("bin <= cut")
        est = materialize(_moments(kept).mapInPandas(_estimates, _EST), f"op2-step{step}")
    # the least determinant is the greatest product of the whitening diagonal
    size = sum((F.log(F.col("whiten")[k]) for k in _DIAGONAL), F.lit(0.0))
    best = est.groupBy(F.expr("substring(grp, 3)").alias("pool")).agg(
        F.max_by(F.struct("centre", "whiten"), F.struct(F.round(size, 9), "grp")).alias("e"))
    best = materialize(best.select("pool", "e.centre", "e.whiten"), "op2-best")
    near = rows.join(best, "pool").filter(_distance() <= _chi2(DIM, NormalDist().inv_cdf(REFINE)))
    est = materialize(_moments(near.select(F.col("pool").alias("grp"), "v"))
                      .mapInPandas(_estimator(REFINE), _EST), "op2-refined")
    return pools.join(est, "grp")


def assess(stats: DataFrame, model: DataFrame, lang_col: str = "lang",
           source_col: str = "source") -> DataFrame:
    """stats plus distance (null where no estimate applies) and kept."""
    g1, _, _ = _group(lang_col, source_col)
    joined = stats.withColumn("g1", g1).join(model.drop("grp"), "g1", "left")
    d = F.when(~F.col("base_failed"), F.sqrt(_distance()))
    return (joined.withColumn("distance", d).drop("g1", "centre", "whiten")
            .withColumn("kept", ~F.col("base_failed")
                        & (F.coalesce("distance", F.lit(0.0)) <= math.sqrt(_chi2(DIM, CUT_Z)))))


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, distance), one row per input row.

    Null and empty texts have no word and fail the base rules.  Null languages
    and sources are groups of their own.  Repeated rows count as often as they
    occur.  Without any row that passes the base rules nothing is fitted and
    only the base rules decide.  Other columns of the input are not read.
    """
    slim = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"),
                       F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    stats = materialize(with_statistics(slim).drop("text"), "op2-stats")
    return assess(stats, fit(stats)).select(
        F.col("id").alias(id_col), *COUNTS[:5], "base_failed", "kept", "distance")


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
              source_col: str = "source") -> DataFrame:
    """The input rows that pass, with the input's columns.  The statistics are
    counted once for the fit and once beside the texts, which never shuffle."""
    stats = docs.select(F.col(lang_col).alias("lang"), F.col(source_col).alias("source"),
                        F.col(text_col).alias("text"))
    model = materialize(fit(materialize(with_statistics(stats).drop("text"), "op2-stats")), "op2-model")
    row = own("row")
    names = [F.col(f"{row}.`{c}`").alias(c) for c in docs.columns]
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row),
                       F.col(lang_col).alias("lang"), F.col(source_col).alias("source"),
                       F.col(text_col).alias("text"))
    return assess(with_statistics(held), model).filter("kept").select(*names)
