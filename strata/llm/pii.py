"""Personal data by candidate gradient boosting, in DataFrame functions only.

High-recall patterns propose spans, some of which overlap.  The base kinds
(email, ip, card, phone) are fixed by the contract: every proposal that passes
its format check is redacted.  The other proposals (numbers that look like
telephone or account numbers, written-out addresses) are scored by boosted
regression trees over format and context features.  Positive examples are the
proposals that carry a base span, and the base spans themselves with their
telling mark masked ("+" left out, "@" written out), so that the trees learn
the look and the surroundings of such data and not the mark.  Negative are
only those that contradict: too few digits, dates, glued to letters, a failed
check, or words before them that name other things.  All others have no label:
they neither train nor count as errors, and the score decides on them.  The
trees learn from all candidates of the corpus, as counts per feature vector:
the features are small integers, and the driver gets one row per vector that
occurs, at most the product of their ranges.

A fifth of the documents (by hash of the text) is held out; the threshold is
the least score, 0 at least, from which on held-out labelled proposals are
right often enough.

Positions come from the pieces between matches: `split` gives the text
between, `regexp_extract_all` the matches, and running lengths the offsets.
Possessive quantifiers keep each pattern linear, also on very long texts.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialize

ROUNDS = 20           # trees
RATE = 0.3            # shrinkage of a tree
PRECISION = 0.98      # least share of right redactions among held-out proposals
MIN_HELD_OUT = 20     # fewer held-out proposals above a threshold prove nothing
CONTEXT = 24          # code points before a proposal that are read for context

KINDS = ("email", "ip", "card", "phone")
MORE = ("number", "digits", "address")

# The base patterns of the contract, in possessive form (the
# look-behinds say that a run is entered at its start, as leftmost matching does).
_BYTE = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # a maximal chain of digits with single separators, of 12 to 19 digits
    "card": r"[0-9](?<![0-9][0-9])(?<![0-9][\x20-][0-9])(?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "number": r"[0-9(](?<![0-9A-Za-z+.(][0-9(])[0-9]{1,4}+\)?+(?:[\x20./-][0-9]{2,5}+){1,4}+(?![0-9A-Za-z])",
    "digits": r"[0-9](?<![0-9A-Za-z][0-9])[0-9]{8,18}+(?![0-9A-Za-z])",
    "address": (r"[A-Za-z0-9._%+-]{1,64}+\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]{1,63}+"
                r"(?:\x20?(?:\.|[(\[]dot[)\]])\x20?[A-Za-z0-9-]{1,63}+){1,4}+"),
}
# What a text must hold for a pattern to be tried.
NEEDS = {"email": "@", "phone": "\\+[0-9]", "address": "[(\\[]at[)\\]]"}

CONTACT = r"(?i)(?:\btel|phone|mobile|\bcell|\bcall|\bfax|contact|mail|whatsapp)"
MONEY = r"(?i)(?:card|visa|master|amex|account|iban|payment|\bcvv)"
# Dates and times of day.
DATE = r"^(?:[0-9]{4}[./-][0-9]{1,2}[./-][0-9]{1,2}|[0-9]{1,2}[./-][0-9]{1,2}[./-](?:[0-9]{4}|[0-9]{2}))$"
THINGS = r"(?i)(?:order|invoice|version|isbn|\bref|page|total|\bno\.|ticket|serial|item|release)"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(c: Column) -> Column:
    """Whether the digits of a short string pass Luhn's check."""
    rev = F.reverse(_digits(c))

    def add(total, i):
        d = F.substring(rev, i, F.lit(1)).cast("int")
        twice = F.when(i % 2 == 0, d * 2).otherwise(d)
        return total + F.when(twice > 9, twice - 9).otherwise(twice)
    return F.aggregate(F.sequence(F.lit(1), F.length(rev)), F.lit(0), add) % 10 == 0


def _valid(kind: str, c: Column) -> Column:
    if kind == "ip":
        return c.rlike("^" + r"\.".join([_BYTE] * 4) + "$")
    if kind == "card":
        return _luhn(c)
    if kind == "phone":
        return F.length(_digits(c)).between(9, 15)
    return F.lit(kind == "email")


def _pieces(text: Column, kind: str) -> list[Column]:
    """The texts between the kind's matches, and the matches."""
    tried = F.when(text.rlike(NEEDS.get(kind, "[0-9]")), text)
    return [F.split(tried, PATTERNS[kind], -1).alias(f"g_{kind}"),
            F.regexp_extract_all(tried, F.lit(PATTERNS[kind]), F.lit(0)).alias(f"h_{kind}")]


def _found(gaps: Column, hits: Column) -> Column:
    """array<struct<s, e, m, before, after>> of a kind's matches."""

    def step(acc, pair):
        start = acc["at"] + F.length(pair["g"])
        end = start + F.length(pair["m"])
        item = F.struct(start.cast("int").alias("s"), end.cast("int").alias("e"), pair["m"].alias("m"),
                        F.right(pair["g"], F.lit(CONTEXT)).alias("before"),
                        F.left(pair["a"], F.lit(1)).alias("after"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(item)).alias("out"))
    empty = F.array().cast("array<struct<s:int,e:int,m:string,before:string,after:string>>")
    n = F.size(hits)
    pairs = F.zip_with(F.zip_with(F.slice(gaps, F.lit(1), n), hits, lambda g, m: F.struct(g.alias("g"), m.alias("m"))),
                       F.slice(gaps, F.lit(2), n),
                       lambda p, a: F.struct(p["g"].alias("g"), p["m"].alias("m"), a.alias("a")))
    run = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda acc: acc["out"])
    return F.when(n > 0, run).otherwise(empty)


# ---------------------------------------------------------------- features

def _bucket(c: Column, *edges: int) -> Column:
    """0 below the first edge, 1 below the second, and so on."""
    return reduce(lambda acc, e: acc + (c >= e).cast("int"), edges, F.lit(0))


def _side(c: Column) -> Column:
    return F.when(c.rlike("[A-Za-z0-9]$"), F.lit(1)).when(c.rlike(r"[^\s]$"), F.lit(2)).otherwise(F.lit(0))


# Feature names with the greatest value each takes.
FEATURES = {"digits": 6, "plus": 1, "at": 1, "marks": 4, "dots": 3, "letters": 2, "left": 2, "right": 2, "context": 3}


def _features(x: Column) -> dict[str, Column]:
    m, before = x["m"], x["before"]
    return {
        "digits": _bucket(F.length(_digits(m)), 1, 7, 9, 12, 16, 17),
        "plus": m.startswith("+").cast("int"),
        "at": (m.contains("@") | m.rlike(r"[(\[]at[)\]]")).cast("int"),
        "marks": _bucket(F.length(F.regexp_replace(m, "[A-Za-z0-9]", "")), 1, 2, 3, 4),
        "dots": _bucket(F.length(F.regexp_replace(m, r"[^.]", "")), 1, 3, 4),
        "letters": _bucket(F.length(F.regexp_replace(m, "[^A-Za-z]", "")), 1, 4),
        "left": _side(before),
        "right": _side(x["after"]),
        "context": F.when(before.rlike(THINGS), F.lit(1)).when(before.rlike(CONTACT), F.lit(2))
        .when(before.rlike(MONEY), F.lit(3)).otherwise(F.lit(0)),
    }


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fold, base, more): the base spans as array<struct<s, k, e>>, and the
    other proposals with features, whether a base span overlaps them (hit) and
    whether their form or context speaks against them (con)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    raw = docs.select(F.col(id_col).alias("id"), F.pmod(F.xxhash64(text), F.lit(5)).cast("int").alias("fold"),
                      *[c for k in (*KINDS, *MORE) for c in _pieces(text, k)])
    raw = raw.select("id", "fold", *[_found(F.col(f"g_{k}"), F.col(f"h_{k}")).alias(f"m_{k}")
                                     for k in (*KINDS, *MORE)])

    def base_of(i: int, k: str) -> Column:
        return F.transform(F.filter(F.col(f"m_{k}"), lambda x: _valid(k, x["m"])),
                           lambda x: F.struct(x["s"].alias("s"), F.lit(i).alias("k"), x["e"].alias("e")))
    base = F.array_sort(F.concat(*[base_of(i, k) for i, k in enumerate(KINDS)]))
    named = raw.withColumn("base", base)

    def proposal(i: int, x: Column, failing: Column, masked: bool) -> Column:
        hit = F.lit(True) if masked else F.exists(
            F.col("base"), lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))
        feats = _features(x)
        number = feats["at"] == 0
        con = (failing | (number & (feats["digits"] < 2)) | x["m"].rlike(DATE) | (feats["context"] == 1)
               | (number & ((feats["left"] == 1) | (feats["right"] == 1))))
        return F.struct(x["s"].alias("s"), F.lit(len(KINDS) + i).alias("k"), x["e"].alias("e"), hit.alias("hit"),
                        con.alias("con"), *[f.alias(n) for n, f in feats.items()])

    def checked(k: str, ok: bool) -> Column:
        return F.filter(F.col(f"m_{k}"), lambda x: _valid(k, x["m"]) == F.lit(ok))

    def no_card(x: Column) -> Column:
        return ~x["before"].rlike(MONEY)

    def never(x: Column) -> Column:
        return F.lit(False)

    def always(x: Column) -> Column:
        return F.lit(True)

    def masked(k: str, mask) -> Column:
        return F.transform(checked(k, True), lambda x: x.withField("m", mask(x["m"])))
    # base proposals that fail their check are proposals like any other;
    # masked ones are examples only, as their base span covers them
    sources = [(i, F.col(f"m_{k}"), never, False) for i, k in enumerate(MORE)] + [
        (1, checked("card", False), no_card, False), (0, checked("phone", False), always, False),
        (0, masked("phone", lambda m: F.substr(m, F.lit(2))), never, True),
        (2, masked("email", lambda m: F.regexp_replace(F.regexp_replace(m, r"\.(?=[^@]*$)", " [dot] "), "@", " [at] ")),
         never, True)]

    def proposals(i: int, c: Column, failing, is_masked: bool) -> Column:
        return F.transform(c, lambda x: proposal(i, x, failing(x), is_masked))
    more = F.concat(*[proposals(*source) for source in sources])
    return named.select("id", "fold", "base", more.alias("more"))


# ------------------------------------------------------------------- model

class Boosted:
    """Gradient-boosted trees of depth two over small integer features, fitted
    to counted feature vectors, and their SQL expression."""

    def __init__(self, rows: list[tuple[tuple[int, ...], float, float]]) -> None:
        """rows: (features, positives, negatives)."""
        self.names = list(FEATURES)
        pos, neg = sum(r[1] for r in rows), sum(r[2] for r in rows)
        self.start = math.log((pos + 1) / (neg + 1))
        self.trees: list = []
        score = [self.start] * len(rows)
        for _ in range(ROUNDS if rows else 0):
            grads = []
            for (_, p, n), f in zip(rows, score):
                q = 1 / (1 + math.exp(-f))
                grads.append((p - (p + n) * q, (p + n) * q * (1 - q)))
            tree = self._grow(rows, grads, list(range(len(rows))), 2)
            self.trees.append(tree)
            score = [f + RATE * self._leaf(tree, r[0]) for f, r in zip(score, rows)]

    @staticmethod
    def _gain(g: float, h: float) -> float:
        return g * g / (h + 1.0)

    def _grow(self, rows, grads, at, depth):
        g, h = sum(grads[i][0] for i in at), sum(grads[i][1] for i in at)
        best = None
        for f, name in enumerate(self.names if depth else ()):
            for cut in range(FEATURES[name]):
                left = [i for i in at if rows[i][0][f] <= cut]
                if not left or len(left) == len(at):
                    continue
                gl, hl = sum(grads[i][0] for i in left), sum(grads[i][1] for i in left)
                gain = self._gain(gl, hl) + self._gain(g - gl, h - hl) - self._gain(g, h)
                if gain > 1e-9 and (best is None or gain > best[0]):
                    best = (gain, f, cut)
        if best is None:
            return max(-4.0, min(4.0, g / (h + 1.0)))
        _, f, cut = best
        return (f, cut, self._grow(rows, grads, [i for i in at if rows[i][0][f] <= cut], depth - 1),
                self._grow(rows, grads, [i for i in at if rows[i][0][f] > cut], depth - 1))

    def _leaf(self, tree, x) -> float:
        while isinstance(tree, tuple):
            tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
        return tree

    def score(self, x) -> float:
        return self.start + RATE * sum(self._leaf(t, x) for t in self.trees)

    def column(self, x: Column) -> Column:
        """The score of a proposal struct as an expression."""
        def walk(tree):
            if not isinstance(tree, tuple):
                return F.lit(float(tree) * RATE)
            return F.when(x[self.names[tree[0]]] <= tree[1], walk(tree[2])).otherwise(walk(tree[3]))
        return reduce(lambda a, t: a + walk(t), self.trees, F.lit(float(self.start)))


def fit(found: DataFrame) -> tuple[Boosted, float]:
    """The trees and the threshold for a table of candidates."""
    names = list(FEATURES)
    table = (found.filter(F.size("more") > 0).select("fold", F.explode("more").alias("x"))
             .groupBy((F.col("fold") == 0).alias("held"), *[F.col("x")[n].alias(n) for n in names])
             .agg(F.sum(F.col("x.hit").cast("long")).alias("p"),
                  F.sum((~F.col("x.hit") & F.col("x.con")).cast("long")).alias("n"))
             .orderBy("held", *names).collect())  # at most two rows per feature vector
    rows = [(r["held"], tuple(r[n] for n in names), float(r["p"]), float(r["n"])) for r in table
            if r["p"] + r["n"] > 0]  # vectors without a label decide nothing
    model = Boosted([r[1:] for r in rows if not r[0]])
    held = sorted(((model.score(r[1]), r[2], r[3]) for r in rows if r[0]), reverse=True)
    threshold, right, wrong, k = math.inf, 0.0, 0.0, 0
    while k < len(held):
        s = held[k][0]
        while k < len(held) and held[k][0] == s:  # equal scores stand or fall together
            right, wrong, k = right + held[k][1], wrong + held[k][2], k + 1
        if right + wrong >= MIN_HELD_OUT and right >= PRECISION * (right + wrong):
            threshold = max(s, 0.0)
    return model, threshold


# ---------------------------------------------------------------- operator

def _listed(c: Column) -> Column:
    names = F.array(*[F.lit(k) for k in (*KINDS, *MORE)])
    return F.array_join(F.transform(c, lambda x: F.concat_ws(
        ":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def _selected(found: DataFrame, model: Boosted, threshold: float) -> DataFrame:
    """found plus spans: base spans and the proposals that reach the threshold
    and overlap no base span."""
    empty = F.array().cast("array<struct<s:int,k:int,e:int>>")
    more = empty
    if math.isfinite(threshold):
        good = F.filter(F.col("more"), lambda x: ~x["hit"] & (model.column(x) >= F.lit(threshold - 1e-9)))
        more = F.transform(good, lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e")))
    return found.withColumn("spans", F.array_sort(F.array_distinct(F.concat(F.col("base"), more))))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_email, n_ip, n_card, n_phone, base_sha256, spans), one row per
    input row; spans lists kind:start:end in code points, end exclusive.

    Null and empty texts have no span.  Repeated rows are read row by row and
    count as often in the fit.  Without held-out proposals enough nothing
    beyond the base spans is selected.  An empty table gives no row.  Other
    columns are not read.
    """
    found = materialize(candidates(docs, id_col, text_col), "op8-candidates")
    out = _selected(found, *fit(found))

    def count(i: int) -> Column:
        return F.size(F.filter("base", lambda x: x["k"] == i)).cast("long")
    counts = [count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return out.select(F.col("id").alias(id_col), *counts, F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
                      _listed(F.col("spans")).alias("spans"))
