"""Temperature mixing of sources, realised as budgeted block permutations.

A source's natural share p of the tokens becomes p^a, normalised.  The exponent
a lies between 1 (natural) and 0 (all sources alike) and is found by bisection,
six halvings a pass: the largest a whose mixture reaches the target entropy, or
a larger one where a source would otherwise repeat more often than allowed.

Each source's share of the token budget is then drawn without replacement,
epoch by epoch.  A source's documents are dealt to blocks of about
`block_tokens` tokens by a hash; an epoch orders the blocks by a hash of their
own.  Whole epochs take all blocks; the last one takes blocks in order while
they fit and, of the first that does not, documents in hash order while they
fit.  Windows run over blocks of one source, or over the documents of a single
block, never over a source's documents.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import BLANKS, broadcast_if_small, materialize, own

TARGET = 0.97          # share of the greatest possible entropy to reach
MAX_EPOCHS = 4.0       # most times a document may be used on average
BUDGET = 1.0           # tokens of the mixture per token of the input
BLOCK_TOKENS = 1_000_000
SEED = "mix"
BROADCAST_ROWS = 500_000
WAYS, PASSES = 64, 5   # six halvings a pass, thirty in all


def n_tokens(text_col: str):
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(f"[^{BLANKS}]+")), F.lit(0)).cast("long")


def exponent(shares: DataFrame, target: float = TARGET, max_epochs: float = MAX_EPOCHS,
             budget: float = BUDGET) -> float:
    """The exponent for a table (tokens) of sources; one row per candidate
    exponent reaches the driver.  1.0 without any token."""
    logs = _with_share(shares)
    low, high = 0.0, 1.0
    for _ in range(PASSES):
        step = (high - low) / WAYS
        tries = [low + step * k for k in range(1, WAYS)]
        rows = (logs.select("lp", F.posexplode(F.array(*[F.lit(a) for a in tries])).alias("k", "a"))
                .withColumn("w", F.exp(F.col("a") * F.col("lp")))
                .groupBy("k").agg(
                    F.sum("w").alias("z"), F.sum(F.col("w") * F.col("a") * F.col("lp")).alias("wl"),
                    F.max(F.col("w") / F.exp("lp")).alias("most"), F.count(F.lit(1)).alias("n")).collect())
        if not rows:
            return 1.0
        good = _verdicts(rows, target, max_epochs, budget)
        # candidates from the left: the last that is still flat enough (or too repetitive)
        last = max((k for k, ok in good.items() if ok), default=-1)
        low, high = (tries[last] if last >= 0 else low), (tries[last + 1] if last + 1 < len(tries) else high)
    return round((low + high) / 2, 6)


def _with_share(shares: DataFrame) -> DataFrame:
    some = shares.filter("tokens > 0")
    total = some.agg(F.sum("tokens")).first()[0]
    return some.select(F.log(F.col("tokens") / F.lit(float(total or 1))).alias("lp"))


def _verdicts(rows, target: float, max_epochs: float, budget: float) -> dict:
    """Whether the exponent sought is at least the candidate's: its mixture
    still has the entropy, or repeats some source too often."""
    out = {}
    for r in rows:
        entropy = math.log(r["z"]) - r["wl"] / r["z"]
        out[r["k"]] = entropy >= target * math.log(r["n"]) - 1e-12 \
            or budget * r["most"] / r["z"] > max_epochs
    return out


def _hex(prefix: str, *parts):
    """First 15 hex digits of an md5 as a number, alike in any SQL engine."""
    text = F.concat_ws(":", F.lit(prefix), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _source_key(col: str = "source"):
    return F.coalesce(F.concat(F.lit("="), F.col(col)), F.lit("null"))


def quotas(shares: DataFrame, target: float, max_epochs: float, budget: float,
           block_tokens: int) -> DataFrame:
    """(source, tokens, blocks, epochs, rest): whole epochs and the tokens of
    the part of one that follows."""
    a = exponent(shares, target, max_epochs, budget)
    positive = F.when(F.col("tokens") > 0, F.pow(F.col("tokens").cast("double"), F.lit(a)))
    sums = shares.agg(F.sum(positive).alias("z"), F.sum("tokens").alias("total")).first()
    z, total = float(sums["z"] or 1.0), int(sums["total"] or 0)
    quota = F.coalesce(F.round(positive / F.lit(z) * F.lit(float(round(total * budget)))), F.lit(0.0)).cast("long")
    tokens = F.greatest(F.col("tokens"), F.lit(1))
    return (shares.withColumn("quota", quota)
            .select("source", "tokens", "quota",
                    F.ceil(tokens / F.lit(block_tokens)).cast("long").alias("blocks"),
                    F.floor(F.col("quota") / tokens).cast("long").alias("epochs"))
            .withColumn("rest", F.col("quota") - F.col("epochs") * F.col("tokens")))


def _dealt(rows: DataFrame, quota: DataFrame, seed: str) -> DataFrame:
    """rows (with id, source, tokens) plus their source's epochs and rest and
    their block; the quota table has a row per source."""
    q = broadcast_if_small(quota.select(F.col("source").alias("q_source"), "epochs", "rest", "blocks"),
                           quota.count(), BROADCAST_ROWS)
    key = F.coalesce(F.col("id").cast("string"), F.lit("null"))
    return (rows.join(q, F.col("source").eqNullSafe(F.col("q_source")))
            .withColumn("block", F.pmod(_hex(seed, key), F.col("blocks"))).drop("q_source", "blocks"))


def plan(slim: DataFrame, target: float = TARGET, max_epochs: float = MAX_EPOCHS,
         budget: float = BUDGET, block_tokens: int = BLOCK_TOKENS,
         seed: str = SEED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """For rows (id, source, tokens): the quota per source, the fate of each
    block in the last epoch (fits: 1 whole, 0 in part, -1 not), and the rows
    used of the blocks that fit in part."""
    shares = materialize(slim.groupBy("source").agg(F.sum("tokens").alias("tokens")), "op7-shares")
    quota = materialize(quotas(shares, target, max_epochs, budget, block_tokens), "op7-quotas")
    dealt = _dealt(slim, quota, seed)
    per_block = dealt.groupBy("source", "block", "epochs", "rest").agg(F.sum("tokens").alias("t"))
    order = _hex(seed + "-block", F.col("epochs"), _source_key(), F.col("block"))
    upto = Window.partitionBy("source").orderBy("o", "block").rowsBetween(Window.unboundedPreceding, 0)
    after = F.sum("t").over(upto)
    before = after - F.col("t")
    blocks = materialize(per_block.withColumn("o", order).select(
        F.col("source").alias("b_source"), F.col("block").alias("b_block"),
        (F.col("rest") - before).alias("left"),
        F.when(after <= F.col("rest"), F.lit(1)).when(before < F.col("rest"), F.lit(0)).otherwise(F.lit(-1))
        .alias("fits")), "op7-blocks")
    part = dealt.join(blocks.filter("fits = 0"), _in_block())
    key = F.coalesce(F.col("id").cast("string"), F.lit("null"))
    inner = Window.partitionBy("source", "block").orderBy("o", "id", "tokens") \
        .rowsBetween(Window.unboundedPreceding, 0)
    part = materialize(
        part.withColumn("o", _hex(seed + "-doc", F.col("epochs"), key))
        .withColumn("upto", F.sum("tokens").over(inner)).filter("upto <= left")
        .select(F.col("source").alias("p_source"), F.col("id").alias("p_id"), F.col("tokens").alias("p_tokens"))
        .distinct(), "op7-part")
    return quota, blocks, part


def _in_block():
    return F.col("source").eqNullSafe(F.col("b_source")) & (F.col("block") == F.col("b_block"))


def _copies(rows: DataFrame, quota: DataFrame, blocks: DataFrame, part: DataFrame, seed: str) -> DataFrame:
    """rows plus block and copies.  The tables beside rows are a row per
    source, per block, and per document of one block of each source."""
    b = broadcast_if_small(blocks.drop("left"), blocks.count(), BROADCAST_ROWS)
    p = broadcast_if_small(part.withColumn("in_part", F.lit(1)), part.count(), BROADCAST_ROWS)
    drawn = F.col("source").eqNullSafe(F.col("p_source")) & F.col("id").eqNullSafe(F.col("p_id")) \
        & (F.col("tokens") == F.col("p_tokens"))
    last = F.when(F.col("fits") == 0, F.coalesce("in_part", F.lit(0))).otherwise(F.greatest("fits", F.lit(0)))
    return (_dealt(rows, quota, seed).join(b, _in_block()).join(p, drawn, "left")
            .withColumn("copies", F.col("epochs") + last)
            .drop("b_source", "b_block", "p_source", "p_id", "p_tokens", "in_part", "fits", "epochs", "rest"))


def _slim(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                       n_tokens(text_col).alias("tokens"))


def mixture(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
            text_col: str = "text", **options) -> DataFrame:
    """(id_col, source_col, n_tokens, epoch, block_order): one row per use of a
    document; sorted by epoch and block_order the rows are the training order.

    A null source is a source; null and empty texts have no token and go where
    their block goes.  Rows that repeat an id lie in one block and are used row
    by row; rows alike in id, source and tokens share one fate.  An empty
    table gives no row; in a table without tokens every row is used once, as it
    costs nothing.  Other columns of the input are not read.
    """
    seed = options.get("seed", SEED)
    slim = materialize(_slim(docs, id_col, source_col, text_col), "op7-tokens")
    used = _copies(slim, *plan(slim, **options), seed).filter("copies > 0")
    uses = used.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    order = _hex(seed + "-block", F.col("epoch"), _source_key(), F.col("block"))
    return uses.select(F.col("id").alias(id_col), F.col("source").alias(source_col),
                       F.col("tokens").alias("n_tokens"), "epoch", order.alias("block_order"))


def mix_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
                  text_col: str = "text", **options) -> DataFrame:
    """The input's columns plus copies: how often the mixture uses the row;
    rows it does not use go.  Texts meet the small plan tables only."""
    seed = options.get("seed", SEED)
    slim = materialize(_slim(docs, id_col, source_col, text_col), "op7-tokens")
    row = own("row")
    base = docs.drop("copies")
    rows = base.select(F.struct(*[F.col(f"`{c}`") for c in base.columns]).alias(row),
                       F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                       n_tokens(text_col).alias("tokens"))
    names = [F.col(f"{row}.`{c}`").alias(c) for c in base.columns]
    return _copies(rows, *plan(slim, **options), seed).filter("copies > 0").select(*names, "copies")
