"""Chat formatting in budgeted windows, in DataFrame functions only.

Prefix sums of turn tokens cut a conversation into buckets of `budget` tokens.
Turns that lie inside one bucket form a window; a turn that crosses from one
bucket to the next is a window of its own, so no window has more new tokens
than the budget unless a single turn has.  Turns are never cut.  From the
second window on, the conversation's first system turn is repeated, and after
it as many whole turns from the end of the window before as fit `history`
tokens.  The loss mask covers assistant texts, but no repeated ones, so each
assistant text is a target once.

A turn is written as <s>[role]\\ntext</s>\\n.  Roles and texts are escaped:
backslash, `<`, `[` and `]` become two-character sequences, so no text can
hold a mark, and `unescape` restores them exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET = 768      # new tokens of a window
HISTORY = 256     # most tokens of repeated turns before them
TURN_TOKENS = 4   # tokens of a turn's marks

# What a control character is written as.
ESCAPES = (("\\", "\\\\"), ("<", "\\l"), ("[", "\\b"), ("]", "\\c"))
OPEN, NAMED, CLOSE = "<s>[", "]\n", "</s>\n"
_TURN = r"<s>\[([^<\]]*)\]\n([^<]*)</s>\n"


def escape(text: Column) -> Column:
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    """The inverse of escape.  Splitting at doubled backslashes first keeps a
    backslash from being read with the letter that followed it."""
    def plain(part: Column) -> Column:
        for c, written in ESCAPES[1:]:
            part = F.replace(part, F.lit(written), F.lit(c))
        return part
    return F.array_join(F.transform(F.split(text, r"\\\\", -1), plain), "\\")


def n_tokens(text: Column) -> Column:
    """Words and single marks of a text."""
    return F.regexp_count(text, F.lit(r"[A-Za-z0-9_]+|[^A-Za-z0-9_\x20\x09-\x0D]")) + TURN_TOKENS


def written(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), escape(turn["role"]), F.lit(NAMED), escape(turn["text"]), F.lit(CLOSE))


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY,
            conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """(conv_id, window, text, repeated, targets): the formatted windows.

    repeated is the number of turns at a window's start that earlier windows
    have; targets are the code point ranges of text, end exclusive, that the
    loss covers (still escaped).  Turns are ordered by turn number, then role,
    then text, nulls first; null roles and texts count as empty; a null
    conversation id is a conversation.  Repeated rows are turns like any other.
    Other columns are not read.
    """
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    turns = conversations.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                                 role.alias("role"), text.alias("text"))
    turns = turns.withColumn("tokens", n_tokens(F.col("text")).cast("long"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text") \
        .rowsBetween(Window.unboundedPreceding, 0)
    placed = (turns.withColumn("after", F.sum("tokens").over(order))
              .withColumn("at", F.count(F.lit(1)).over(order))
              .withColumn("before", F.col("after") - F.col("tokens")))
    bucket = F.floor(F.col("before") / F.lit(budget))
    crosses = F.floor((F.col("after") - 1) / F.lit(budget)) > bucket
    placed = placed.withColumn("key", 2 * bucket + crosses.cast("long"))

    turn = F.struct("at", "before", "after", "role", "text")
    grouped = placed.groupBy("conv_id", "key").agg(F.array_sort(F.collect_list(turn)).alias("new"))
    by_key = Window.partitionBy("conv_id").orderBy("key")
    first_system = F.filter("new", lambda t: t["role"] == "system")[0]
    upto = by_key.rowsBetween(Window.unboundedPreceding, -1)
    linked = (grouped.withColumn("system", F.when(F.exists("new", lambda t: t["role"] == "system"), first_system))
              .withColumn("window", F.row_number().over(by_key) - 1)
              .withColumn("kept", F.first("system", ignorenulls=True).over(upto))
              .withColumn("last", F.lag("new").over(by_key)))
    start = F.col("new")[0]["before"]
    tail = F.filter(F.col("last"), lambda t: (start - t["before"] <= history) & (t["at"] != F.coalesce(
        F.col("kept")["at"], F.lit(0))))
    lead = F.concat(F.when(F.col("kept").isNotNull(), F.array("kept")).otherwise(F.array().cast(
        linked.schema["new"].dataType)), F.coalesce(tail, F.array().cast(linked.schema["new"].dataType)))
    whole = linked.select("conv_id", "window", F.size("new").alias("n_new"), lead.alias("lead"), "new")
    whole = whole.select("conv_id", "window", F.size("lead").alias("repeated"), F.concat("lead", "new").alias("turns"))
    pieces = whole.select("conv_id", "window", "repeated", F.transform("turns", lambda t, i: F.struct(
        written(t).alias("w"), F.length(escape(t["role"])).alias("r"), F.length(escape(t["text"])).alias("t"),
        ((t["role"] == "assistant") & (i >= F.col("repeated"))).alias("target"))).alias("p"))

    def step(acc: Column, p: Column) -> Column:
        start_at = acc["at"] + len(OPEN) + p["r"] + len(NAMED)
        span = F.struct(start_at.alias("s"), (start_at + p["t"]).alias("e"))
        return F.struct((acc["at"] + F.length(p["w"])).alias("at"),
                        F.when(p["target"], F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))
    targets = F.aggregate("p", F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int>>").alias("out")),
                          step, lambda acc: acc["out"])
    return pieces.select("conv_id", "window", F.array_join(F.transform("p", lambda p: p["w"]), "").alias("text"),
                         "repeated", targets.alias("targets"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars), read from the text of formatted windows alone."""
    roles = F.regexp_extract_all("text", F.lit(_TURN), F.lit(1))
    texts = F.regexp_extract_all("text", F.lit(_TURN), F.lit(2))
    parsed = formatted.select(
        "conv_id", "window", F.length("text").alias("chars"), "repeated", roles.alias("roles"), texts.alias("texts"),
        F.array_join(F.transform("targets", lambda x: unescape(
            F.substring(F.col("text"), x["s"] + 1, x["e"] - x["s"]))), "").alias("loss"))
    n = F.size("roles") - F.col("repeated")
    fresh = F.zip_with(F.slice("roles", F.col("repeated") + 1, n), F.slice("texts", F.col("repeated") + 1, n),
                       lambda r, t: F.concat(unescape(r), F.lit("\n"), unescape(t), F.lit("\n")))
    per_window = parsed.select("conv_id", "window", "chars", n.alias("n"), F.array_join(fresh, "").alias("turns"), "loss")
    joined = per_window.groupBy("conv_id").agg(
        F.sum("n").cast("long").alias("n_turns"), F.sum("chars").cast("long").alias("formatted_chars"),
        F.array_sort(F.collect_list(F.struct("window", "turns", "loss"))).alias("w"))
    whole = joined.select("conv_id", "n_turns", "formatted_chars",
                          F.array_join(F.transform("w", lambda x: x["turns"]), "").alias("turns"),
                          F.array_join(F.transform("w", lambda x: x["loss"]), "").alias("loss"))
    return whole.select("conv_id", "n_turns", F.sha2("turns", 256).alias("turns_sha256"),
                        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                        "formatted_chars")


def with_probe(conversations: DataFrame) -> DataFrame:
    """The conversations plus number -1: two turns whose text is control strings."""
    turns = F.array(*[F.struct(F.lit(-1).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"),
                               F.lit(role).alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
                      for i, role in enumerate(("user", "assistant"))])
    extra = conversations.sparkSession.range(1).select(F.inline(turns))
    return conversations.select("conv_id", "turn", "role", "text").unionByName(extra)
