"""Benchmark decontamination by template canonicalisation.

Numbers, names and units of a text become typed placeholders (slots); other
words are lower-cased without outer punctuation.  Names that follow each other
without punctuation are one slot.  Windows of the canonical words of every
benchmark item are hash-joined with those of every document, so an item whose
values were exchanged still meets its template.  On the matches of one item in
one document at one offset, each value of the item must have one value in the
document (two may have the same); where that fails, only windows without a slot
count.  Item windows with too few literals for a template are looked for word by
word, so a verbatim copy meets whatever it holds.  An item of fewer than
LITERALS words is looked for as a whole line or sentence with the same words.  The capital that opens an item says nothing of its first
word; its first window is looked for in both readings, as a word and as a name,
since a quotation within a line reads as a name.  A document is contaminated by an item when enough of the
item's windows are found, or enough of those that are templates, or so many in
a row that a long passage of it is there, whatever the passage's share.

Before the join, document windows are tested against a bitmap of the
benchmark's window hashes.  The bitmap has a fixed size whatever the tables
hold; it drops only windows that no item has, so it changes cost, not results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import textbatch as tb
from strata.llm.common import bounded_batches, broadcast_if_small, materialize, own

WINDOW = 8        # canonical words of a window; shorter items use their length
LITERALS = 5      # least words of a template that are not slots; shorter items have to be whole lines or sentences
SHARE = 0.5       # share of an item's windows that makes a leak
RUN = 50          # canonical words of a passage that makes a leak by itself
BITS = 23         # log2 of the bitmap's bits (1 MB)
BROADCAST_ROWS = 1_000_000

# Unit words and symbols, lower case.
UNITS = ("mm cm m km in ft yd mi mile miles meter meters metre metres mg g kg lb lbs oz gram grams ton tons "
         "ml l liter liters litre litres gal gallon gallons s sec second seconds min minute minutes h hr hour "
         "hours day days week weeks month months year years % percent dollar dollars euro euros cent cents "
         "pound pounds usd eur gbp mph kmh km/h kwh kw w v hz khz mhz ghz kb mb gb tb").split()
NUMBER, NAME, UNIT, LITERAL = 1, 2, 3, 0
TEMPLATE, RICH, EXACT = "template", "rich", "exact"

_PUNCT = np.zeros(256, dtype=bool)
_PUNCT[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = True
_PUNCT[ord("%")] = False
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[0x30:0x3A] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_END = np.zeros(256, dtype=bool)
_END[list(b".!?:;")] = True
_SLOT = tb.odd_constants(4, 0x77)
_EXACT = tb.odd_constants(1, 0x78)[0]


def _word_hash(words: list[str]) -> np.ndarray:
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(w) for w in raw])
    return tb.hash_spans(np.frombuffer(b"".join(raw), np.uint8), ends - [len(w) for w in raw], ends)


_UNIT_HASHES = np.sort(_word_hash(UNITS))


def canonical(t: tb.Texts):
    """Canonical words of the texts of a slice: (text, value hash, kind, whether
    the word opens a line or a sentence, whether it has a capital, whether only
    blanks part it from the canonical word before).

    The value is the word in lower case without outer punctuation.  Lower case
    covers ASCII and the Latin-1 letters.  A number is a word with a digit, a
    unit one of UNITS, a name a word with a capital that does not begin a line
    or a sentence.  Words of punctuation only are passed over.
    """
    data = t.data
    lower = _LOWER[data]
    second = np.zeros(len(data), dtype=bool)
    second[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    lower = lower + (second * np.uint8(0x20)).astype(np.uint8)
    core = np.flatnonzero(~(tb._BLANK | _PUNCT)[data])
    a, b = np.searchsorted(core, t.starts), np.searchsorted(core, t.ends)
    ok = b > a
    word = np.flatnonzero(ok)
    if not len(word):
        none = np.empty(0, bool)
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int8), none, none, none
    start, end = core[a[ok]], core[b[ok] - 1] + 1
    value = tb.hash_spans(lower, start, end)
    digits = np.concatenate(([0], np.cumsum(_DIGIT[data])))
    number = digits[end] > digits[start]
    upper = ((data[start] >= 0x41) & (data[start] <= 0x5A)) | (
        (data[start] == 0xC3) & second[np.minimum(start + 1, len(data) - 1)])
    # the word before ends a sentence, or there is none on the line
    breaks = np.concatenate(([0], np.cumsum(data == 0x0A)))
    before = np.maximum(word - 1, 0)
    opens = (word == 0) | _END[data[t.ends[before] - 1]] | (breaks[t.starts[word]] > breaks[t.ends[before]])
    opens |= np.isin(word, t.first)
    unit = _UNIT_HASHES[np.minimum(np.searchsorted(_UNIT_HASHES, value), len(_UNIT_HASHES) - 1)] == value
    kind = np.where(number, NUMBER, np.where(unit, UNIT, np.where(upper & ~opens, NAME, LITERAL)))
    touch = np.zeros(len(word), dtype=bool)
    touch[1:] = (np.diff(word) == 1) & (end[:-1] == t.ends[word[:-1]]) & (start[1:] == t.starts[word[1:]])
    return t.text_of_word[word], value, kind.astype(np.int8), opens, upper, touch


def _merged(text: np.ndarray, value: np.ndarray, kind: np.ndarray, touch: np.ndarray):
    """(text, value, kind) with each run of names as one, and the place of every
    canonical word among them."""
    joined = np.zeros(len(text), dtype=bool)
    joined[1:] = touch[1:] & (kind[1:] == NAME) & (kind[:-1] == NAME) & (text[1:] == text[:-1])
    head = np.flatnonzero(~joined)
    n = np.diff(np.append(head, len(text)))
    out, runs = value[head], np.flatnonzero(n > 1)
    if len(runs):
        out[runs] = tb.hash_runs(value, head[runs], head[runs] + n[runs])
    return text[head], out, kind[head], np.cumsum(~joined) - 1


def template_windows(t: tb.Texts, size: int, form: str = TEMPLATE, quoted: bool = False):
    """(text, place in its text, window hash, word, values, kinds) of the windows
    with enough literals (TEMPLATE), or by their values instead of slots of those
    with too few (RICH) or of all (EXACT); values and kinds are those of all
    words.  Templates see a run of names as one word, the other forms see each
    word; the place counts a run as one in all forms.  EXACT windows of fewer
    than LITERALS words are whole lines or sentences.  quoted: the first windows
    only, of the texts whose first word would be a name if they were quoted
    within a line, read so."""
    text, value, kind, opens, upper, touch = canonical(t)
    first = np.searchsorted(text, np.arange(t.n))
    first = first[np.append(text, -1)[first] == np.arange(t.n)]
    if quoted:
        first = first[(upper & (kind == LITERAL))[first]]
        kind[first] = NAME
    whole = _merged(text, value, kind, touch)
    place = whole[3]
    if form == TEMPLATE:
        text, value, kind = whole[:3]
        first, place = place[first], np.arange(len(text))
    token = np.where(kind == LITERAL, value, _SLOT[kind]) if form == TEMPLATE else value
    at = np.arange(max(0, len(text) - size + 1))
    at = at[text[at] == text[at + size - 1]] if len(at) else at
    if quoted:
        at = np.intersect1d(at, first)
    if form == EXACT and size < LITERALS:
        edge = np.append(opens, True)
        edge[np.flatnonzero(np.diff(text)) + 1] = True
        at = at[edge[at] & edge[at + size]]
    literal = np.concatenate(([0], np.cumsum(kind == LITERAL)))
    if form != EXACT:
        at = at[(literal[at + size] - literal[at] >= LITERALS) == (form == TEMPLATE)]
    hashes = tb.combine([token[at + k] for k in range(size)]) if len(at) else np.empty(0, np.uint64)
    if form != TEMPLATE:
        hashes = tb.mix(hashes ^ _EXACT)
    start = np.searchsorted(text, text[at])
    return text[at], place[at] - place[start], hashes, at, value, kind


def _rows(bitmap: np.ndarray | None, forms: tuple[tuple, ...]):
    """Rows (id, mark, size, at, h, slots) of the windows of each length, form
    and reading."""
    def run(batches):
        for batch in batches:
            ids, marks = batch.column(0), batch.column(1)
            for i, _, t in tb.slices(batch, "text"):
                for n, *form in forms:
                    text, at, h, pos, value, kind = template_windows(t, n, *form)
                    if bitmap is not None and len(h):
                        bit = h & np.uint64((1 << BITS) - 1)
                        hit = (bitmap[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
                        text, at, h, pos = text[hit], at[hit], h[hit], pos[hit]
                    if not len(h):
                        continue
                    slot = kind[pos[:, None] + np.arange(n)] != LITERAL
                    values = value[pos[:, None] + np.arange(n)][slot]
                    offsets = np.concatenate(([0], np.cumsum(slot.sum(axis=1))))
                    take = pa.array(text + i)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(take), marks.take(take), pa.array(np.full(len(h), n), pa.int32()),
                         pa.array(at, pa.int32()), pa.array(tb.as_long(h), pa.int64()),
                         tb.list_array(tb.as_long(values), offsets, pa.int64())],
                        names=["id", "mark", "size", "at", "h", "slots"])
    return run


def _bench_windows(bench: DataFrame, size: int) -> DataFrame:
    """Item windows, of `size` words or of the whole item where it is shorter.
    Items of fewer than LITERALS words have one, of all their words."""
    kind = bench.schema["id"].dataType.simpleString()
    schema = f"id {kind}, mark long, size int, at int, h long, slots array<long>"

    def per_item(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                one = batch.slice(k, 1)
                for _, _, t in tb.slices(one, "text"):
                    text, value, kind, _, upper, touch = canonical(t)
                    n = min(size, len(text))
                    if not n:
                        continue
                    if n < LITERALS:
                        yield from _rows(None, ((n, EXACT),))([one])
                        continue
                    forms = [(n, RICH), (n, RICH, True)]
                    for quoted in (False, True):  # the first word may join a run of names
                        if quoted and kind[0] == LITERAL and upper[0]:
                            kind[0] = NAME
                        m = min(size, len(_merged(text, value, kind, touch)[0]))
                        if m >= LITERALS:
                            forms.append((m, TEMPLATE, quoted))
                    yield from _rows(None, tuple(forms))([one])
    return bench.select("id", F.lit(0).cast("long").alias("mark"), "text").mapInArrow(per_item, schema)


def _bitmap(windows: DataFrame) -> np.ndarray:
    """Bitmap of the window hashes: at most 2^BITS / 64 longs reach the driver."""
    bit = F.col("h").bitwiseAND(F.lit((1 << BITS) - 1))
    words = windows.groupBy(F.shiftright(bit, 6).cast("int").alias("w")) \
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias("m")).collect()
    out = np.zeros((1 << BITS) // 64, dtype=np.uint64)
    for w, m in words:
        out[w] = np.uint64(m & 0xFFFFFFFFFFFFFFFF)
    return out


def find_leaks(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text: str = "text", size: int = WINDOW,
               share: float = SHARE) -> DataFrame:
    """One row per document and benchmark item that leaks into it: (id_col,
    mark, item_col, item_windows, found, changed_slots).

    found counts the item's distinct windows in the document, changed_slots the
    item's slot values that have another value there (0 for a verbatim copy).
    mark is a hash of the text: rows that repeat id and text give one row, rows
    with one id and different texts are told apart.  Null and empty texts and
    items, and items without a word, leak nothing.  Items of fewer than LITERALS
    words leak where a whole line or sentence (or several together) has their
    words.  Very long texts are read whole, in one task each.  Windows of an item with too few literals for a template count when
    they are found word by word.  Where values were exchanged these are not
    found, so an item leaks too when found holds a share of its templates, and
    when it holds the windows of RUN words in a row at one place of a document.
    Items that repeat an id count as one item with all their windows.
    Other columns of the inputs are not read.
    """
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    items = materialize(_bench_windows(
        bench.select(F.col(item_col).alias("id"), F.col(item_text).alias("text")), size)
        .select(F.col("id").alias("item"), "size", F.col("at").alias("item_at"), "h",
                F.col("slots").alias("item_slots"), (F.size("slots") > F.col("size") - LITERALS).alias("rich")),
        "op10-items")
    forms = tuple(sorted((r[0], EXACT if r[1] else TEMPLATE)  # at most two a length
                         for r in items.select("size", "rich").distinct().collect()))
    slim = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("mark"),
                       F.col(text_col).alias("text"))
    schema = f"id {kind}, mark long, size int, at int, h long, slots array<long>"
    hits = materialize(slim.mapInArrow(_rows(_bitmap(items), forms), schema), "op10-hits")
    n_items = items.count()
    met = hits.join(broadcast_if_small(items, n_items, BROADCAST_ROWS), ["h", "size"])
    # one instance: an item in a document at one offset
    pairs = F.zip_with("item_slots", "slots", lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    inst = (met.groupBy("id", "mark", "item", (F.col("at") - F.col("item_at")).alias("offset"))
            .agg(F.array_distinct(F.flatten(F.collect_set(F.when(~F.col("rich"), pairs)))).alias("map"),
                 F.collect_set(F.when(~F.col("rich") & (F.size("slots") == 0), F.col("item_at"))).alias("plain"),
                 F.collect_set(F.when(~F.col("rich"), F.col("item_at"))).alias("all"),
                 F.collect_set(F.when(F.col("rich"), F.col("item_at"))).alias("exact")))
    fits = F.size(F.array_distinct(F.transform("map", lambda p: p.a))) == F.size("map")
    changed = F.size(F.filter("map", lambda p: p.a != p.b))
    in_row = max(1, RUN - size + 1)
    inst = inst.select("id", "mark", "item", F.when(fits, F.col("all")).otherwise(F.col("plain")).alias("at"), "exact",
                       F.when(fits, changed).otherwise(F.lit(0)).alias("changed"))
    # windows in a row end in_row - 1 places further, in the item and in the list
    inst = inst.withColumn("here", F.array_sort(F.array_union("at", "exact")))
    inst = inst.withColumn("passage", F.exists(F.transform("here", lambda x, i: F.coalesce(
        F.get("here", i + (in_row - 1)) - x == in_row - 1, F.lit(False))), lambda x: x))
    # a window counts once, however many instances hold it
    window = F.explode_outer(F.transform("here", lambda x: F.struct(
        x.alias("at"), F.array_contains("at", x).alias("template"))))
    found = (inst.select("id", "mark", "item", "passage", "changed", window.alias("w"))
             .groupBy("id", "mark", "item", F.col("w.at").alias("at"))
             .agg(F.max("w.template").alias("template"), F.max("passage").alias("passage"),
                  F.min("changed").alias("changed"))
             .groupBy("id", "mark", "item")
             .agg(F.count("at").alias("found"), F.count_if("template").alias("found_templates"),
                  F.max("passage").alias("passage"), F.min("changed").alias("changed")))
    total = items.groupBy("item").agg(
        F.count_distinct("item_at").alias("windows"),
        F.count_distinct(F.when(~F.col("rich"), F.col("item_at"))).alias("templates"))
    leaks = found.join(total, "item").filter(
        ((F.col("found") > 0) & (F.col("found") >= F.col("windows") * share))
        | ((F.col("found_templates") > 0) & (F.col("found_templates") >= F.col("templates") * share))
        | F.col("passage"))
    return leaks.select(F.col("id").alias(id_col), "mark", F.col("item").alias(item_col),
                        F.col("windows").cast("long").alias("item_windows"),
                        F.col("found").cast("long").alias("found"),
                        F.col("changed").cast("long").alias("changed_slots"))


def drop_contaminated(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text", **options) -> DataFrame:
    """The input rows, all columns, of the documents into which no item leaks."""
    i, m, h = own("id"), own("mark"), own("hash")
    leaks = find_leaks(docs, bench, id_col, text_col, **options)
    bad = materialize(leaks.select(F.col(id_col).alias(i), F.col("mark").alias(m)).distinct(), "op10-bad")
    bad = broadcast_if_small(bad, bad.count(), BROADCAST_ROWS)
    return docs.withColumn(h, F.xxhash64(F.col(text_col))).join(
        bad, F.col(id_col).eqNullSafe(F.col(i)) & (F.col(h) == F.col(m)), "left_anti").drop(h)
