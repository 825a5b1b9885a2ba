"""N-gram Jaccard self-join by a chosen-path recursion.

Every text becomes the set of its five-word windows; texts with the same set
form one set class, so copies never meet pair by pair.  Each set is embedded
as a vector of min-hash values.  A run starts with one sampled coordinate: sets
that share its value share a bucket.  A bucket over `limit` sets is split
again on further sampled coordinates, two branches at a time, unless its sets
agree so widely that they are one group of near copies, where splitting does
not help.  Final buckets are brute-forced, large ones in blocks that separate
tasks take; there are as many runs as the target recall needs (`runs_for`).  A
pair met in several buckets belongs to the smallest bucket key that both sets
hold, so counts need no list of pairs.  Candidates pass a coarse filter on
eight-bit min-hashes, and an exact Jaccard test on the whole sets decides.

Tasks return per-set link counts and a spanning forest of each block, never
all pairs; classes are the connected components of the forest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import textbatch as tb
from strata.llm.common import bounded_batches, broadcast_if_small, materialize, own

COORDS = 64           # min-hash values of a set
SHINGLE = 5           # words of a window
THRESHOLD = 0.8       # least Jaccard similarity of a link
RECALL = 0.9999       # least chance that a linked pair is found
LIMIT = 200           # sets of a bucket that is not split further
BLOCK = 800           # sets of a block of a bucket that cannot be split
DEPTH = 4             # deepest split
ALIKE = 0.25          # agreement on a sampled coordinate that stops splitting
BROADCAST_ROWS = 2_000_000  # 64-bit ids that may be broadcast (16 MB)

_A = tb.odd_constants(COORDS, 0xA1)
_B = tb.odd_constants(COORDS, 0xB2)


def expected_recall(similarity: float, runs: int, depth: int = DEPTH) -> float:
    """Chance that a pair of this similarity meets in some bucket, if every
    split goes to the full depth (pairs in small buckets fare better)."""
    below = 1.0
    for _ in range(depth - 1):
        below = 1 - (1 - similarity * below) ** 2
    return 1 - (1 - similarity * below) ** runs


def runs_for(recall: float = RECALL, similarity: float = THRESHOLD, depth: int = DEPTH) -> int:
    """The least number of runs with this recall at the threshold."""
    runs = 1
    while expected_recall(similarity, runs, depth) < recall:
        runs += 1
    return runs


# ---------------------------------------------------------------- sketches

def _shingled(batches, id_col: str, text_col: str, size: int):
    for batch in batches:
        ids = batch.column(batch.schema.get_field_index(id_col))
        for i, j, texts in tb.slices(batch, text_col):
            flat, offsets = texts.shingles(size)
            raw = flat.tobytes()
            keys = [xxhash.xxh3_128_digest(raw[8 * a:8 * b]) if b > a else None
                    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield ids.slice(i, j - i), flat, offsets, pa.array(keys, pa.binary())


def _sketcher(id_col: str, text_col: str, size: int):
    def run(batches):
        for ids, flat, offsets, keys in _shingled(batches, id_col, text_col, size):
            counts = np.diff(offsets)
            has = np.flatnonzero(counts)
            sig = np.zeros((len(counts), COORDS), dtype=np.uint32)
            if len(has):
                at = offsets[:-1][has]
                for c in range(COORDS):
                    low = np.minimum.reduceat((flat ^ _B[c]) * _A[c], at)
                    sig[has, c] = tb.mix(low).astype(np.uint32)
            coarse = tb.binary_array(sig.astype(np.uint8).ravel(),
                                     np.arange(len(counts) + 1) * COORDS)
            wide = tb.list_array(sig.ravel().view(np.int32),
                                 np.arange(len(counts) + 1) * COORDS, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [ids, keys, pa.array(counts, pa.int32()), wide, coarse],
                names=["id", "set_id", "size", "sig", "coarse"])
    return run


def _setter(id_col: str, text_col: str, size: int):
    def run(batches):
        for _, flat, offsets, keys in _shingled(batches, id_col, text_col, size):
            yield pa.RecordBatch.from_arrays(
                [keys, tb.binary_array(flat.view(np.uint8), offsets * 8)], names=["set_id", "items"])
    return run


# ----------------------------------------------------------------- buckets

def _split(level: DataFrame, reps: DataFrame, limit: int, depth: int) -> DataFrame:
    """(set_id, key, blocks): the final buckets of at least two sets."""
    spark = level.sparkSession
    done: DataFrame | None = None
    for d in range(1, depth + 1):
        counts = materialize(level.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
                             .filter("n > 1"), f"op1-counts-{d}")
        small = level.join(counts.filter(F.col("n") <= limit).select("key"), "key") \
            .select("set_id", "key", F.lit(1).alias("blocks"))
        done = small if done is None else done.unionByName(small)
        big = counts.filter(F.col("n") > limit)
        if not big.take(1):
            break
        heavy = level.join(big, "key")
        as_blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int").alias("blocks")
        if d == depth:
            done = done.unionByName(heavy.select("set_id", "key", as_blocks))
            break
        # two sampled coordinates per bucket, the same for all its sets
        pick = [F.pmod(F.xxhash64("key", F.lit(b)), F.lit(COORDS)).cast("int") for b in (0, 1)]
        kids = materialize(
            heavy.join(reps.select("set_id", "sig"), "set_id")
            .select("set_id", "key", "n", F.posexplode(F.array(
                *[F.xxhash64("key", p, F.element_at("sig", p + 1)) for p in pick])).alias("b", "child")),
            f"op1-children-{d}")
        agree = (kids.groupBy("key", "n", "b", "child").agg(F.count(F.lit(1)).alias("c"))
                 .groupBy("key", "n", "b")
                 .agg((F.sum(F.col("c") * F.col("c")) / F.first("n") / F.first("n")).alias("a"))
                 .groupBy("key").agg(F.max("a").alias("a")))
        alike = materialize(agree.filter(F.col("a") >= ALIKE).select("key"), f"op1-alike-{d}")
        done = done.unionByName(
            kids.filter("b = 0").join(alike, "key", "left_semi").select("set_id", "key", as_blocks))
        level = kids.join(alike, "key", "left_anti").select("set_id", F.col("child").alias("key")) \
            .distinct()
    return done if done is not None else spark.createDataFrame([], "set_id binary, key long, blocks int")


def _blocked(buckets: DataFrame) -> DataFrame:
    """Rows per (bucket, pair of blocks): each set goes to the blocks it must
    meet, so no task holds more than two blocks of a large bucket."""
    mine = F.pmod(F.xxhash64("set_id", F.lit(11)), F.col("blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(
        F.least(o, F.col("mine")).alias("lo"), F.greatest(o, F.col("mine")).alias("hi")))
    return (buckets.withColumn("mine", mine).withColumn("p", F.explode(pairs))
            .select("*", F.col("p.lo").alias("lo"), F.col("p.hi").alias("hi")).drop("p"))


def _groups(batches, columns: list[str]):
    """Column slices of the consecutive rows with one (key, lo, hi); a group
    that a batch ends in is carried into the next batch."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        key, lo, hi = (table.column(c).to_numpy() for c in ("key", "lo", "hi"))
        cut = np.flatnonzero((key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])) + 1
        rest = table.slice(int(cut[-1])) if len(cut) else table
        if len(cut):
            yield from _cut(table, np.concatenate(([0], cut)), columns)
    if rest is not None and rest.num_rows:
        yield from _cut(rest, np.array([0, rest.num_rows]), columns)


def _cut(table: pa.Table, at: np.ndarray, columns: list[str]):
    flat = {c: table.column(c).combine_chunks() for c in columns}
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a > 1:
            yield {c: v.slice(a, b - a) for c, v in flat.items()}


def _candidates(g: dict, threshold: float) -> np.ndarray:
    """Boolean matrix of the pairs i < j this block pair must test: owned by
    the bucket, of fitting sizes and of similar coarse min-hashes."""
    size = g["size"].to_numpy()
    coarse = np.frombuffer(b"".join(g["coarse"].to_pylist()), np.uint8).reshape(-1, COORDS)
    mine = g["mine"].to_numpy(zero_copy_only=False)
    lo, hi, key = g["lo"][0].as_py(), g["hi"][0].as_py(), g["key"][0].as_py()
    m = len(size)
    ok = np.triu(np.ones((m, m), dtype=bool), 1)
    if lo != hi:
        ok &= mine[:, None] != mine[None, :]
    ok &= np.minimum(size[:, None], size[None, :]) >= threshold * np.maximum(size[:, None], size[None, :])
    keys = g["keys"]
    flat = keys.flatten().to_numpy()
    row = np.repeat(np.arange(m), np.diff(keys.offsets.to_numpy()))
    less = flat < key
    flat, row = flat[less], row[less]
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    cut = np.flatnonzero(flat[1:] != flat[:-1]) + 1
    for own_rows in np.split(row, cut):
        if len(own_rows) > 1:
            ok[np.ix_(own_rows, own_rows)] = False
    # a wide margin below the threshold: five deviations of 64 samples
    least = threshold - 5 * (threshold * (1 - threshold) / COORDS) ** 0.5
    for i in np.flatnonzero(ok.any(axis=1)):
        js = np.flatnonzero(ok[i])
        same = (coarse[js] == coarse[i]).sum(axis=1)
        ok[i, js[same < least * COORDS]] = False
    return ok


def _flagger(threshold: float):
    def run(batches):
        for g in _groups(batches, ["set_id", "key", "lo", "hi", "mine", "blocks", "size", "coarse", "keys"]):
            ok = _candidates(g, threshold)
            at = np.flatnonzero(ok.any(axis=0) | ok.any(axis=1))
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [g[c].take(pa.array(at)) for c in ("set_id", "key", "blocks")],
                    names=["set_id", "key", "blocks"])
    return run


def _linker(threshold: float):
    def run(batches):
        for g in _groups(batches, ["set_id", "key", "lo", "hi", "mine", "size", "coarse", "keys", "items", "n_docs"]):
            ok = _candidates(g, threshold)
            used = np.flatnonzero(ok.any(axis=0) | ok.any(axis=1))
            if not len(used):
                continue
            sets = [np.frombuffer(x.as_py(), np.uint64) for x in g["items"].take(pa.array(used))]
            links = _jaccard(sets, ok[np.ix_(used, used)], threshold)
            if not links.any():
                continue
            docs = g["n_docs"].to_numpy()[used]
            both = links | links.T
            n_sets, n_docs = both.sum(axis=1), both @ docs
            parent = _forest(links)
            at = np.flatnonzero(n_sets)
            ids = g["set_id"].take(pa.array(used[at]))
            other = g["set_id"].take(pa.array(used[parent[at]]))
            yield pa.RecordBatch.from_arrays(
                [ids, other, pa.array(n_sets[at], pa.int64()), pa.array(n_docs[at], pa.int64())],
                names=["set_id", "other", "n_sets", "n_docs"])
    return run


def _jaccard(sets: list[np.ndarray], ok: np.ndarray, threshold: float) -> np.ndarray:
    """The pairs of `ok` whose exact Jaccard similarity reaches the threshold."""
    size = np.array([len(s) for s in sets])
    if ok.sum() <= 8:
        out = np.zeros_like(ok)
        for i, j in zip(*np.nonzero(ok)):
            union = len(np.unique(np.concatenate((sets[i], sets[j]))))
            out[i, j] = size[i] + size[j] - union >= threshold * union
        return out
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), size)
    common = np.zeros(ok.shape, dtype=np.float32)
    width = 8192  # items at a time: the dense block stays small for long sets
    order = np.argsort(ids, kind="stable")
    ids, row = ids[order], row[order]
    for a in range(0, int(ids[-1]) + 1, width):
        i, j = np.searchsorted(ids, (a, a + width))
        block = np.zeros((len(sets), width), dtype=np.float32)
        block[row[i:j], ids[i:j] - a] = 1
        common += block @ block.T
    union = size[:, None] + size[None, :] - common
    return ok & (common >= threshold * union - 1e-6)


def _forest(links: np.ndarray) -> np.ndarray:
    """For each set a linked set nearer the root of its component (or itself)."""
    both = links | links.T
    parent, seen = np.arange(len(links)), np.zeros(len(links), dtype=bool)
    for root in range(len(links)):
        if seen[root]:
            continue
        seen[root], todo = True, [root]
        while todo:
            x = todo.pop()
            new = np.flatnonzero(both[x] & ~seen)
            seen[new], parent[new] = True, x
            todo.extend(new.tolist())
    return parent


# -------------------------------------------------------------- components

def components(edges: DataFrame, a: str = "set_id", b: str = "other") -> DataFrame:
    """(node, root): connected components by alternating large-star and
    small-star steps; root is the least node.  Edges are only ever tables."""
    e = materialize(edges.filter(F.col(a) != F.col(b))
                    .select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).distinct(), "cc-0")
    step = 0
    while True:
        step += 1
        # large star: each node's larger neighbours move to its least neighbour
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")) \
            .select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("m").alias("u"), "v") \
            .filter("u <> v").distinct()
        # small star: each node's smaller neighbours meet at the least of them
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        hung = large.join(least, "v")
        new = materialize(
            hung.filter("u <> m").select(F.col("m").alias("u"), F.col("u").alias("v"))
            .union(least.select(F.col("m").alias("u"), "v")).distinct(), f"cc-{step}")
        # done when every node hangs on one root and no root hangs on a node
        roots = new.select("u").distinct()
        stars = new.groupBy("v").count().filter("count > 1").limit(1)
        deep = new.join(roots.withColumnRenamed("u", "v"), "v", "left_semi").select("v").limit(1)
        if not stars.select("v").union(deep).take(1):
            return new.select(F.col("v").alias("node"), F.col("u").alias("root"))
        e = new


# ---------------------------------------------------------------- operator

def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 threshold: float = THRESHOLD, size: int = SHINGLE,
                 recall: float = RECALL, limit: int = LIMIT, depth: int = DEPTH) -> DataFrame:
    """One row per input row: (id_col, set_size, class_id, class_docs, n_links,
    n_set_links).

    class_id is the least id of the class, class_docs the rows in it.  n_links
    counts the other rows whose window set has at least the given Jaccard
    similarity, n_set_links the other distinct sets.  A text with fewer than
    `size` words counts as one window of all of them; null, empty and blank
    texts have no window, link to nothing and form a class of their own row
    (class_id is their id).  Repeated rows (also with a repeated id) are rows
    like any other; a null id sorts below all others as a representative only
    if the whole class has no id.  Other columns of the input are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sketch = materialize(slim.mapInArrow(
        _sketcher("id", "text", size),
        f"id {kind}, set_id binary, size int, sig array<int>, coarse binary"), "op1-sketch")
    sets = materialize(
        sketch.filter("set_id is not null").groupBy("set_id")
        .agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n_docs")), "op1-sets")
    # rows of one set carry equal sketches: any row of the representative serves
    reps = materialize(
        sketch.filter("set_id is not null").join(sets, "set_id")
        .filter(F.col("id").eqNullSafe(F.col("rep")))
        .select("set_id", "rep", "n_docs", "size", "sig", "coarse").dropDuplicates(["set_id"]), "op1-reps")

    first = reps.select("set_id", F.explode(F.array(
        *[F.xxhash64(F.lit(r), F.element_at("sig", r + 1)) for r in range(runs_for(recall, threshold, depth))])).alias("key"))
    buckets = materialize(_split(first, reps, limit, depth), "op1-buckets")
    held = buckets.groupBy("set_id").agg(F.array_sort(F.collect_set("key")).alias("keys"),
                                         F.collect_set(F.struct("key", "blocks")).alias("held"))
    facts = reps.select("set_id", "rep", "n_docs", "size", "coarse").join(held, "set_id")
    member = facts.select("set_id", "size", "coarse", "keys", F.inline("held"))
    grouped = _blocked(member).repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    flagged = materialize(grouped.mapInArrow(
        _flagger(threshold), "set_id binary, key long, blocks int").distinct(), "op1-flagged")

    # whole sets only for those that passed: read again from the texts
    wanted = facts.join(flagged.select("set_id").distinct(), "set_id", "left_semi") \
        .select("set_id", "rep", "n_docs", "size", "coarse", "keys")
    wanted = materialize(wanted, "op1-wanted")
    n_wanted = wanted.count()
    ids = broadcast_if_small(wanted.select("rep").distinct(), n_wanted, BROADCAST_ROWS)
    full = materialize(
        slim.join(ids, F.col("id").eqNullSafe(F.col("rep")), "left_semi")
        .mapInArrow(_setter("id", "text", size), "set_id binary, items binary")
        .join(broadcast_if_small(wanted.select("set_id"), n_wanted, BROADCAST_ROWS // 2),
              "set_id", "left_semi")
        .dropDuplicates(["set_id"]), "op1-full")
    tested = (flagged.join(wanted, "set_id").join(full, "set_id"))
    tested = _blocked(tested).repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    links = materialize(tested.mapInArrow(
        _linker(threshold), "set_id binary, other binary, n_sets long, n_docs long"), "op1-links")

    per_set = links.groupBy("set_id").agg(F.sum("n_sets").alias("n_sets"), F.sum("n_docs").alias("n_linked"))
    tree = components(links)
    root = (per_set.select("set_id").join(tree, F.col("set_id") == F.col("node"), "left")
            .select("set_id", F.coalesce("root", "set_id").alias("root")))
    linked = sets.join(per_set, "set_id", "left").join(root, "set_id", "left") \
        .withColumn("root", F.coalesce("root", "set_id"))
    linked = materialize(linked, "op1-linked")
    classes = linked.groupBy("root").agg(F.min("rep").alias("class_id"),
                                         F.sum("n_docs").alias("class_docs"))
    by_set = materialize(
        linked.join(classes, "root").select(
            "set_id", "class_id", "class_docs",
            (F.col("n_docs") - 1 + F.coalesce("n_linked", F.lit(0))).alias("n_links"),
            F.coalesce("n_sets", F.lit(0)).cast("long").alias("n_set_links")), "op1-by-set")
    return (sketch.select("id", "set_id", F.col("size").cast("long").alias("set_size"))
            .join(by_set, "set_id", "left")
            .select(F.col("id").alias(id_col), "set_size",
                    F.coalesce("class_id", "id").alias("class_id"),
                    F.coalesce("class_docs", F.lit(1)).cast("long").alias("class_docs"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("n_set_links", F.lit(0)).alias("n_set_links")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The input columns of one row per class: the row with the class's least
    id.  Rows that repeat that id (the same document read twice) count once.
    Texts without a word are copies of each other here, and the one with the
    least id stays; rows without an id all stay."""
    found = materialize(jaccard_join(docs, id_col, text_col, **options)
                        .select(id_col, "class_id", "set_size"), "op1-found")
    wordless = found.filter("set_size = 0").agg(F.min(id_col).alias("least")).first()["least"]
    first = F.when(F.col("set_size") == 0, F.lit(wordless)).otherwise(F.col("class_id"))
    mark, times = own("id"), own("times")
    # per id: whether some row of it stands for its class, and how many rows it has
    ids = found.groupBy(F.col(id_col).alias(mark)).agg(
        F.max(F.coalesce(first == F.col(id_col), F.lit(True))).alias("stays"),
        F.count(F.lit(1)).alias(times)).filter("stays").drop("stays")
    ids = materialize(ids, "op1-kept")
    ids = broadcast_if_small(ids, ids.count(), BROADCAST_ROWS)
    hit = docs.join(ids, F.col(id_col).eqNullSafe(F.col(mark)))
    single = hit.filter((F.col(times) == 1) | F.col(mark).isNull()).drop(mark, times)
    repeated = hit.filter((F.col(times) > 1) & F.col(mark).isNotNull()).drop(mark, times)
    return single.unionByName(repeated.dropDuplicates([id_col]))
