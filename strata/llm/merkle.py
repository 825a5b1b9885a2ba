"""Merkle dataset manifest: leaves, proofs and their verification.

Every row is a leaf; the leaves of a source, in ascending doc_id, and then the
sources' roots are joined by runs of 16 until one node remains.  Nodes are dealt
by superblock: the part of a tree that 16^SPAN consecutive nodes span.  Going
up, a superblock becomes the one node above it.  Coming down, the nodes of a
superblock are cogrouped with what lies outside it (the siblings from the
superblock's own node to the root), and one function reduces the superblock,
joins local and outer siblings to proofs and folds them.  No task holds more
than a superblock, and positions come from partition counts, so a source with a
third of all rows is as spread as any other rows.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialize
from strata.operators.ranking import with_positions

FANOUT = 16
SPAN = 2  # levels of a superblock: 256 nodes
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

RESULT = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
          "verified boolean")
_NODE = "tree string, pos long, size long, digest binary"
_OUTER = "tree string, block long, ats array<int>, sibs array<string>, subroot string"


def leaf_digest(text: Column | None = None) -> Column:
    """Digest (binary) of a row's fields: `-` for null, else byte count, `:`
    and value; `text` stands in for the row's own."""
    parts = []
    for name in FIELDS:
        value = (text if name == "text" and text is not None else F.col(name)).cast("string")
        parts.append(F.when(value.isNull(), F.lit("-")).otherwise(
            F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def _height(size: int) -> int:
    levels = 0
    while size > 1:
        size, levels = -(-size // FANOUT), levels + 1
    return levels


def _runs(digests: list[str], levels: int) -> tuple[list[list[str]], str]:
    """The texts of all runs, level by level, and the one node above them."""
    texts = []
    for _ in range(levels):
        texts.append(["".join(digests[k:k + FANOUT]) for k in range(0, len(digests), FANOUT)])
        digests = [_hash(run) for run in texts[-1]]
    return texts, digests[0]


def _local(texts: list[list[str]], i: int) -> tuple[list[int], list[str]]:
    """Place in its run and siblings, per level of the superblock, of node i."""
    ats, sibs = [], []
    for runs in texts:
        run, at = runs[i // FANOUT], i % FANOUT
        ats.append(at)
        sibs.append(run[:64 * at] + run[64 * at + 64:])
        i //= FANOUT
    return ats, sibs


def _fold(digest: str, ats, sibs) -> str:
    for at, sib in zip(ats, sibs):
        digest = _hash(sib[:64 * at] + digest + sib[64 * at:])
    return digest


def _block() -> Column:
    return F.expr(f"pos div {FANOUT ** SPAN}").cast("long").alias("block")


def _climb(nodes: DataFrame) -> list[DataFrame]:
    """The nodes, and above them the nodes every SPAN levels, up to the roots.
    Trees that are down to one node stay behind."""
    span = SPAN

    def up(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        size = int(pdf["size"].iloc[0])
        levels = min(span, _height(size))
        _, top = _runs([bytes(d).hex() for d in pdf["digest"]], levels)
        return pd.DataFrame({"tree": [pdf["tree"].iloc[0]], "pos": [int(pdf["pos"].iloc[0]) // FANOUT ** span],
                             "size": [-(-size // FANOUT ** levels)], "digest": [bytes.fromhex(top)]})

    levels = [nodes]
    largest = nodes.agg(F.max("size")).first()[0] or 0
    while largest > 1:
        below = levels[-1].select("tree", "pos", "size", "digest").filter("size > 1")
        levels.append(materialize(below.groupBy("tree", _block()).applyInPandas(up, _NODE), "merkle-nodes"))
        largest = -(-largest // FANOUT ** SPAN)
    return levels


def _roots(levels: list[DataFrame]) -> DataFrame:
    """(tree, digest) of the trees' last nodes."""
    roots = [level.filter("size = 1").select("tree", "digest") for level in levels]
    out = roots[0]
    for other in roots[1:]:
        out = out.unionByName(other)
    return out


def _descend(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """What lies outside each superblock of the lowest level: places and
    siblings from its node to the whole root.  `tops` has them for the trees'
    own roots (block 0)."""
    def down(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("pos")
        texts, _ = _runs([bytes(d).hex() for d in nodes["digest"]],
                         min(SPAN, _height(int(nodes["size"].iloc[0]))))
        above = outer.iloc[0]
        paths = [_local(texts, i) for i in range(len(nodes))]
        return pd.DataFrame({
            "tree": nodes["tree"], "block": nodes["pos"],
            "ats": [a + [int(x) for x in above["ats"]] for a, _ in paths],
            "sibs": [s + list(above["sibs"]) for _, s in paths],
            "subroot": above["subroot"]})

    def ended(level: DataFrame) -> DataFrame:
        return tops.join(level.filter("size = 1").select("tree"), "tree", "left_semi")

    outer = ended(levels[-1])
    for level, below in zip(levels[:0:-1], levels[-2::-1]):
        paths = level.select("tree", "pos", "size", "digest").groupBy("tree", _block()).cogroup(
            outer.groupBy("tree", "block")).applyInPandas(down, _OUTER)
        outer = materialize(paths, "merkle-outer").unionByName(ended(below))
    return outer


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """One row per row of `docs`: leaf, subroot of its source, root, digest of
    its proof, the root folded from the proof and whether it is the root.

    `tampered` (boolean) marks rows whose text is lower-cased (A-Z) before
    folding, as a changed copy would be.  Nulls in any field have their own mark
    (`-`), a null source is a source of its own and comes first; null ids come
    first in their source.  Rows with one id are ordered by leaf, and equal rows
    have equal leaves in neighbouring places.  A text of any length is hashed
    whole.  An empty table gives no rows; other columns are not read.
    """
    forged = F.when(tampered, leaf_digest(F.translate("text", _UPPER, _LOWER))) if tampered is not None \
        else F.lit(None).cast("binary")
    leaves = materialize(docs.select(
        F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col("source"))).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"), leaf_digest().alias("digest"), forged.alias("forged")),
        "merkle-leaves")
    # equal rows without end would share a range: their place in the files parts them
    leaves = leaves.select("*", F.col("_metadata.row_index").alias("row"))
    placed = with_positions(leaves, [F.col("doc_id").asc_nulls_first(), F.col("digest").asc(), F.col("row").asc()],
                            ["tree"], "pos", "size", "merkle-ranked")
    levels = _climb(placed)
    subroots = materialize(_roots(levels), "merkle-subroots")
    # the sources' roots are the nodes of one more tree
    upper = materialize(with_positions(subroots, [F.col("tree").asc()], None, "pos", "size", "merkle-sources").select(
        F.col("tree").alias("of"), F.lit("").alias("tree"), "pos", "size", "digest"), "merkle-upper")
    tower = _climb(upper)
    last = _roots(tower).first()
    if last is None:
        return docs.sparkSession.createDataFrame([], RESULT)
    root = bytes(last["digest"]).hex()
    top = docs.sparkSession.createDataFrame([("", 0, [], [], "")], _OUTER)
    tops = _paths(upper, _descend(tower, top))
    outer = _descend(levels, materialize(tops, "merkle-tops"))

    def finish(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("pos")
        leaves = [bytes(d).hex() for d in nodes["digest"]]
        texts, _ = _runs(leaves, min(SPAN, _height(int(nodes["size"].iloc[0]))))
        above = outer.iloc[0]
        rest, known = "".join(above["sibs"]), {}
        proofs, folded = [], []
        for i, (leaf, other) in enumerate(zip(leaves, nodes["forged"])):
            ats, sibs = _local(texts, i)
            proofs.append(_hash("".join(sibs) + rest))
            node = _fold(leaf if other is None else bytes(other).hex(), ats, sibs)
            if node not in known:
                known[node] = _fold(node, above["ats"], above["sibs"])
            folded.append(known[node])
        return pd.DataFrame({"doc_id": nodes["doc_id"].astype("Int64"), "leaf": leaves, "subroot": above["subroot"],
                             "root": root, "proof_sha256": proofs, "folded_root": folded,
                             "verified": [f == root for f in folded]})

    return placed.groupBy("tree", _block()).cogroup(outer.groupBy("tree", "block")).applyInPandas(finish, RESULT)


def _paths(upper: DataFrame, outer: DataFrame) -> DataFrame:
    """Per source (as tree): places and siblings from its root to the whole
    root, and that root's digest, in the form of `_descend`'s tops."""
    def local(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("pos")
        digests = [bytes(d).hex() for d in nodes["digest"]]
        texts, _ = _runs(digests, min(SPAN, _height(int(nodes["size"].iloc[0]))))
        above = outer.iloc[0]
        paths = [_local(texts, i) for i in range(len(nodes))]
        return pd.DataFrame({
            "tree": nodes["of"], "block": 0,
            "ats": [a + [int(x) for x in above["ats"]] for a, _ in paths],
            "sibs": [s + list(above["sibs"]) for _, s in paths], "subroot": digests})

    return upper.groupBy("tree", _block()).cogroup(outer.groupBy("tree", "block")).applyInPandas(local, _OUTER)


def tampered_fifth() -> Column:
    """Rows whose decimal id has a crc32 that 5 divides; none without an id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
