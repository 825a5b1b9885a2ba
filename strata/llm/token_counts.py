"""Token counts: batch encoding in Arrow functions that return lengths only.

A text is split at safe boundaries: a space between two ASCII letters, where
the byte-level pre-tokeniser ends one piece and begins the next whatever
surrounds them, so the pieces' counts add up to the text's.  (Special strings
hold no space and are never split.)  Equal pieces of a task are encoded once;
what is left goes to the library in batches of about `BATCH_BYTES` bytes.
"""

from __future__ import annotations

import os
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import textbatch as tb
from strata.llm.common import bounded_batches

LIMIT = 1024                # tokens beyond which over_limit is true
BATCH_BYTES = 1 << 18       # bytes handed to the library at once
KNOWN_PIECES = 1 << 20      # piece counts a task remembers (about 100 MB); then it starts afresh
SLICE = 1 << 21

_ALPHA = np.zeros(256, dtype=bool)
_ALPHA[0x41:0x5B] = True
_ALPHA[0x61:0x7B] = True


def safe_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions at which a piece starts: texts and safe boundaries."""
    alpha = _ALPHA[data]
    safe = np.zeros(len(data) + 1, dtype=bool)
    if len(data) > 2:
        safe[1:-2] = (data[1:-1] == 0x20) & alpha[:-2] & alpha[2:]
    # a boundary needs its letters in the same text
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    safe[inner - 1] = False
    safe[offsets] = True
    safe[len(data)] = False
    return np.flatnonzero(safe)


class Counter:
    """Counts of pieces under one tokenizer file of the `tokenizers` library."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[int, int] = {}

    def pieces(self, texts: list[str]) -> list[int]:
        """Token counts of short texts, encoded in batches of even bytes."""
        out, batch, size = [], [], 0
        for t in texts:
            batch.append(t)
            size += len(t.encode())
            if size >= BATCH_BYTES:
                out += self._encode(batch)
                batch, size = [], 0
        return out + self._encode(batch)

    def _encode(self, batch: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)]

    def texts(self, t: tb.Texts) -> np.ndarray:
        """Token counts of the texts of a slice."""
        starts = safe_starts(t.data, t.offsets)
        if not len(starts):
            return np.zeros(t.n, dtype=np.int64)
        ends = np.append(starts[1:], len(t.data))
        keys, at, which = np.unique(tb.hash_spans(t.data, starts, ends), return_index=True, return_inverse=True)
        keys = keys.tolist()
        if len(self.known) > KNOWN_PIECES:
            self.known.clear()
        new = [k for k, h in enumerate(keys) if h not in self.known]
        raw = t.data.tobytes()
        got = self.pieces([raw[starts[at[k]]:ends[at[k]]].decode() for k in new])
        self.known.update(zip((keys[k] for k in new), got))
        counts = np.fromiter((self.known[h] for h in keys), dtype=np.int64, count=len(keys))[which]
        run = np.concatenate(([0], np.cumsum(counts)))
        first = np.searchsorted(starts, t.offsets)
        return run[first[1:]] - run[first[:-1]]


def _counting(path: str) -> Callable:
    def run(batches):
        counter = Counter(path)
        for batch in batches:
            for i, j, t in tb.slices(batch, "text", SLICE):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(np.diff(t.offsets), pa.int64()),
                     pa.array(counter.texts(t), pa.int64())], names=["id", "n_bytes", "n_tokens"])
    return run


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT) -> DataFrame:
    """(id_col, n_bytes, n_tokens, over_limit) per input row, as the byte-level
    BPE tokenizer file at `path` counts the whole text: no begin, end or added
    special tokens, no truncation or padding, special strings inside texts as
    the library takes them by default.

    Null and empty texts have no byte and no token.  Repeated rows are counted
    row by row.  An empty table gives no row.  Other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(_counting(path), f"id {kind}, n_bytes long, n_tokens long").select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
