"""Vectorised words, lines and shingles of an Arrow string column.

Text stays in the Arrow buffer as UTF-8 bytes.  Word hashes are differences of
a running polynomial over the bytes (odd base, modulo 2^64, then mixed; long
spans by blocks), so a batch needs a few numpy passes and no Python object per
word.  Work goes in
slices of about a quarter of a megabyte; a longer text is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE = U(0x9E3779B97F4A7C15)
_SLICE = 1 << 18
_CHUNK = 1 << 20
_BLOCK = 64

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser (public constants)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def odd_constants(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=U) * _BASE + U(seed)) | U(1)


class _Powers:
    """Powers of the base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, dtype=U)
        self.down = np.ones(1, dtype=U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            inverse = U(pow(int(_BASE), -1, 1 << 64))
            up, down = np.full(size, _BASE, dtype=U), np.full(size, inverse, dtype=U)
            up[0] = down[0] = U(1)
            self.up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        return self.up, self.down


_POWERS = _Powers()


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span; spans ascend and do not overlap.

    A polynomial modulo 2^64 tells short spans apart, but gives long regular ones
    (a Thue-Morse sequence and its complement) the same value for any base.  So
    longer spans are hashed by blocks, and the blocks' hashes are mixed with
    their place before they are added up."""
    blocks = np.maximum(-(-(ends - starts) // _BLOCK), 1)
    if not len(starts) or blocks.max() == 1:
        return _polynomials(data, starts, ends)
    first = np.concatenate(([0], np.cumsum(blocks)))
    place = np.arange(first[-1]) - np.repeat(first[:-1], blocks)
    begin = np.repeat(starts, blocks) + _BLOCK * place
    parts = _polynomials(data, begin, np.minimum(begin + _BLOCK, np.repeat(ends, blocks)))
    return np.where(blocks == 1, parts[first[:-1]], _placed_sums(parts, place, first))


def hash_runs(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each run of values (hashes, none empty); runs ascend and do
    not overlap.  Every value is mixed with its place in the run."""
    n = ends - starts
    first = np.concatenate(([0], np.cumsum(n)))
    place = np.arange(first[-1]) - np.repeat(first[:-1], n)
    return _placed_sums(values[np.repeat(starts, n) + place], place, first)


def _placed_sums(values: np.ndarray, place: np.ndarray, first: np.ndarray) -> np.ndarray:
    if not len(values):
        return np.empty(0, dtype=U)
    mixed = mix(values + (place.astype(U) + U(1)) * _BASE)
    return mix(np.add.reduceat(mixed, first[:-1]) ^ np.diff(first).astype(U))


def _polynomials(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), dtype=U)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _CHUNK, "right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        up, down = _POWERS.get(hi - lo + 1)
        run = np.empty(hi - lo + 1, dtype=U)
        run[0] = 0
        np.cumsum((data[lo:hi].astype(U) + U(1)) * up[:hi - lo], out=run[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((run[e] - run[s]) * down[s])
        i = j
    return out


class Texts:
    """The texts of one slice: bytes, and the words of all of them in a row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self.data, self.offsets = data, offsets
        self.n = len(offsets) - 1
        full = np.zeros(len(data) + 2, dtype=bool)
        full[1:-1] = ~_BLANK[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        here = full[1:-1]
        self.starts = np.flatnonzero(here & (~full[:-2] | edge[:-1]))
        self.ends = np.flatnonzero(here & (~full[2:] | edge[1:])) + 1
        #: word k of text t has first[t] <= k < first[t + 1]
        self.first = np.searchsorted(self.starts, offsets)
        self._hashes: np.ndarray | None = None

    @property
    def words(self) -> np.ndarray:
        if self._hashes is None:
            self._hashes = hash_spans(self.data, self.starts, self.ends)
        return self._hashes

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Byte starts and ends of all \\n-separated lines, and per text the
        first line (texts without a byte have one empty line)."""
        newline = np.flatnonzero(self.data == 0x0A)
        text = np.searchsorted(self.offsets, newline, "right") - 1
        per = np.bincount(text, minlength=self.n) + 1
        first = np.concatenate(([0], np.cumsum(per)))
        starts, ends = np.empty(first[-1], np.int64), np.empty(first[-1], np.int64)
        starts[first[:-1]], ends[first[1:] - 1] = self.offsets[:-1], self.offsets[1:]
        inner = np.ones(first[-1], dtype=bool)
        inner[first[:-1]] = False
        starts[inner] = newline + 1
        inner[:] = True
        inner[first[1:] - 1] = False
        ends[inner] = newline
        return starts, ends, first

    def totals(self, mark: np.ndarray) -> np.ndarray:
        """Per text the number of marked bytes."""
        run = np.concatenate(([0], np.cumsum(mark, dtype=np.int64)))
        return run[self.offsets[1:]] - run[self.offsets[:-1]]

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), self.n_words)

    def windows(self, size: int, values: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the windows of `size` words and the word each starts at,
        ascending; windows do not cross texts."""
        values = self.words if values is None else values
        if len(values) < size:
            return np.empty(0, dtype=U), np.empty(0, dtype=np.int64)
        at = np.arange(len(values) - size + 1)
        text = self.text_of_word
        at = at[text[:len(at)] == text[size - 1:]]
        return combine([values[at + k] for k in range(size)]), at

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Per text the sorted distinct window hashes, and their offsets.  A
        text with words but fewer than `size` has one shingle, of all of them."""
        hashes, at = self.windows(size)
        first = np.searchsorted(at, self.first)
        n_words = self.n_words
        parts, counts = [], np.zeros(self.n + 1, dtype=np.int64)
        for t in range(self.n):
            if first[t + 1] > first[t]:
                own = np.sort(hashes[first[t]:first[t + 1]])
                if len(own) > 1:
                    own = own[np.concatenate(([True], own[1:] != own[:-1]))]
            elif n_words[t]:
                own = combine([self.words[[k]] for k in range(self.first[t], self.first[t + 1])])
            else:
                continue
            parts.append(own)
            counts[t + 1] = len(own)
        flat = np.concatenate(parts) if parts else np.empty(0, dtype=U)
        return flat, np.cumsum(counts)


def combine(parts: list[np.ndarray]) -> np.ndarray:
    """Order-sensitive hash of equally long columns of hashes."""
    total = np.zeros_like(parts[0])
    for k, c in zip(parts, odd_constants(len(parts), 0x51)):
        total = total + k * c
    return mix(total + U(len(parts)))


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = _SLICE) -> Iterator[tuple[int, int, Texts]]:
    """(from, to, texts) over the rows of a batch."""
    yield from slices_of(batch.column(batch.schema.get_field_index(column)), max_bytes)


def slices_of(col: pa.Array, max_bytes: int = _SLICE) -> Iterator[tuple[int, int, Texts]]:
    """(from, to, texts) over a string column; a null text counts as empty."""
    col = col.cast(pa.large_string()).fill_null("")
    n = len(col)
    if not n:
        return
    bufs = col.buffers()
    offsets = np.frombuffer(bufs[1], dtype=np.int64)[col.offset:col.offset + n + 1]
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None else np.empty(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + max_bytes, "right")) - 1)
        j = min(j, n)
        lo, hi = int(offsets[i]), int(offsets[j])
        yield i, j, Texts(data[lo:hi], offsets[i:j + 1] - lo)
        i = j


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def list_array(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, type=kind))


def binary_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Byte ranges of one buffer as an Arrow binary column."""
    off = np.ascontiguousarray(offsets.astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(off) - 1,
                                 [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(data))])
