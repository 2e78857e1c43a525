"""Vectorised text primitives over Arrow string columns (NumPy, in tasks).

A task sees Arrow batches.  ``text_chunks`` cuts the text column of a batch
into runs of whole texts of at most ``CHUNK_BYTES`` (a longer text forms a
run of its own), so temporaries stay bounded by the longest text, not by
the batch.  Words are the maximal runs of bytes outside 0x20 and 0x09-0x0D;
their hashes come from one prefix sum over the bytes, so cost is linear and
free of per-word Python work.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1_000_000
U64 = np.uint64
GOLDEN = 0x9E3779B97F4A7C15
MASK64 = (1 << 64) - 1


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser (xor-shift-multiply) of 64-bit values."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def byte_weights(seed: int) -> np.ndarray:
    """256 odd 64-bit weights derived from a seed."""
    start = (seed * GOLDEN) & MASK64
    steps = np.arange(1, 257, dtype=np.uint64) * U64(GOLDEN) + U64(start)
    return mix64(steps) | U64(1)


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64."""
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class SpanHasher:
    """64-bit hashes of byte spans of one buffer from a single prefix sum.

    span hash = mix(sum of weight[byte] * BASE**(i - start)); equal bytes
    give equal hashes wherever they stand."""

    BASE = 0xD6E8FEB86659FD93

    def __init__(self, seed: int = 1) -> None:
        self.weights = byte_weights(seed)
        self.inverse = pow(self.BASE, -1, 1 << 64)
        self.up = self.down = np.empty(0, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) < n:
            self.up, self.down = powers(self.BASE, n), powers(self.inverse, n)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        """Prefix sums with a leading zero, for ``spans``."""
        self._grow(len(data) + 1)
        out = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.weights[data] * self.up[: len(data)], dtype=np.uint64, out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (prefix[end] - prefix[start]) * self.down[start]
        return mix64(raw + U64(GOLDEN) * (end - start).astype(np.uint64))


def is_space_table() -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[0x20] = True
    table[0x09:0x0E] = True
    return table


def lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    return table


def string_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw, offsets


def text_chunks(column: pa.Array):
    """Yield (first row, bytes, offsets from 0) for runs of whole texts."""
    raw, offsets = string_buffers(column)
    n, at = len(offsets) - 1, 0
    while at < n:
        stop = int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, side="right")) - 1
        stop = min(max(stop, at + 1), n)
        yield at, raw[offsets[at] : offsets[stop]], offsets[at : stop + 1] - offsets[at]
        at = stop


class Words:
    """Words of the texts of one chunk: byte spans, the text of each word
    and, per text, the range of its words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        solid = ~is_space_table()[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        before = np.empty(len(data), dtype=bool)
        if len(data):
            before[0] = False
            before[1:] = solid[:-1]
        starts_here = solid & (~before | edge[:-1])
        after = np.empty(len(data), dtype=bool)
        if len(data):
            after[-1] = False
            after[:-1] = solid[1:]
        ends_here = solid & (~after | edge[1:])
        self.start = np.flatnonzero(starts_here)
        self.end = np.flatnonzero(ends_here) + 1
        self.bounds = np.searchsorted(self.start, offsets)
        self.text = np.repeat(np.arange(len(offsets) - 1), np.diff(self.bounds))


def window_hashes(word_hash: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive words (order matters: each
    place has its own unrelated odd multiplier)."""
    place = mix64((np.arange(width, dtype=np.uint64) + U64(11)) * U64(GOLDEN)) | U64(1)
    n = len(word_hash) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        total += word_hash[k : k + n] * place[k]
    return mix64(total)
