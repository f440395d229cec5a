"""Tokens of Arrow text columns as 64-bit hashes, straight from the UTF-8 bytes.

Separators are ASCII bytes, which never occur inside a multi-byte character, so
cutting bytes cuts characters correctly. Everything is numpy over a batch; a slab
of about a megabyte is hashed at a time, whatever the length of a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SLAB = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_powers: dict[str, np.ndarray] = {}

# Byte to class: 0 separates; neighbouring bytes of one class form one token.
SPACES = np.ones(256, np.uint8)
SPACES[[0x20, *range(0x09, 0x0E)]] = 0

# The same with runs of ASCII punctuation as tokens of their own.
RUNS = SPACES.copy()
for _first, _last in ((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E)):
    RUNS[_first : _last + 1] = 2

LOWER = np.arange(256, dtype=np.uint64)
LOWER[0x41:0x5B] += 32
AS_IS = np.arange(256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and where each row starts; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: str, rows: int = 256, size: int = 1 << 21) -> Iterator:
    """The batch in pieces of few rows and about `size` bytes of text at most."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, n in enumerate(lengths):
        if i > start and (total + n > size or i - start >= rows):
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if batch.num_rows > start:
        yield batch.slice(start)


def _power(kind: str, base: int, n: int) -> np.ndarray:
    known = _powers.get(kind)
    if known is None or len(known) < n:
        known = np.ones(n, np.uint64)
        known[1:] = np.uint64(base & _MASK)
        known = np.cumprod(known, dtype=np.uint64)
        if n <= 2 * _SLAB:
            _powers[kind] = known
    return known[:n]


def token_hashes(data, offsets, classes=SPACES, fold=AS_IS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens in order, and the number of tokens of each row."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    kind = classes[data]
    new = np.ones(len(data) + 1, bool)
    new[1:-1] = kind[1:] != kind[:-1]
    new[offsets] = True
    edges = np.flatnonzero(new)
    inside = kind[edges[:-1]] != 0
    starts, ends = edges[:-1][inside], edges[1:][inside]
    counts = np.diff(np.searchsorted(starts, offsets))
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        first = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, first + _SLAB, "right")))
        part = fold[data[first : ends[j - 1]]] + np.uint64(1)
        n = len(part)
        room = max(n + 1, _SLAB + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(part * _power("up", _BASE, room)[:n], dtype=np.uint64, out=sums[1:])
        s, e = starts[i:j] - first, ends[i:j] - first
        down = _power("down", pow(_BASE, -1, 1 << 64), room)
        out[i:j] = (sums[e] - sums[s]) * down[s]
        i = j
    return mix(out + (ends - starts).astype(np.uint64)), counts
