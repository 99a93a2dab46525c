"""Vectorised k-grams of Arrow string batches.

A batch of texts is one array of code points with row offsets, so hashes over whole texts are a few numpy passes.
Texts are never cut: a chunk holds whole rows, and a row above the chunk size is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of UTF-8, and rows, per chunk.
CHUNK_BYTES, CHUNK_ROWS = 2 << 20, 4095
#: Bits of a gram's hash; the row within a chunk is packed above them.
GRAM_BITS = 52
_STEP = np.uint64(0x9E3779B97F4A7C15)


def row_ranges(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of whole rows of about `CHUNK_BYTES` each."""
    total = np.concatenate(([0], np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))))
    start = 0
    while start < len(texts):
        end = int(np.searchsorted(total, total[start] + CHUNK_BYTES, side="right")) - 1
        end = min(max(end, start + 1), start + CHUNK_ROWS, len(texts))
        yield start, end
        start = end


def points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All code points in one array, and the n + 1 offsets of the rows; a null is an empty text."""
    values = [t or "" for t in texts.to_pylist()]
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in values], dtype=np.int64)))
    return np.frombuffer("".join(values).encode("utf-32-le", "surrogatepass"), np.uint32), offsets


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def distinct_grams(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct k-grams of each text as ascending hashes, line feeds as blanks, and their row offsets.

    A text of up to k code points is its own gram; an empty one has none.
    """
    n = len(texts)
    flat, offsets = points(texts)
    flat = np.where(flat == 10, 32, flat)
    sizes = np.diff(offsets)
    rows = np.repeat(np.arange(n), sizes)
    left = offsets[1:][rows] - np.arange(len(flat))
    whole = (sizes > 0) & (sizes <= k)
    begin = (left >= k) & (sizes[rows] > k) | whole[rows] & (left == sizes[rows])
    at = np.flatnonzero(begin)
    h = np.zeros(len(at), np.uint64)
    for j in range(k):
        inside = left[at] > j
        h = np.where(inside, h * _STEP + flat[np.minimum(at + j, max(len(flat) - 1, 0))] + np.uint64(1), h)
    key = (mix(h) >> np.uint64(64 - GRAM_BITS)) | (rows[at].astype(np.uint64) << np.uint64(GRAM_BITS))
    key = np.unique(key)
    starts = np.searchsorted(key, np.arange(n + 1, dtype=np.uint64) << np.uint64(GRAM_BITS))
    return key & np.uint64((1 << GRAM_BITS) - 1), starts.astype(np.int64)
