"""Vectorised views of Arrow string batches, shared by the operators of this subpackage.

A batch of texts is handled as one array of code points with row offsets, so that counts and
hashes over whole texts run as a few numpy passes instead of a Python loop over characters.
Texts are never cut: a chunk holds whole rows, and a row above the chunk size is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of UTF-8 per chunk; bounds the memory of one numpy pass (about 60 times this).
CHUNK_BYTES = 2 << 20
#: Rows per chunk; the row number within a chunk is packed into 12 bits by `grams`.
CHUNK_ROWS = 4095


def chunks(texts: pa.Array, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of whole texts of about `chunk_bytes` each."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and (total + size > chunk_bytes or i - start >= CHUNK_ROWS):
            yield start, i
            start, total = i, 0
        total += size
    if start < len(texts):
        yield start, len(texts)


def codepoints(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array of code points (uint32), and the n + 1 row offsets. A null is an empty text."""
    texts = pc.fill_null(texts, "")
    lengths = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    bounds = np.frombuffer(texts.buffers()[1], width)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2]
    raw = memoryview(data)[int(bounds[0]) : int(bounds[-1])] if data is not None and len(texts) else b""
    flat = np.frombuffer(str(raw, "utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32) if len(raw) else np.zeros(0, np.uint32)
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    if offsets[-1] != len(flat):
        raise ValueError("texts are not valid UTF-8")
    return flat, offsets


def rows_of(offsets: np.ndarray) -> np.ndarray:
    """The row number of each code point."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def as_text(flat: np.ndarray) -> str:
    """The code points as one Python string, indexed as the array is."""
    return flat.astype("<u4", copy=False).tobytes().decode("utf-32-le", "surrogatepass")


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


#: Odd multiplier of the rolling 5-gram polynomial.
_P = np.uint64(0x9E3779B97F4A7C15)
GRAM = 5
#: Bits of a gram hash; the other 12 hold the row within a chunk while sorting.
GRAM_BITS = 52


def grams(flat: np.ndarray, offsets: np.ndarray, k: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """The distinct k-grams of each text, as ascending 52-bit hashes, and their row offsets.

    A text of fewer than k code points has none. One sort of (row, hash) gives both the
    distinct sets and their order.
    """
    n = len(offsets) - 1
    if n > CHUNK_ROWS:
        raise ValueError("too many rows in a chunk")
    if len(flat) < k:
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    m = len(flat) - k + 1
    h = flat[:m].astype(np.uint64)
    for j in range(1, k):
        h *= _P
        h += flat[j : m + j]
    rows = rows_of(offsets)[:m]
    keep = np.arange(m) + k <= offsets[rows + 1]
    key = (mix64(h[keep]) >> np.uint64(64 - GRAM_BITS)) | (rows[keep].astype(np.uint64) << np.uint64(GRAM_BITS))
    key.sort()
    if len(key):
        key = key[np.concatenate(([True], key[1:] != key[:-1]))]
    starts = np.searchsorted(key, np.arange(n + 1, dtype=np.uint64) << np.uint64(GRAM_BITS))
    return key & np.uint64((1 << GRAM_BITS) - 1), starts.astype(np.int64)
