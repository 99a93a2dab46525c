"""Vectorised pre-tokenisation for byte-level BPE vocabularies.

Equals the usual split pattern of these vocabularies,

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

but finds all piece starts of a chunk of texts with array operations. A piece is named by a
64-bit hash of its code points, so each distinct piece is tokenised once and the rest is a gather.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import regex

from sastra.llm.textops import as_text, mix64

LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3


@lru_cache(1)
def char_classes() -> np.ndarray:
    """The class of every code point, by the regex library's \\p{L}, \\p{N} and \\s."""
    table = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, range(0xD800))) + "\0" * 0x800 + "".join(map(chr, range(0xE000, 0x110000)))
    for pattern, value in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", SPACE)):
        for m in regex.finditer(pattern, every):
            table[m.start() : m.end()] = value
    return table


def piece_starts(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Ascending positions in `flat` at which a piece starts; no piece crosses a row end."""
    n = len(flat)
    if not n:
        return np.zeros(0, np.int64)
    cls = char_classes()[flat]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    first = first[:n]
    change = np.ones(n, bool)
    change[1:] = cls[1:] != cls[:-1]
    start = change | first
    blank = cls == SPACE
    # The last blank of a run that other characters follow is parted from the run. A plain space
    # joins the piece that follows, any other blank is a piece of its own.
    last = np.ones(n, bool)
    last[:-1] = start[1:]
    row_end = np.ones(n, bool)
    row_end[:-1] = first[1:]
    lone = np.flatnonzero(blank & last & ~row_end)
    start[lone] = True
    joins = lone[flat[lone] == 32]
    start[joins + 1] = False
    # Contractions: a single quote that starts a piece, with letters after it.
    quote = np.flatnonzero((flat == 39) & start)
    quote = quote[quote + 1 < n]
    quote = quote[~first[quote + 1]]
    if len(quote):
        one = flat[quote + 1]
        far = np.minimum(quote + 2, n - 1)
        two = np.where((quote + 2 < n) & ~first[far], flat[far], 0)
        pairs = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        single = np.isin(one, [ord(c) for c in "stmd"])
        for hit, width in ((single, 2), (pairs & ~single, 3)):
            at = quote[hit]
            start[at + 1] = False
            after = at + width
            start[after[after < n]] = True
    return np.flatnonzero(start)


def piece_hashes(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each piece, from prefix sums of position-weighted code points."""
    n = len(flat)
    lengths = np.diff(np.append(starts, n))
    where = np.arange(n) - np.repeat(starts, lengths)
    terms = mix64((flat.astype(np.uint64) << np.uint64(32)) | where.astype(np.uint64))
    sums = np.add.reduceat(terms, starts) if len(starts) else np.zeros(0, np.uint64)
    return mix64(sums ^ (lengths.astype(np.uint64) << np.uint64(40)))


def pieces_of(text: str) -> list[str]:
    """The pieces of one text, for tests."""
    flat = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = piece_starts(flat, np.array([0, len(flat)]))
    ends = np.append(starts[1:], len(flat))
    whole = as_text(flat)
    return [whole[a:b] for a, b in zip(starts, ends)]
