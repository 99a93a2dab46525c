"""MinHash signatures of character shingles, and band keys, over whole Arrow batches.

One hash per shingle: its range of values picks a bin, and a signature is the least hash of each bin (one
permutation hashing). An empty bin borrows from a bin that a hash of (bin, attempt) picks, the same for all texts,
so equal minima still have the probability of the Jaccard similarity (Shrivastava 2017).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sastra.functions import grams
from sastra.functions.text import valid

PERMUTATIONS = 128
_EMPTY = np.uint64(1) << np.uint64(grams.GRAM_BITS)


def signatures(hashes: np.ndarray, starts: np.ndarray, bins: int = PERMUTATIONS) -> np.ndarray:
    """The minima of each set (rows) in each of `bins` ranges; a set without members has no hash below 2^52."""
    n = len(starts) - 1
    out = np.full((n, bins), _EMPTY, np.uint64)
    row = np.repeat(np.arange(n), np.diff(starts))
    cell = row * bins + ((hashes >> np.uint64(20)) * np.uint64(bins) >> np.uint64(grams.GRAM_BITS - 20)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1]))) if len(cell) else np.zeros(0, np.int64)
    out.ravel()[cell[first]] = hashes[first]
    filled = out != _EMPTY
    r, c = np.nonzero(~filled & (np.diff(starts) > 0)[:, None])
    attempt = 0
    while len(r):
        attempt += 1
        donor = (grams.mix((c.astype(np.uint64) << np.uint64(32)) | np.uint64(attempt)) % np.uint64(bins)).astype(np.int64)
        ok = filled[r, donor]
        out[r[ok], c[ok]] = out[r[ok], donor[ok]]
        r, c = r[~ok], c[~ok]
    return out


def band_keys(minima: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key per band of `rows` minima."""
    key = np.zeros((len(minima), bands), np.uint64)
    for j in range(rows):
        key = grams.mix(key * np.uint64(31) + minima[:, j : bands * rows : rows])
    return grams.mix(key ^ np.arange(bands, dtype=np.uint64)[None, :]).view(np.int64)


def minhash(texts: DataFrame, k: int = 5, permutations: int = PERMUTATIONS, bands: int | None = None, rows: int | None = None) -> DataFrame:
    """(id, n, signature) of (id, text): the number of shingles and the minima, or one key per band if bands are given."""

    def run(batches):
        for batch in batches:
            for a, b in grams.row_ranges(batch.column(1)):
                hashes, starts = grams.distinct_grams(batch.column(1).slice(a, b - a), k)
                found = signatures(hashes, starts, permutations)
                found = found.view(np.int64) if bands is None else band_keys(found, bands, rows)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, found.size + 1, found.shape[1]), pa.int32()), pa.array(np.ascontiguousarray(found).ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(np.diff(starts), pa.int32()), lists], ["id", "n", "signature"])

    return texts.select(F.col("id").cast("bigint").alias("id"), valid("text").alias("text")).mapInArrow(run, "id bigint, n int, signature array<bigint>")


def jaccard(pairs: DataFrame, threshold: float, k: int = 5) -> DataFrame:
    """(a, b, jaccard) of (a, b, x, y) whose texts x and y are alike, by intersection of their sorted shingle hashes."""

    def run(batches):
        for batch in batches:
            whole = pa.concat_arrays([batch.column(2), batch.column(3)]).dictionary_encode()
            sets: list[np.ndarray] = []
            for a, b in grams.row_ranges(whole.dictionary):
                hashes, starts = grams.distinct_grams(whole.dictionary.slice(a, b - a), k)
                sets += [hashes[i:j] for i, j in zip(starts[:-1], starts[1:])]
            index, m = whole.indices.to_numpy(), len(batch)
            both = np.array([len(np.intersect1d(sets[index[i]], sets[index[i + m]], assume_unique=True)) for i in range(m)], np.float64)
            size = np.array([len(sets[i]) for i in index], np.float64)
            score = both / np.maximum(size[:m] + size[m:] - both, 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score)], ["a", "b", "jaccard"]).filter(pa.array(score >= threshold))

    return pairs.select("a", "b", valid("x").alias("x"), valid("y").alias("y")).mapInArrow(run, "a bigint, b bigint, jaccard double")
