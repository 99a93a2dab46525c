"""How common each 5-gram is in a corpus, as a table of fixed size, for orders from rare to common.

A cell counts the texts that hold one of its 5-grams, on a scale of eighths of a doubling, so that no count
is too large for a byte. The count of a cell is never less than that of a gram in it: a gram of a rare cell
is rare. Orders made from it are only better or worse, never wrong, whatever the size of the table.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The table has 2^BITS cells of a byte, whatever the corpus; tasks hand it on in parts.
BITS, PARTS = 22, 64


class CellCounts:
    """The cells of one task."""

    def __init__(self, bits: int = BITS):
        self.cells = np.zeros(1 << bits, np.int64)

    def add(self, hashes: np.ndarray) -> None:
        """Adds distinct grams of whole texts."""
        self.cells += np.bincount((hashes & np.uint64(len(self.cells) - 1)).astype(np.int64), minlength=len(self.cells))

    def parts(self) -> list[bytes]:
        return [packed(x) for x in self.cells.reshape(PARTS, -1)]


def packed(counts: np.ndarray) -> bytes:
    """Counts as compressed planes of bytes: most cells fill the lowest one only."""
    return zlib.compress(np.minimum(counts, 0xFFFFFFFF).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64)


def merged(partials: DataFrame) -> np.ndarray:
    """The table (uint8 by cell; 0: no text) from rows (part int, counts binary) of all tasks, in two levels."""

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": pdf["part"].iloc[:1], "counts": [packed(sum(unpacked(x) for x in pdf["counts"]))]})

    # tables of 32 tasks are added up first, so no task reads those of all
    laned = partials.select("part", "counts", F.floor(F.spark_partition_id() / 32).alias("lane"))
    sums = laned.groupBy("part", "lane").applyInPandas(add, "part int, counts binary").groupBy("part").applyInPandas(add, "part int, counts binary")

    def scale(batches):
        for batch in batches:
            counts = [unpacked(x).astype(np.float64) for x in batch.column(1).to_pylist()]
            levels = [np.minimum(np.round(8 * np.log2(c + 1)), 255).astype(np.uint8).tobytes() for c in counts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(levels, pa.binary())], ["part", "levels"])

    rows = {r.part: np.frombuffer(r.levels, np.uint8) for r in sums.mapInArrow(scale, "part int, levels binary").toLocalIterator()}
    return np.concatenate([rows[i] for i in range(PARTS)]) if rows else np.zeros(1 << BITS, np.uint8)


def rare_first(hashes: np.ndarray, starts: np.ndarray, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each set's grams from rare to common, equally common ones by hash, and their levels."""
    level = levels[(hashes & np.uint64(len(levels) - 1)).astype(np.int64)]
    row = np.repeat(np.arange(len(starts) - 1), np.diff(starts)).astype(np.uint64)
    order = np.argsort((row << np.uint64(52)) | (level.astype(np.uint64) << np.uint64(44)) | (hashes >> np.uint64(8)), kind="stable")
    return hashes[order], level[order]
