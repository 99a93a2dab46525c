"""Problem 2: documents that are edited copies of one another, at 5-gram Jaccard >= threshold.

1. Equal texts form classes (MD5 of the text with line feeds as blanks); one text stands for each.
2. A representative's distinct 5-grams are a sorted array of hashes, put from rare to common by a count
   table of fixed size. Two sets with an overlap of `need` share `SHARED` grams at least among the first
   n - need + `SHARED` of each; so each of a set's first grams is a tile, with the set's size class in the
   tile's key, and alike texts meet in that many tiles. No pair can be missed.
3. A tile is read in order of size class, and a row meets the run of rows up to the class of size / threshold.
   A tile of more than `HOT` rows goes another way: size bands (a band and the next one up) and blocks
   within bands are joined as keys of their own, so its work spreads over tasks.
4. A pair counts its tiles, and one with `SHARED` of them is a candidate. Where the first two grams of each
   tell which gram is the first that both have, the pair is given there only, once and for all tiles; so
   families of edited copies, which share nearly all tiles, don't give a row for each.
5. Bitmaps: each set has a hashed parity bitmap. The bits in which two bitmaps differ bound the symmetric
   difference from below, so the overlap from above; pairs whose bound is too low never have their texts
   fetched.
6. The pairs left are decided by exact intersection of the sorted arrays.

Scale: a text gives a fifth of its number of grams as rows of a few numbers; texts move only to pairs that
pass the bitmaps. Classes are expanded at the end, in blocks. No tile, group or class is capped.

Cases: null texts and texts under 25 code points are in no pair; ids that occur in several rows stand
for each of their texts and never pair with themselves; empty input gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sastra.functions.text import valid
from sastra.llm import classes, gramsketch, textops
from sastra.operators.components import connected_components
from sastra.plans.stage import stage

#: Rows of a tile that one task pairs by itself; larger tiles are parted by size bands and blocks.
HOT = 400
#: Rows of tiles per task.
TASK_ROWS = 2_000_000
#: Tiles that a pair must meet in.
SHARED = 5
#: Rows of a band, or copies of a class, that meet others within one task.
BLOCK = 1000
MIN_CHARS = 25
#: Size classes to a doubling, and the bits that hold a class below the gram in a tile's key.
CLASSES, CLASS_BITS = 64, 11
#: In place of a second gram where a set has one only; grams are not negative.
_MISSING = -1
_TILE = "key bigint, pos int, id bigint, n int, first bigint, second bigint"


def bitmap_width(size: int) -> int:
    """Bits for a set of this size: the power of two from half of it on, 64 at least."""
    return max(64, 1 << (max(size, 2) // 2 - 1).bit_length())


def parity_bitmap(hashes: np.ndarray) -> bytes:
    """Bit i is the parity of the number of hashes that fall on i."""
    width = bitmap_width(len(hashes))
    hits = np.bincount((hashes & np.uint64(width - 1)).astype(np.int64), minlength=width)
    return np.packbits((hits & 1).astype(np.uint8), bitorder="little").tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """A lower bound of the symmetric difference of two sets, from their parity bitmaps."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def signatures(texts: DataFrame) -> DataFrame:
    """(id, n, bits) of (id, text): number of 5-grams and bitmap; and the count table's parts (part, counts) of each task."""

    def run(batches):
        cells = gramsketch.CellCounts()
        names = ["id", "n", "bits", "part", "counts"]
        nothing = lambda k, t: pa.nulls(k, t)
        for batch in batches:
            column = batch.column(1)
            for a, b in textops.chunks(column):
                hashes, starts = textops.grams(*textops.codepoints(column.slice(a, b - a)))
                cells.add(hashes)
                bits = [parity_bitmap(hashes[s:e]) for s, e in zip(starts[:-1], starts[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(np.diff(starts), pa.int32()), pa.array(bits, pa.binary()), nothing(b - a, pa.int32()), nothing(b - a, pa.binary())], names)
        k = gramsketch.PARTS
        yield pa.RecordBatch.from_arrays([nothing(k, pa.int64()), nothing(k, pa.int32()), nothing(k, pa.binary()), pa.array(range(k), pa.int32()), pa.array(cells.parts(), pa.binary())], names)

    return texts.select("id", "text").mapInArrow(run, "id bigint, n int, bits binary, part int, counts binary")


def size_class(n: np.ndarray) -> np.ndarray:
    """`CLASSES` classes to each doubling of the size."""
    return np.minimum(np.floor(CLASSES * np.log2(np.maximum(n, 1))), (1 << CLASS_BITS) - 1).astype(np.int64)


def tile_rows(texts: DataFrame, levels, threshold: float) -> DataFrame:
    """`_TILE` of (id, text): a row for each of a set's first grams; `first` and `second` are the first two."""

    def run(batches):
        for batch in batches:
            column = batch.column(1)
            ids = batch.column(0).to_numpy()
            for a, b in textops.chunks(column):
                hashes, starts = textops.grams(*textops.codepoints(column.slice(a, b - a)))
                ordered = gramsketch.rare_first(hashes, starts, levels.value)[0].view(np.int64)
                n = np.diff(starts)
                prefix = np.minimum(n, n - np.ceil(threshold * n - 1e-9).astype(np.int64) + SHARED)
                row = np.repeat(np.arange(b - a), prefix)
                pos = np.arange(len(row)) - np.repeat(np.cumsum(prefix) - prefix, prefix)
                begin = starts[:-1][row]
                second = ordered[np.minimum(begin + 1, max(len(ordered) - 1, 0))] if len(row) else ordered[:0]
                key = ordered[begin + pos] << CLASS_BITS | size_class(n)[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(pos, pa.int32()), pa.array(ids[a:b][row]), pa.array(n[row], pa.int32()), pa.array(ordered[begin]), pa.array(np.where(n[row] < 2, _MISSING, second))],
                    ["key", "pos", "id", "n", "first", "second"],
                )

    return texts.select("id", "text").mapInArrow(run, _TILE)


def tile_pairs(key, pos, id_, n, first, second, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, tiles) of the rows of tiles, given in order of the key: pairs, and the number of tiles each stands for."""
    gram, size = key >> CLASS_BITS, key & ((1 << CLASS_BITS) - 1)
    reach = CLASSES * -np.log2(threshold) + 1
    out = []
    live, step = np.arange(len(key) - 1), 1
    while len(live):
        i, j = live, live + step
        fits = (gram[i] == gram[j]) & (size[j] - size[i] <= reach)
        live, i, j = live[fits], i[fits], j[fits]
        need = np.ceil((n[i] + n[j]) * (threshold / (1 + threshold)) - 1e-9)
        some = need - SHARED
        ok = (np.minimum(n[i], n[j]) >= np.maximum(n[i], n[j]) * threshold - 1e-9) & (pos[i] < n[i] - some) & (pos[j] < n[j] - some) & (id_[i] != id_[j])
        i, j, need = i[ok], j[ok], need[ok]
        known = [(x == first[j]) | (x == second[j]) for x in (first[i], second[i])]
        told = known[0] | known[1]
        ok = np.where(known[0], gram[i] == first[i], ~known[1] | (gram[i] == second[i]))
        out.append((id_[i[ok]], id_[j[ok]], np.where(told | (need < SHARED), SHARED, 1)[ok].astype(np.int32)))
        step += 1
        live = live[live + step < len(key)]
    if not out:
        return id_[:0], id_[:0], np.zeros(0, np.int32)
    x, y, tiles = (np.concatenate(c) for c in zip(*out))
    return np.minimum(x, y), np.maximum(x, y), tiles


def _tile_pairs(rows: DataFrame, threshold: float, hot: int, parts: int) -> DataFrame:
    """(a, b, tiles) of the tiles of up to `hot` rows, and the rows of larger ones as they are (a null); in `parts` tasks."""
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
    names = ["a", "b", "tiles", "key", "pos", "id", "n", "first", "second"]

    def run(batches):
        held: list[np.ndarray] = []  # the open tile's rows, or nothing once it is hot
        open_gram, is_hot = None, False

        def given(columns):
            x, y, tiles = tile_pairs(*columns, threshold)
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y), pa.array(tiles), *(pa.nulls(len(x), t) for t in types)], names)

        def passed(columns):
            k = len(columns[0])
            yield pa.RecordBatch.from_arrays([pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()), *(pa.array(c.astype(t.to_pandas_dtype())) for c, t in zip(columns, types))], names)

        for batch in batches:
            columns = [batch.column(i).to_numpy().astype(np.int64) for i in range(6)]
            if held:
                columns = [np.concatenate((h, c)) for h, c in zip(held, columns)]
                held = []
            gram = columns[0] >> CLASS_BITS
            if not len(gram):
                continue
            edge = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1])))
            size = np.diff(np.append(edge, len(gram)))
            large = size > hot
            if is_hot and gram[0] == open_gram:
                large[0] = True
            per_row = np.repeat(large, size)
            if per_row.any():
                yield from passed([c[per_row] for c in columns])
            last = np.zeros(len(gram), bool)
            last[edge[-1] :] = True
            closed = ~per_row & ~last
            if closed.any():
                yield from given([c[closed] for c in columns])
            open_gram, is_hot = gram[-1], bool(large[-1])
            if not is_hot:
                held = [c[last] for c in columns]
        if held:
            yield from given(held)

    # the key alone is the order: the gram, then the size class
    met = rows.repartition(parts, F.shiftright("key", CLASS_BITS)).sortWithinPartitions("key")
    return met.mapInArrow(run, f"a bigint, b bigint, tiles int, {_TILE}")


def _hot_pairs(rows: DataFrame, threshold: float) -> DataFrame:
    """(a, b, tiles) of the hot tiles' rows: band meets band and the next one up, block meets block."""
    c = F.col
    band = F.floor(F.log(c("n").cast("double")) / F.lit(float(-np.log(threshold)))).cast("int") if threshold < 1 else c("n")
    banded = rows.withColumn("gram", F.shiftright("key", CLASS_BITS)).withColumn("band", band)
    sizes = banded.groupBy("gram", "band").agg(F.count(F.lit(1)).alias("m"))
    placed = stage(banded.join(sizes, ["gram", "band"]).withColumn("own", classes.own_block("m", BLOCK)), "banded")
    large = sizes.select("gram", F.explode(F.array("band", c("band") - 1)).alias("low"), c("band").alias("high"), c("m").alias("mh"))
    #: (gram, low, high, ml, mh): which bands meet, and their sizes
    shape = stage(sizes.select("gram", c("band").alias("low"), c("m").alias("ml")).join(large, ["gram", "low"]), "bands")
    fields = ("id", "n", "pos", "first", "second")
    name = lambda p: [c(f).alias(f + p) for f in fields]
    low = placed.select("gram", c("band").alias("low"), c("own").alias("i"), *name("_x")).join(shape, ["gram", "low"]).select("gram", "low", "high", "i", classes.each_block("mh", BLOCK).alias("j"), *[f + "_x" for f in fields])
    high = placed.select("gram", c("band").alias("high"), c("own").alias("j"), *name("_y")).join(shape, ["gram", "high"]).select("gram", "low", "high", classes.each_block("ml", BLOCK).alias("i"), "j", *[f + "_y" for f in fields])
    met = low.join(high, ["gram", "low", "high", "i", "j"])
    need = F.ceil((c("n_x") + c("n_y")) * F.lit(threshold / (1 + threshold)) - F.lit(1e-9))
    in_order = (c("n_x") < c("n_y")) | (c("n_x") == c("n_y")) & (c("id_x") < c("id_y"))
    fits = in_order & (c("id_x") != c("id_y")) & (c("n_x") >= c("n_y") * F.lit(threshold) - F.lit(1e-9)) & (c("pos_x") < c("n_x") - need + SHARED) & (c("pos_y") < c("n_y") - need + SHARED)
    known = lambda x: (c(x) == c("first_y")) | (c(x) == c("second_y"))
    here = F.when(known("first_x"), c("gram") == c("first_x")).otherwise(~known("second_x") | (c("gram") == c("second_x")))
    tiles = F.when(known("first_x") | known("second_x") | (need < SHARED), SHARED).otherwise(1)
    return met.where(fits & here).select(F.least("id_x", "id_y").alias("a"), F.greatest("id_x", "id_y").alias("b"), tiles.alias("tiles"))


def _by_bitmap(pairs: DataFrame, threshold: float) -> DataFrame:
    def run(batches):
        for batch in batches:
            n, m = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            differ = np.array([least_difference(x, y) for x, y in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist())], np.float64)
            most = (n + m - differ) / 2
            keep = pa.array(most >= threshold * (n + m - most) - 1e-6)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(keep)

    return pairs.select("a", "b", "n", "m", "x", "y").mapInArrow(run, "a bigint, b bigint")


def exact_jaccard(pairs: DataFrame, threshold: float) -> DataFrame:
    """(a, b, jaccard) of (a, b, x, y) whose texts x and y are alike, by sorted-array intersection."""

    def run(batches):
        for batch in batches:
            whole = pa.concat_arrays([batch.column(2), batch.column(3)]).dictionary_encode()
            sets: list[np.ndarray] = []
            for s, e in textops.chunks(whole.dictionary):
                hashes, starts = textops.grams(*textops.codepoints(whole.dictionary.slice(s, e - s)))
                sets += [hashes[i:j] for i, j in zip(starts[:-1], starts[1:])]
            index = whole.indices.to_numpy()
            scores = np.zeros(len(batch))
            for k in range(len(batch)):
                x, y = sets[index[k]], sets[index[k + len(batch)]]
                both = len(np.intersect1d(x, y, assume_unique=True))
                scores[k] = both / max(1, len(x) + len(y) - both)
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores)], ["a", "b", "jaccard"])
            yield out.filter(pa.array(scores >= threshold - 1e-12))

    return pairs.select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint, jaccard double")


def _sized(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.replace(valid(F.col(f"`{text_col}`")), F.lit("\n"), F.lit(" ")).alias("text")).where(F.length("text") >= MIN_CHARS)


class NearDuplicates:
    """Classes of equal texts and the alike pairs between their representatives."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8):
        if not 0 < threshold <= 1:
            raise ValueError("the threshold is a share above 0")
        spark = docs.sparkSession
        sized = _sized(docs, id_col, text_col)
        keyed = stage(sized.select("id", F.unhex(F.md5("text")).alias("cls"), F.xxhash64("text").alias("h")), "classes")
        least = keyed.groupBy("cls").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
        joined = stage(keyed.join(least, "cls").select("id", "rep", "copies", "h"), "members")
        #: (id, rep, copies): the class of each document.
        self.members = joined.select("id", "rep", "copies")
        # Staged, so that its size is known: the copies are broadcast if they are few, else shuffled.
        copies = stage(joined.where("id <> rep").select("id", "h"), "copies")
        reps = sized.withColumn("h", F.xxhash64("text")).join(copies, ["id", "h"], "left_anti").select("id", "text")
        signed = stage(signatures(reps), "signatures")
        levels = spark.sparkContext.broadcast(gramsketch.merged(signed.where("part is not null").select("part", "counts")))
        # as many tasks as the tiles' rows need, and no fewer than usual
        grams = signed.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(grams * (1 - threshold) // TASK_ROWS) + 1)
        met = stage(_tile_pairs(tile_rows(reps, levels, threshold), threshold, HOT, parts), "tiles")
        hot = met.where("a is null").select("key", "pos", "id", "n", "first", "second")
        pairs = met.where("a is not null").select("a", "b", "tiles")
        if not hot.isEmpty():
            pairs = pairs.union(_hot_pairs(hot, threshold))
        enough = pairs.groupBy("a", "b").agg(F.sum("tiles").alias("tiles")).where(F.col("tiles") >= SHARED).select("a", "b")
        bits = signed.where("id is not null").select("id", "n", "bits").distinct()
        near = enough.join(bits.toDF("a", "n", "x"), "a").join(bits.toDF("b", "m", "y"), "b")
        # Staged, so that its size is known when the texts are met: a small table of ids is broadcast, a large one shuffled.
        left_over = stage(_by_bitmap(near, threshold), "candidates")
        wanted = left_over.select(F.col("a").alias("id")).union(left_over.select(F.col("b").alias("id"))).distinct()
        needed = stage(reps.join(stage(wanted, "wanted"), "id", "left_semi").distinct(), "texts")
        texts = left_over.join(needed.toDF("a", "x"), "a").join(needed.toDF("b", "y"), "b")
        #: (a, b, jaccard) between representatives, a < b.
        self.links = stage(exact_jaccard(texts, threshold).groupBy("a", "b").agg(F.max("jaccard").alias("jaccard")), "links")

    def pairs(self) -> DataFrame:
        """(a, b), a < b: every alike pair of documents, whatever the sizes of classes and groups.

        Copies meet in blocks (see `classes`), so a hot class spreads over as many tasks as it has pairs of blocks.
        """
        links = self.links.select("a", "b")
        return classes.pairs_within(self.members, BLOCK).union(classes.pairs_across(links, self.members, self.members, BLOCK)).toDF("a", "b")

    def groups(self) -> DataFrame:
        """(id, class_id, group_id, copies, links): one row per document of 25 code points or more.

        class_id: least id of the equal texts; group_id: least id of the group that links connect;
        links: number of other texts that the document's text is alike to.
        """
        both = self.links.select("a", "b").union(self.links.select(F.col("b"), F.col("a")))
        degree = both.toDF("rep", "other").groupBy("rep").agg(F.count(F.lit(1)).alias("links"))
        parts = connected_components(self.links, "a", "b").toDF("rep", "group_id")
        joined = self.members.join(degree, "rep", "left").join(parts, "rep", "left")
        return joined.select("id", F.col("rep").alias("class_id"), F.coalesce("group_id", "rep").alias("group_id"), "copies", F.coalesce("links", F.lit(0)).alias("links"))
