"""Problem 3: rows of evaluation splits that occur in the training split, exactly or nearly.

A weighted cosine join between two sides, the training rows and the others:

1. Rows with the same reading text form a class per side; one row stands for each class.
2. A text is the vector of its distinct 5-grams, each with its weight, scaled to length 1. Terms are ordered
   from rare to common by a count table of the evaluation side (`gramsketch`: a fixed size, on a scale that
   does not fill up).
3. Inverted lists hold a term at place i only while the rest of the vector from i on could still reach
   the threshold (its norm, the residual, is at least the threshold). The first term that two vectors
   share in that order is on both lists if their cosine reaches the threshold, so none is lost. Training
   terms that no evaluation text has are not listed.
4. Lists meet where residual x residual, and residual sum x the other's largest weight, both reach the threshold.
5. Exact dot products of the candidate pairs.

Two weightings: "equal" gives all terms one weight, for which Jaccard >= t implies cosine >= 2t / (1 + t), the
threshold of the join, so `SplitOverlap` loses no pair; "idf" gives rare terms more, ln(1 + texts / texts with
the term), for `weighted_overlap`, whose measure is the weighted cosine itself.

Cases: null answers, null splits, null row ids and reading texts under 25 code points are in no pair; repeated rows each
count under their own row id; empty sides give no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sastra.functions.text import BLANKS, once, valid
from sastra.llm import classes, gramsketch, textops
from sastra.plans.stage import stage

MIN_CHARS = 25
#: Evaluation texts of a term that are listed under one key.
BLOCK = 1000
#: In place of a second term where a text has one only; terms are not negative.
_MISSING = -1


def reading_text(answer) -> F.Column:
    """What stands between the reference tags, or all of the answer without tags; blanks made even."""
    a = F.col(answer) if isinstance(answer, str) else answer
    # each piece before a closing tag, from its first opening tag on
    pieces = F.split(a, r"<\|/ref\|>")
    opened = F.filter(F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0))), lambda x: F.contains(x, F.lit("<|ref|>")))
    inside = F.transform(opened, lambda x: x.substr(F.instr(x, "<|ref|>") + F.lit(7), F.length(x)))
    text = F.when(F.size(inside) > 0, F.array_join(inside, " ")).otherwise(a)
    text = F.regexp_replace(text, "[​-‍﻿]", "")
    return F.trim(F.regexp_replace(text, f"[{BLANKS}]+", " "))


def count_table(texts: DataFrame) -> np.ndarray:
    """How common each 5-gram is among the texts; see `gramsketch`."""

    def count(batches):
        cells = gramsketch.CellCounts()
        for batch in batches:
            column = batch.column(0)
            for a, b in textops.chunks(column):
                cells.add(textops.grams(*textops.codepoints(column.slice(a, b - a)))[0])
        yield pa.RecordBatch.from_arrays([pa.array(range(gramsketch.PARTS), pa.int32()), pa.array(cells.parts(), pa.binary())], ["part", "counts"])

    return gramsketch.merged(texts.select("text").mapInArrow(count, "part int, counts binary"))


def weights_of(level: np.ndarray, texts: int | None) -> np.ndarray:
    """The weight of a term by its level in the count table of so many texts; all 1 for equal weights."""
    if texts is None:
        return np.ones(len(level))
    return np.log1p(texts / np.maximum(np.exp2(level / 8.0) - 1, 0.5))


_LIST = "term bigint, block int, id bigint, residual float, rest float, top float, first bigint, second bigint"


def postings(texts: DataFrame, table, threshold: float, idf: int | None, evaluation: bool, block: int = BLOCK) -> DataFrame:
    """(term, block, id, residual, rest, top, first, second): the lists of (id, text); see the module's text, 3.

    A term that more than `block` evaluation texts may have is parted: each of these is in a block of its own
    choice, and the training texts are in all blocks. `first` and `second` are the first two listed terms of the text.
    """

    def run(batches):
        for batch in batches:
            column = batch.column(1)
            ids_all = batch.column(0).to_numpy()
            for a, b in textops.chunks(column):
                hashes, starts = textops.grams(*textops.codepoints(column.slice(a, b - a)))
                terms, level = gramsketch.rare_first(hashes, starts, table.value)
                sizes = np.diff(starts)
                row = np.repeat(np.arange(b - a), sizes)
                w = weights_of(level, idf)
                squares = np.concatenate(([0.0], np.cumsum(w * w)))
                norm = np.sqrt(squares[starts[1:]] - squares[starts[:-1]])
                w = w / norm[row]
                sums, squares = np.concatenate(([0.0], np.cumsum(w))), np.concatenate(([0.0], np.cumsum(w * w)))
                end = starts[1:][row]
                residual = np.sqrt(np.maximum(squares[end] - squares[:-1], 0))
                rest = sums[end] - sums[:-1]
                top = np.zeros(b - a)
                if len(w):
                    some = sizes > 0
                    top[some] = np.maximum.reduceat(w, starts[:-1][some])
                keep = residual >= threshold - 1e-6
                if not evaluation:
                    keep &= level > 0
                at, row = np.flatnonzero(keep), row[keep]
                begin = np.searchsorted(row, np.arange(b - a))[row]
                after = np.minimum(begin + 1, max(len(row) - 1, 0))
                listed = terms[at].view(np.int64)
                first, second = listed[begin], np.where(row[after] == row, listed[after], _MISSING)
                blocks = np.maximum(np.ceil((np.exp2(level[at] / 8.0) - 1) / block), 1).astype(np.int64)
                ids = ids_all[a:b][row]
                if evaluation:
                    each, part = np.arange(len(at)), (textops.mix64(ids.astype(np.uint64)) % blocks.astype(np.uint64)).astype(np.int64)
                else:
                    each = np.repeat(np.arange(len(at)), blocks)
                    part = np.arange(len(each)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
                floats = (pa.array(x[each].astype(np.float32)) for x in (residual[at], rest[at], top[row]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(listed[each]), pa.array(part, pa.int32()), pa.array(ids[each]), *floats, pa.array(first[each]), pa.array(second[each])],
                    ["term", "block", "id", "residual", "rest", "top", "first", "second"],
                )

    return texts.select("id", "text").mapInArrow(run, _LIST)


def cosine_candidates(left: DataFrame, right: DataFrame, table, threshold: float, idf: int | None = None, block: int = BLOCK) -> DataFrame:
    """(a, b): a superset of the pairs of (id, text) rows whose cosine reaches the threshold; `table` counts the right side.

    A pair is given at the first term that both have, as far as the first two terms of each tell which that is.
    """
    x = postings(left, table, threshold, idf, False, block).toDF("term", "block", "a", "ra", "sa", "ta", "fx", "gx")
    y = postings(right, table, threshold, idf, True, block).toDF("term", "block", "b", "rb", "sb", "tb", "fy", "gy")
    c = F.col
    slack = F.lit(threshold - 1e-4)
    near = (c("ra") * c("rb") >= slack) & (c("sa") * c("tb") >= slack) & (c("sb") * c("ta") >= slack)
    known = lambda t: (c(t) == c("fy")) | (c(t) == c("gy"))
    here = F.when(known("fx"), c("term") == c("fx")).otherwise(~known("gx") | (c("gx") == _MISSING) | (c("term") == c("gx")))
    return x.join(y, ["term", "block"]).where(near & here).select("a", "b").distinct()


def exact_scores(pairs: DataFrame, table=None, idf: int | None = None) -> DataFrame:
    """(a, b, cosine, jaccard) of (a, b, x, y): exact dot products, over equal weights or those of the table."""

    def run(batches):
        for batch in batches:
            whole = pa.concat_arrays([batch.column(2), batch.column(3)]).dictionary_encode()
            sets: list[np.ndarray] = []
            for s, e in textops.chunks(whole.dictionary):
                hashes, starts = textops.grams(*textops.codepoints(whole.dictionary.slice(s, e - s)))
                sets += [hashes[i:j] for i, j in zip(starts[:-1], starts[1:])]
            index = whole.indices.to_numpy()
            square = lambda h: len(h) if idf is None else float((weights_of(table.value[(h & np.uint64(len(table.value) - 1)).astype(np.int64)], idf) ** 2).sum())
            shared = [np.intersect1d(sets[index[k]], sets[index[k + len(batch)]], assume_unique=True) for k in range(len(batch))]
            both = np.array([len(s) for s in shared], np.float64)
            size = np.array([len(sets[i]) for i in index], np.float64)
            norm = np.array([square(s) for s in sets])[index] if len(index) else size
            dots = np.array([square(s) for s in shared], np.float64)
            m = len(batch)
            cosine = dots / np.sqrt(np.maximum(norm[:m] * norm[m:], 1e-12))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cosine), pa.array(both / np.maximum(size[:m] + size[m:] - both, 1))], ["a", "b", "cosine", "jaccard"])

    return pairs.select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint, cosine double, jaccard double")


class SplitOverlap:
    """The overlaps of the training split with all other splits of a manifest.

    Pairs are alike where Jaccard is `threshold` or more; with `cosine`, where the idf-weighted cosine is that or more.
    """

    def __init__(self, manifest: DataFrame, threshold: float = 0.8, train: str = "train", cosine: float | None = None):
        spark = manifest.sparkSession
        rows = manifest.select(F.col("row_id").cast("bigint").alias("id"), "split", "source", once(reading_text(valid("answer"))).alias("text"))
        rows = rows.where((F.length("text") >= MIN_CHARS) & F.col("split").isNotNull() & F.col("id").isNotNull())
        read = stage(rows.withColumn("side", (F.col("split") == train).cast("int")).withColumn("cls", F.unhex(F.md5("text"))), "manifest")
        least = read.groupBy("side", "cls").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
        #: (id, split, source, side, cls, rep, copies)
        self.rows = stage(read.select("id", "split", "source", "side", "cls").join(least, ["side", "cls"]), "members")
        # Staged, so that its size is known: the copies are broadcast if they are few, else shuffled.
        copies = stage(self.rows.where("id <> rep").select("side", "cls", "id"), "copies")
        reps = read.join(copies, ["side", "cls", "id"], "left_anti")
        trains, others = reps.where("side = 1").select("id", "text"), reps.where("side = 0").select("id", "text")
        table = spark.sparkContext.broadcast(count_table(others))
        idf = None if cosine is None else others.count()
        met = stage(cosine_candidates(trains, others, table, 2 * threshold / (1 + threshold) if cosine is None else cosine, idf), "candidates")
        needed = lambda df, key: df.join(stage(met.select(F.col(key).alias("id")).distinct(), "wanted"), "id", "left_semi").distinct()
        texts = met.join(needed(trains, "a").toDF("a", "x"), "a").join(needed(others, "b").toDF("b", "y"), "b")
        scored = exact_scores(texts, table, idf)
        near = F.col("jaccard") >= threshold - 1e-12 if cosine is None else F.col("cosine") >= cosine - 1e-12
        #: (a, b, cosine, jaccard) between class representatives, a on the training side.
        self.links = stage(scored.where(near).groupBy("a", "b").agg(F.max("cosine").alias("cosine"), F.max("jaccard").alias("jaccard")), "overlaps")

    def pairs(self) -> DataFrame:
        """(row_id_a, row_id_b): every pair across the sides, the smaller id first, whatever the sizes of classes."""
        side = lambda s: self.rows.where(f"side = {s}").select("id", "rep", "copies")
        return classes.pairs_across(self.links, side(1), side(0)).toDF("row_id_a", "row_id_b")

    def report(self) -> DataFrame:
        """(split, source, rows, overlapping, exact): the evaluation rows with a training partner, counted once."""
        best = self.links.groupBy("b").agg(F.max("jaccard").alias("best"), F.max((F.col("jaccard") >= 1).cast("int")).alias("same"))
        joined = self.rows.where("side = 0").join(best, F.col("rep") == F.col("b"), "left")
        return joined.groupBy("split", "source").agg(F.count(F.lit(1)).alias("rows"), F.count("best").alias("overlapping"), F.coalesce(F.sum("same"), F.lit(0)).alias("exact"))


def weighted_overlap(manifest: DataFrame, cosine: float = 0.85, train: str = "train") -> DataFrame:
    """(row_id, partner, cosine): each evaluation row that overlaps the training split by the weighted cosine, with its best partner.

    The partner is the training text of the greatest cosine, of the least row id among equals.
    """
    found = SplitOverlap(manifest, train=train, cosine=cosine)
    best = found.links.groupBy("b").agg(F.max(F.struct(F.round("cosine", 9).alias("c"), (-F.col("a")).alias("a"))).alias("m"))
    return found.rows.where("side = 0").join(best, F.col("rep") == F.col("b")).select(F.col("id").alias("row_id"), (-F.col("m.a")).alias("partner"), F.col("m.c").alias("cosine"))
