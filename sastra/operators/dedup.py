"""Exact and near duplicates, the first in order kept.

Near duplicates follow keep-first greedily: a document goes if a *kept* earlier one is alike, which is not
the same as one per connected component. In parallel that is the lexicographically first maximal
independent set: components are settled apart, large ones in staged rounds, in which documents without an
undecided earlier neighbour stay and their later neighbours go (Blelloch, Fineman, Shun 2012).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sastra.functions.minhash import jaccard, minhash
from sastra.operators.components import connected_components
from sastra.plans.stage import stage


def mark_exact(docs: DataFrame, order: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows with `verdict`: empty (null or empty text), first, or exact_dup.

    One shuffle of ids and hashes, with partial aggregation, so a text that a third of all rows share is no hot spot.
    """
    sha = F.sha1(F.col(text_col))
    first = docs.where(f"{text_col} <> ''").groupBy(sha.alias("__sha")).agg(F.min(order).alias("__first"))
    joined = docs.withColumn("__sha", F.when(F.col(text_col) != "", sha)).join(first, "__sha", "left")
    verdict = F.when(F.col("__first").isNull(), "empty").when(F.col("__first") == F.col(order), "first").otherwise("exact_dup")
    return joined.withColumn("verdict", verdict).drop("__sha", "__first")


def near_candidates(texts: DataFrame, bands: int = 25, rows: int = 5, k: int = 5, permutations: int = 128) -> DataFrame:
    """(a, b, n, m), a < b: pairs of (id, text) rows that agree in a whole band of minima, and their numbers of shingles."""
    if bands * rows > permutations:
        raise ValueError("the bands need more minima than there are")
    signed = stage(minhash(texts, k, permutations, bands, rows), "signatures")
    keyed = signed.where("n > 0").select("id", "n", F.explode("signature").alias("key"))
    return keyed.toDF("a", "n", "key").join(keyed.toDF("b", "m", "key"), "key").where("a < b").select("a", "b", "n", "m").distinct()


def near_pairs(texts: DataFrame, threshold: float = 0.8, bands: int = 25, rows: int = 5, verify: bool = True, k: int = 5, permutations: int = 128) -> DataFrame:
    """(a, b, jaccard) of alike pairs of (id, text) rows; without `verify` every candidate, jaccard null.

    25 bands of 5 miss a pair at 0.8 with probability 5e-5. Texts are fetched only for pairs whose sizes can reach
    the threshold.
    """
    met = near_candidates(texts, bands, rows, k, permutations)
    if not verify:
        return met.select("a", "b", F.lit(None).cast("double").alias("jaccard"))
    sized = stage(met.where(F.least("n", "m") >= F.greatest("n", "m") * F.lit(threshold - 1e-9)).select("a", "b"), "candidates")
    wanted = stage(sized.select(F.col("a").alias("id")).union(sized.select("b")).distinct(), "wanted")
    needed = texts.select("id", "text").join(wanted, "id", "left_semi")
    return jaccard(sized.join(needed.toDF("a", "x"), "a").join(needed.toDF("b", "y"), "b"), threshold)


#: Pairs of a component that one task settles by itself.
SMALL = 100_000


def greedy_drops(pairs: DataFrame, small: int = SMALL) -> DataFrame:
    """(id): what keep-first drops, given alike pairs (a, b), a < b.

    Pairs of one component go to one task each, which settles it in order; only components of more than `small`
    pairs take rounds over the cluster, in which all documents without an undecided earlier neighbour stay.
    """
    found = stage(pairs.select("a", "b").distinct(), "pairs")

    def settle(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        gone: set[int] = set()
        for a, b in pdf.sort_values(["a", "b"])[["a", "b"]].itertuples(index=False):
            if a not in gone:
                gone.add(b)
        return pd.DataFrame({"id": sorted(gone)}, dtype="int64")

    if found.count() <= small:  # one task's work in all, so components aren't needed
        return found.withColumn("part", F.spark_partition_id() * 0).groupBy("part").applyInPandas(settle, "id bigint")
    parts = connected_components(found, "a", "b").toDF("a", "part")
    parted = stage(found.join(parts, "a"), "parted")
    sizes = parted.groupBy("part").agg(F.count(F.lit(1)).alias("__n"))
    sized = stage(parted.join(sizes, "part"), "sized")
    dropped = sized.where(F.col("__n") <= small).groupBy("part").applyInPandas(settle, "id bigint")
    left = sized.where(F.col("__n") > small).select("a", "b")
    while not left.isEmpty():
        later = left.select(F.col("b").alias("a")).distinct()
        heads = left.join(later, "a", "left_anti").select("a").distinct()
        gone = stage(left.join(heads, "a", "left_semi").select(F.col("b").alias("id")).distinct(), "gone")
        dropped = dropped.union(gone)
        left = stage(left.join(gone.toDF("a"), "a", "left_anti").join(gone.toDF("b"), "b", "left_anti").join(heads, "a", "left_anti"), "pairs")
    return dropped


def banding(threshold: float, permutations: int, miss: float = 1e-4) -> tuple[int, int]:
    """Bands and rows: the most rows per band with which a pair at the threshold is missed with probability `miss` at most."""
    for rows in range(permutations, 0, -1):
        if (1 - threshold**rows) ** (permutations // rows) <= miss:
            return permutations // rows, rows
    return permutations, 1


def deduplicate(docs: DataFrame, order: str = "doc_id", text_col: str = "text", threshold: float = 0.8, verify: bool = True, k: int = 5, permutations: int = 128) -> DataFrame:
    """The rows with `verdict`: empty, exact_dup, near_dup or kept.

    A copy of a text whose first occurrence is a near duplicate counts as exact_dup.
    """
    marked = stage(mark_exact(docs, order, text_col), "marked")
    texts = marked.where("verdict = 'first'").select(F.col(order).alias("id"), F.col(text_col).alias("text"))
    bands, rows = banding(threshold, permutations)
    drops = greedy_drops(near_pairs(texts, threshold, bands, rows, verify, k, permutations)).select(F.col("id").alias(order), F.lit(True).alias("__near"))
    joined = marked.join(drops, order, "left")
    verdict = F.when(F.col("verdict") != "first", F.col("verdict")).when(F.col("__near"), "near_dup").otherwise("kept")
    return joined.withColumn("verdict", verdict).drop("__near")
