"""Packaging of the filtered corpus: selection, totals, shards and the dataset card."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from sastra.functions.text import est_tokens
from sastra.plans.stage import stage


def permissive(docs: DataFrame) -> DataFrame:
    """Without documents flagged as non-commercial; a null flag is no flag."""
    return docs.where(~F.coalesce(F.col("non_commercial"), F.lit(False)))


def first_docs(docs: DataFrame, n: int | None, order: str = "doc_id") -> DataFrame:
    """The first n in order; none or zero means all."""
    return docs.orderBy(order).limit(n) if n else docs


def chars() -> Column:
    """The stored length, or that of the text where it is null or zero."""
    return F.coalesce(F.nullif(F.col("n_chars"), F.lit(0)), F.length("text").cast("bigint"), F.lit(0))


def corpus_totals(docs: DataFrame) -> DataFrame:
    """Per source, per licence and in all, in one scan: kind, name, docs, chars, nc_docs, est_tokens.

    An empty table gives no row.
    """
    rows = docs.select(F.coalesce("source", F.lit("unknown")).alias("source"), F.coalesce("license", F.lit("unknown")).alias("license"), chars().alias("chars"), F.coalesce(F.col("non_commercial"), F.lit(False)).alias("nc"))
    sums = rows.groupingSets([["source"], ["license"], []], "source", "license").agg(F.grouping_id().alias("g"), F.count(F.lit(1)).alias("docs"), F.sum("chars").alias("chars"), F.count_if("nc").alias("nc_docs"))
    kind = F.when(F.col("g") == 1, "source").when(F.col("g") == 2, "license").otherwise("all")
    return sums.select(kind.alias("kind"), F.coalesce("source", "license", F.lit("all")).alias("name"), "docs", F.coalesce("chars", F.lit(0)).alias("chars"), "nc_docs", est_tokens(F.coalesce("chars", F.lit(0))).alias("est_tokens"))


def number_rows(docs: DataFrame, order: str, name: str = "n") -> DataFrame:
    """Rows numbered from 1 in order, without one task for all: counts per range partition, then within.

    Ties are numbered in no fixed order, so `order` should be unique.
    """
    ranged = docs.repartitionByRange(order).sortWithinPartitions(order).withColumn("__p", F.spark_partition_id())
    # staged, since the ranges come from a sample that a second run could draw otherwise
    ranged = stage(ranged.withColumn("__i", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "ranged")
    sizes = ranged.groupBy("__p").agg(F.count(F.lit(1)).alias("__c"))
    # one row per partition
    offsets = sizes.withColumn("__before", F.coalesce(F.sum("__c").over(W.orderBy("__p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).select("__p", "__before")
    return ranged.join(offsets, "__p").withColumn(name, F.col("__before") + F.col("__i") + 1).drop("__p", "__i", "__before")


def assign_shards(docs: DataFrame, order: str = "doc_id", size: int = 50_000, prefix: str = "lm") -> DataFrame:
    """The rows with the name of their shard of `size` lines in order."""
    numbered = number_rows(docs, order, "__n")
    shard = F.floor((F.col("__n") - 1) / size).cast("int")
    return numbered.withColumn("shard", F.format_string(f"{prefix}-%05d", shard)).drop("__n")


def text_lines(docs: DataFrame) -> DataFrame:
    """(value): each text as one line."""
    return docs.where("text is not null").select(F.replace("text", F.lit("\n"), F.lit(" ")).alias("value"))


def dataset_card(docs: DataFrame, title: str = "Text corpus") -> str:
    """A Markdown card: totals, documents by source and by licence, most first (ties by name)."""
    rows = corpus_totals(docs).collect()  # a row per source and licence
    every = next(r for r in rows if r.kind == "all")
    out = [f"# {title}", "", f"- documents: {every.docs:,}", f"- characters: {every.chars:,}", f"- tokens (estimated): {every.est_tokens:,}", f"- non-commercial documents: {every.nc_docs:,}"]
    for kind, head in (("source", "Source"), ("license", "Licence")):
        out += ["", f"| {head} | Documents | Characters |", "| --- | ---: | ---: |"]
        out += [f"| {r['name']} | {r.docs:,} | {r.chars:,} |" for r in sorted((r for r in rows if r.kind == kind), key=lambda r: (-r.docs, r["name"]))]
    return "\n".join(out) + "\n"
