"""Cleaning and segmentation of raw documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sastra.functions import text as T


def segments(docs: DataFrame, carry: list[str], text_col: str = "text", min_script: float = 0.5, min_chars: int = 20, max_chars: int = 20_000, script: str = T.KHMER) -> DataFrame:
    """One row per paragraph of the cleaned texts: `carry`, seg_no from 0, text, n_chars, ratio, verdict.

    verdict: kept, dropped_short, dropped_long or dropped_script, tested in this order (length first).
    Null and empty texts give no row. A column named like an output must not be in `carry`.
    """
    bare = docs.select(*carry, T.once(T.strip_markup(F.coalesce(F.col(text_col), F.lit("")))).alias("__bare"))
    cleaned = bare.select(*carry, T.once(T.normalize("__bare")).alias("__clean")).where("__clean <> ''")
    parts = cleaned.select(*carry, "__clean", F.posexplode_outer(T.inner_paragraphs("__clean")).alias("__no", "__part"))
    parts = parts.select(*carry, F.coalesce("__no", F.lit(0)).alias("seg_no"), F.coalesce("__part", "__clean").alias("text"))
    measured = parts.withColumn("n_chars", F.length("text").cast("bigint")).withColumn("ratio", T.script_ratio("text", script))
    verdict = F.when(F.col("n_chars") < min_chars, "dropped_short").when(F.col("n_chars") > max_chars, "dropped_long").when(F.col("ratio") < min_script, "dropped_script").otherwise("kept")
    return measured.withColumn("verdict", verdict)


def kept_segments(docs: DataFrame, carry: list[str], **limits) -> DataFrame:
    """The kept paragraphs as documents: lang_mix is the script ratio to three places, n_chars the new length."""
    kept = segments(docs, carry, **limits).where("verdict = 'kept'")
    return kept.select(*carry, "seg_no", "text", F.round("ratio", 3).alias("lang_mix"), "n_chars")


def clean_counts(docs: DataFrame, **limits) -> DataFrame:
    """One row of counts: documents in, paragraphs kept, and dropped by cause.

    `dropped_length` is the sum of the short and the long ones.
    """
    found = segments(docs.select("text"), [], **limits).groupBy().agg(
        F.count_if(F.col("verdict") == "kept").alias("kept"),
        F.count_if(F.col("verdict") == "dropped_short").alias("dropped_short"),
        F.count_if(F.col("verdict") == "dropped_long").alias("dropped_long"),
        F.count_if(F.col("verdict") == "dropped_script").alias("dropped_script"),
    )
    names = ["kept", "dropped_short", "dropped_long", "dropped_script"]
    total = docs.agg(F.count(F.lit(1)).alias("docs_in")).select("docs_in", *[F.lit(0).alias(n) for n in names])
    both = total.union(found.select(F.lit(0), *names))
    return both.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in ("docs_in", *names)]).withColumn("dropped_length", F.col("dropped_short") + F.col("dropped_long"))
