"""Training manifests: which page goes to which split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sastra.operators.packaging import number_rows

PROMPT = "<image>\n<|grounding|>Render this page as markdown."


def valid_real(labels: DataFrame) -> DataFrame:
    """Real pages with an image and an answer (grounded text); empty strings count as missing."""
    return labels.where("source = 'real' and image <> '' and grounded <> ''")


def split_pages(labels: DataFrame, val_frac: float = 0.05) -> DataFrame:
    """(image, page_id, source, split): synthetic pages in image order, the first `val_frac` of them (one at least) to val.

    Real pages with image and answer go to test. Labels must have distinct page ids.
    """
    made = labels.where("coalesce(source, 'synthetic') <> 'real'").select("image", "page_id").withColumn("key", F.struct("image", "page_id"))
    counted = number_rows(made, "key", "n")
    # of the staged rows, so the labels aren't read again
    cut = max(1, int(counted.count() * val_frac))
    split = counted.select("image", "page_id", F.lit("synthetic").alias("source"), F.when(F.col("n") <= cut, "val").otherwise("train").alias("split"))
    return split.union(valid_real(labels).select("image", "page_id", F.lit("real"), F.lit("test")))


def manifest_rows(labels: DataFrame, val_frac: float = 0.05, folder: str = "data/synthetic/labels") -> DataFrame:
    """The manifest with prompt, answer (grounded text) and the path of each label."""
    splits = split_pages(labels.dropDuplicates(["page_id"]), val_frac)
    answers = labels.dropDuplicates(["page_id"]).select("page_id", F.col("grounded").alias("answer"))
    return splits.join(answers, "page_id").select("split", "image", F.lit(PROMPT).alias("prompt"), "answer", "source", F.concat(F.lit(folder + "/"), "page_id", F.lit(".json")).alias("label"))
