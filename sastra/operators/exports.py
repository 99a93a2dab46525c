"""Annotation exports: regions, each a rectangle and a transcription that share an id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regions(tasks: DataFrame) -> DataFrame:
    """(image, id, block_type, bbox, text, pos): the regions with a box and text of each task's first annotation.

    `tasks` has schema.TASK; `completions` stand where `annotations` is missing or empty. Percentages become the grid of 0 to 999, halves to even. The last result with a
    box gives box and type ("text" without a label), the last with text gives the text; pos is the first place.
    """
    names = tasks.columns
    several = F.col("annotations") if "annotations" in names else F.lit(None)
    if "completions" in names:
        several = F.when(F.size(several) > 0, several).otherwise(F.col("completions")) if "annotations" in names else F.col("completions")
    results = tasks.select("data.image", F.posexplode(F.try_element_at(several, F.lit(1))["result"]).alias("pos", "r"))
    v = lambda n: F.coalesce(F.col(f"r.value.{n}"), F.lit(0.0))
    boxed = F.col("r.value.rectanglelabels").isNotNull() | (F.col("r.value.x").isNotNull() & F.col("r.value.y").isNotNull() & F.col("r.value.width").isNotNull() & F.col("r.value.height").isNotNull())
    grid = lambda x: F.bround(x / 100 * 999).cast("int")
    box = F.array(grid(v("x")), grid(v("y")), grid(v("x") + v("width")), grid(v("y") + v("height")))
    kind = F.coalesce(F.try_element_at("r.value.rectanglelabels", F.lit(1)), F.lit("text"))
    if dict(results.select(F.col("r.value.text").alias("t")).dtypes)["t"] == "string":
        listed = F.from_json("r.value.text", "array<string>")
        text = F.when(F.col("r.value.text").startswith("[") & listed.isNotNull(), F.try_element_at(listed, F.lit(1))).otherwise(F.col("r.value.text"))
    else:
        text = F.try_element_at("r.value.text", F.lit(1))
    flat = results.select("image", "pos", F.col("r.id").alias("id"), boxed.alias("boxed"), box.alias("box"), kind.alias("kind"), F.col("r.value.text").isNotNull().alias("worded"), text.alias("text"))
    merged = flat.groupBy("image", "id").agg(
        F.max_by(F.when(F.col("boxed"), F.struct("box", "kind")), F.when(F.col("boxed"), F.col("pos"))).alias("b"),
        F.max_by(F.when(F.col("worded"), F.struct("text")), F.when(F.col("worded"), F.col("pos"))).alias("t"),
        F.min("pos").alias("pos"),
    )
    out = merged.select("image", "id", F.col("b.kind").alias("block_type"), F.col("b.box").alias("bbox"), F.col("t.text").alias("text"), "pos")
    return out.where("bbox is not null and text <> ''")


def as_leaves(found: DataFrame) -> DataFrame:
    """Regions as page leaves in reading order: by twentieths of height, then left edge, then place."""
    from sastra.operators.pages import reading_order

    named = found.select(F.regexp_extract("image", r"([^/]+?)(?:\.[^./]*)?$", 1).alias("page_id"), "pos", "block_type", "text", F.col("bbox").alias("bbox_norm"))
    return reading_order(named).select("page_id", F.col("place").alias("pos"), "block_type", "text", "bbox_norm")
