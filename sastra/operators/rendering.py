"""What surrounds a page renderer: the page model's leaves, augmentation plans, and a hook for the renderer.

Rendering, decoding and pixel work are the caller's; these give the tables that go in and take what comes out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sastra.functions import boxes as B
from sastra.functions.text import uniform
from sastra.operators.sampling import whole

#: A page's blocks: text blocks, lists, tables and forms, by `type`.
BLOCKS = "array<struct<type:string,text:string,items:array<string>,tid:int,header:array<string>,rows:array<array<string>>,fields:array<struct<label:string,value:string>>>>"


def expected_leaves(pages: DataFrame, page: str = "page_id", blocks: str = "blocks") -> DataFrame:
    """(page, pos, block_type, text, tbl, row_idx, col_idx): the leaves that a page's blocks give, in document order.

    A byline is a caption; a table's header is row 0 and its body starts at row 1; a form gives label and value by turns.
    """
    none = F.lit(None).cast("string")

    def leaf(kind: str | Column, text: Column, tbl: Column = none, row: Column = none, col: Column = none) -> Column:
        kind = F.lit(kind) if isinstance(kind, str) else kind
        return F.struct(kind.alias("block_type"), text.alias("text"), tbl.cast("string").alias("tbl"), row.cast("string").alias("row_idx"), col.cast("string").alias("col_idx"))

    def of(b: Column) -> Column:
        cells = lambda cs, r: F.transform(cs, lambda c, i: leaf("table_cell", c, b["tid"], r, i))
        nothing = F.array().cast("array<struct<block_type:string,text:string,tbl:string,row_idx:string,col_idx:string>>")
        header = F.coalesce(cells(b["header"], F.lit(0)), nothing)
        body = F.coalesce(F.flatten(F.transform(b["rows"], lambda cs, r: cells(cs, r + 1))), nothing)
        form = F.flatten(F.transform(b["fields"], lambda f: F.array(leaf("form_label", f["label"]), leaf("form_value", f["value"]))))
        return (
            F.when(b["type"].isin("title", "section_header", "text"), F.array(leaf(b["type"], b["text"])))
            .when(b["type"] == "byline", F.array(leaf("caption", b["text"])))
            .when(b["type"] == "list", F.transform(b["items"], lambda x: leaf("list_item", x)))
            .when(b["type"] == "table", F.concat(header, body))
            .when(b["type"] == "form", form)
        )

    leaves = F.flatten(F.filter(F.transform(blocks, of), lambda x: x.isNotNull()))
    return pages.select(page, F.posexplode(leaves).alias("pos", "l")).select(page, "pos", "l.*")


def source_texts(pages: DataFrame, page: str = "page_id", blocks: str = "blocks") -> DataFrame:
    """(page, source_text): the leaf texts of each page, each stripped, joined: the expected side of the round trip."""
    from sastra.functions.text import strip

    leaves = expected_leaves(pages, page, blocks).groupBy(page).agg(F.array_sort(F.collect_list(F.struct("pos", "text"))).alias("l"))
    return leaves.select(page, F.array_join(F.transform("l", lambda x: strip(F.coalesce(x["text"], F.lit("")))), "").alias("source_text"))


def augmentation_plan(pages: DataFrame, key: str = "page_id", seed: int = 42) -> DataFrame:
    """Which scan effects a page gets and how strong, each from its own draw of the page's key; null is none.

    rotate_deg, contrast, brightness, gamma, noise_var, blur_kernel, motion_kernel (only without blur), shadow, jpeg_quality.
    """
    # fixed values: the chances and ranges of the effects
    u = lambda k: uniform(seed + k, F.col(key))
    between = lambda k, low, high: low + u(k) * (high - low)
    any_ = u(0) <= 0.85
    effect = lambda k, chance, value: F.when(any_ & (u(k) < chance), value)
    blur = effect(9, 0.3, whole(1, 2, u(10)) * 2 + 1)
    return pages.select(
        key,
        effect(1, 0.5, between(2, -2.0, 2.0)).alias("rotate_deg"),
        effect(3, 0.5, 1 + between(4, -0.12, 0.12)).alias("contrast"),
        effect(3, 0.5, between(5, -0.12, 0.12) * 255).alias("brightness"),
        effect(6, 0.2, between(7, 0.8, 1.2)).alias("gamma"),
        effect(8, 0.4, between(11, 5.0, 25.0)).alias("noise_var"),
        blur.alias("blur_kernel"),
        F.when(blur.isNull(), effect(12, 0.1, whole(1, 3, u(13)) * 2 + 1)).alias("motion_kernel"),
        effect(14, 0.15, F.lit(True)).alias("shadow"),
        effect(15, 0.6, whole(55, 92, u(16))).alias("jpeg_quality"),
    )


def scaled_leaves(leaves: DataFrame, sizes: DataFrame, page: str = "page_id") -> DataFrame:
    """The leaves in pixels of the image: boxes and line boxes of the layout times (image_width / css_width, image_height / css_height)."""
    joined = leaves.join(sizes.select(page, (F.col("image_width") / F.col("css_width")).alias("__x"), (F.col("image_height") / F.col("css_height")).alias("__y")), page)
    x, y = F.col("__x"), F.col("__y")
    return joined.withColumn("bbox", B.scale("bbox", x, y)).withColumn("line_boxes", B.scale_all("line_boxes", x, y)).drop("__x", "__y")


def rotated_leaves(leaves: DataFrame, plan: DataFrame, sizes: DataFrame, page: str = "page_id") -> DataFrame:
    """The leaves with their boxes and line boxes turned as planned and clipped to the page, and grid boxes made anew."""
    joined = leaves.join(plan.select(page, "rotate_deg"), page, "left").join(sizes.select(page, "image_width", "image_height"), page)
    w, h, d = F.col("image_width"), F.col("image_height"), F.col("rotate_deg")
    turned = joined.withColumn("bbox", F.when(d.isNotNull(), B.rotate("bbox", d, w, h)).otherwise(F.col("bbox")))
    turned = turned.withColumn("line_boxes", F.when(d.isNotNull(), B.rotate_all("line_boxes", d, w, h)).otherwise(F.col("line_boxes")))
    return turned.withColumn("bbox_norm", B.to_grid("bbox", w, h)).drop("rotate_deg", "image_width", "image_height")


def labels_of(leaves: DataFrame, pages: DataFrame, images: DataFrame, folder: str = "data/synthetic/images", ending: str = "jpg") -> DataFrame:
    """One label per rendered page that has leaves: what a run of building a dataset writes.

    leaves: (page_id, pos, block_type, text, bbox, line_boxes, tbl, row_idx, col_idx) in pixels of the image;
    pages: (page_id, template, font, blocks); images: (page_id, image_width, image_height).
    """
    from sastra.functions.text import normalize
    from sastra.operators.pages import grounded_targets, markdown_pages

    sized = leaves.join(images.select("page_id", "image_width", "image_height"), "page_id")
    grid = sized.withColumn("bbox_norm", B.to_grid("bbox", F.col("image_width"), F.col("image_height"))).drop("image_width", "image_height")
    sources = source_texts(pages).select("page_id", normalize("source_text").alias("source_text"))
    rows = pages.select("page_id", "template", "font").join(images.select("page_id", "image_width", "image_height"), "page_id").join(grounded_targets(grid), "page_id").join(markdown_pages(grid), "page_id").join(sources, "page_id", "left")
    return rows.withColumn("image", F.concat(F.lit(folder + "/"), "page_id", F.lit("." + ending))).withColumn("source", F.lit("synthetic"))


def render_with(pages: DataFrame, start: Callable[[], Callable[[dict], dict | None]], schema: str) -> DataFrame:
    """Runs a renderer over pages: `start` once per task, then its result per page; None leaves the page out."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        render = start()
        for pdf in parts:
            made = [x for x in (render(row) for row in pdf.to_dict("records")) if x is not None]
            if made:
                yield pd.DataFrame(made)

    return pages.mapInPandas(run, schema)


def page_range(spark: SparkSession, n: int, workers: int) -> DataFrame:
    """(page) from 0 to n - 1 in as many contiguous parts as there are workers."""
    return spark.range(0, n, 1, max(1, workers)).withColumnRenamed("id", "page")


def font_addresses(families: DataFrame, base: str, family: str = "family") -> DataFrame:
    """(family, pos, address): where a family's file may lie, by licence folder and file name, in order of trial."""
    stem = F.replace(F.col(family), F.lit(" "), F.lit(""))
    # fixed values: the licence folders and the endings of file names
    endings = F.array(*[F.lit(x) for x in ("-Regular.ttf", "[wght].ttf", "[wdth,wght].ttf", ".ttf")])
    paths = F.flatten(F.transform(F.array(F.lit("ofl"), F.lit("apache")), lambda lic: F.transform(endings, lambda e: F.concat(F.lit(base.rstrip("/") + "/"), lic, F.lit("/"), F.lower(stem), F.lit("/"), stem, e))))
    return families.select(family, F.posexplode(paths).alias("pos", "address"))
