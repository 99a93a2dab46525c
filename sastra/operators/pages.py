"""Page labels: reading order, Markdown and grounded targets, gates and statistics.

Pages come as one row per leaf: page_id, pos, block_type, text, bbox, tbl, row_idx, col_idx, bbox_norm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from sastra.functions import boxes as B
from sastra.functions import text as T

#: Templates whose blocks should run down the page.
SINGLE_COLUMN = ["article_single", "doc_with_table", "form_label_value", "mixed_km_en"]


def clean_leaves(blocks: DataFrame) -> DataFrame:
    """One row per leaf (page_id, pos), block types in lower case.

    Of repeated rows of a leaf the one with most filled columns stands, whole; of those, the greatest by column in order.
    """
    rest = [c for c in blocks.columns if c not in ("page_id", "pos")]
    lower = blocks.withColumn("block_type", F.lower("block_type"))
    filled = sum(F.when(F.col(c).isNotNull(), 1).otherwise(0) for c in rest)
    best = lower.groupBy("page_id", "pos").agg(F.max(F.struct(filled.alias("__filled"), *rest)).alias("__row"))
    return best.select("page_id", "pos", *[F.col("__row")[c].alias(c) for c in rest])


def renderable(bbox: str = "bbox", text: str = "text") -> Column:
    """At least a pixel wide and high, and with text that isn't blank."""
    b = F.col(bbox)
    return (b[2] - b[0] >= 1) & (b[3] - b[1] >= 1) & (T.strip(F.coalesce(F.col(text), F.lit(""))) != "")


def leaf_issues(blocks: DataFrame, labels: DataFrame) -> DataFrame:
    """Per page with sizes: counts of boxes out of bounds, without area, off the grid, and y-inversions; `clean`.

    Inversions count neighbours, table cells left out, whose centre lies above the one before by over a
    fiftieth of the page's height; a page may have a tenth of its blocks, or one.
    """
    sizes = labels.where("image_width is not null").select("page_id", "template", "image_width", "image_height").distinct()
    rows = blocks.join(sizes, "page_id")
    w, h = F.col("image_width"), F.col("image_height")
    middle = (F.col("bbox")[1] + F.col("bbox")[3]) / 2
    flow = F.coalesce(F.col("block_type") != "table_cell", F.lit(True))
    order = W.partitionBy("page_id", flow).orderBy("pos")
    rows = rows.withColumn("flow", flow).withColumn("middle", middle).withColumn("above", F.lag("middle").over(order))
    counts = rows.groupBy("page_id", "template").agg(
        F.count(F.lit(1)).alias("blocks"),
        F.count_if(B.out_of_bounds("bbox", w, h)).alias("out_of_bounds"),
        F.count_if(B.no_area("bbox")).alias("no_area"),
        F.count_if(B.off_grid("bbox_norm")).alias("off_grid"),
        F.count_if(F.col("flow") & (F.col("middle") < F.col("above") - F.lit(0.02) * h)).alias("inversions"),
        F.count_if("flow").alias("flowing"),
    )
    disorder = F.coalesce(F.col("template").isin(SINGLE_COLUMN), F.lit(False)) & (F.col("inversions") > F.greatest(F.lit(1.0), F.col("flowing") * 0.1))
    return counts.withColumn("disorder", disorder).withColumn("clean", (F.col("out_of_bounds") + F.col("no_area") + F.col("off_grid") == 0) & ~disorder)


def first_issues(blocks: DataFrame, labels: DataFrame, n: int = 5) -> DataFrame:
    """(page_id, n, issue): the first issues of each page's leaves, in order of the leaves, for looking at a failed gate."""
    sizes = labels.where("image_width is not null").select("page_id", "image_width", "image_height").distinct()
    pos = F.col("pos").cast("string")
    named = lambda bad, what: F.when(bad, F.concat(pos, F.lit(f": {what}")))
    issues = F.array(named(B.out_of_bounds("bbox", F.col("image_width"), F.col("image_height")), "out of bounds"), named(B.no_area("bbox"), "no area"), named(B.off_grid("bbox_norm"), "off the grid"))
    found = blocks.join(sizes, "page_id").select("page_id", "pos", F.posexplode(F.array_compact(issues)).alias("place", "issue"))
    return found.select("page_id", F.row_number().over(W.partitionBy("page_id").orderBy("pos", "place")).alias("n"), "issue").where(F.col("n") <= n)


def gate(rows: DataFrame, ok: str) -> DataFrame:
    """One row: total, pass, fail, rate in per cent, and whether the gate passes; no rows do not pass."""
    sums = rows.agg(F.count(F.lit(1)).alias("total"), F.coalesce(F.count_if(ok), F.lit(0)).alias("passed"))
    rate = F.round(F.coalesce(F.try_divide(F.col("passed") * 100, F.col("total")), F.lit(0.0)), 1)
    return sums.select("total", "passed", (F.col("total") - F.col("passed")).alias("failed"), rate.alias("rate"), ((F.col("total") > 0) & (F.col("total") == F.col("passed"))).alias("gate"))


def _in_order(value: Column) -> Column:
    """The values of a page's leaves by pos. A page's leaves fit in a row; pages do not grow with the corpus."""
    return F.transform(F.array_sort(F.collect_list(F.struct("pos", value.alias("v")))), lambda x: x["v"])


def grounded_targets(blocks: DataFrame) -> DataFrame:
    """(page_id, grounded): the leaves in tags with their grid boxes, one per line; leaves without box are left out."""
    rows = blocks.where("bbox_norm is not null")
    line = B.grounded_text("block_type", F.coalesce("text", F.lit("")), "bbox_norm")
    return rows.groupBy("page_id").agg(F.array_join(_in_order(line), "\n").alias("grounded"))


def table_runs(blocks: DataFrame) -> DataFrame:
    """The leaves with `run`: neighbouring cells of one table share a run, any other leaf has its own."""
    cell = F.coalesce(F.col("block_type") == "table_cell", F.lit(False))
    w = W.partitionBy("page_id").orderBy("pos")
    goes_on = cell & F.lag(cell).over(w) & F.lag("tbl").over(w).eqNullSafe(F.col("tbl"))
    starts = F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1)
    return blocks.withColumn("is_cell", cell).withColumn("__s", starts).withColumn("run", F.sum("__s").over(w)).drop("__s")


def markdown_pages(blocks: DataFrame) -> DataFrame:
    """(page_id, markdown): leaves as Markdown, runs of cells as tables, parted by blank lines.

    A table is as wide as its greatest column; missing cells are empty, the later of two cells in one place
    stands, and the rule follows row 0 if there is one. Row and column are 0 where missing or empty.
    """
    runs = table_runs(blocks)
    number = lambda c: F.coalesce(F.expr(f"try_cast(nullif({c}, '') as int)"), F.lit(0))
    cells = runs.where("is_cell").select("page_id", "run", "pos", number("row_idx").alias("r"), number("col_idx").alias("c"), F.coalesce("text", F.lit("")).alias("text"))
    placed = cells.groupBy("page_id", "run", "r", "c").agg(F.max_by("text", "pos").alias("text"), F.min("pos").alias("pos"))
    lines = placed.groupBy("page_id", "run", "r").agg(F.map_from_entries(F.collect_list(F.struct("c", "text"))).alias("m"), F.max("c").alias("c"))
    wide = lines.withColumn("wide", F.max("c").over(W.partitionBy("page_id", "run")))
    row = F.concat(F.lit("| "), F.array_join(F.transform(F.sequence(F.lit(0), F.col("wide")), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(""))), " | "), F.lit(" |"))
    rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), F.col("wide") + 1), " | "), F.lit(" |"))
    full = wide.withColumn("line", F.when(F.col("r") == 0, F.concat(row, F.lit("\n"), rule)).otherwise(row))
    tables = full.groupBy("page_id", "run").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "line"))), lambda x: x["line"]), "\n").alias("md"))
    others = runs.where("not is_cell").select("page_id", "run", B.markdown_text("block_type", F.coalesce("text", F.lit(""))).alias("md"))
    parts = tables.union(others)
    return parts.groupBy("page_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("run", "md"))), lambda x: x["md"]), "\n\n").alias("markdown"))


def decoded_texts(blocks: DataFrame) -> DataFrame:
    """(page_id, decoded): the normalised text of all leaves, joined."""
    joined = blocks.groupBy("page_id").agg(F.array_join(_in_order(F.coalesce(F.col("text"), F.lit(""))), "").alias("t"))
    return joined.select("page_id", T.normalize("t").alias("decoded"))


def roundtrip(blocks: DataFrame, labels: DataFrame) -> DataFrame:
    """(page_id, same): whether a page's leaves give back its source text, both normalised."""
    sources = labels.where("source_text is not null").select("page_id", "source_text").distinct()
    return sources.join(decoded_texts(blocks), "page_id", "left").select("page_id", (T.normalize("source_text") == F.coalesce("decoded", F.lit(""))).alias("same"))


def page_statistics(blocks: DataFrame) -> DataFrame:
    """One row: pages, and mean (one place), least and most characters and boxes of a page."""
    per = blocks.groupBy("page_id").agg(F.count(F.lit(1)).alias("boxes"), F.sum(F.length(F.coalesce("text", F.lit("")))).alias("chars"))
    return per.agg(F.count(F.lit(1)).alias("pages"), *[f(c).alias(f"{c}_{n}") for c in ("chars", "boxes") for n, f in (("mean", lambda x: F.round(F.avg(x), 1)), ("min", F.min), ("max", F.max))])


def reading_order(blocks: DataFrame) -> DataFrame:
    """The leaves with `place` from 1: by twentieths of grid height (halves to even), then left edge, then pos."""
    band = F.bround(F.col("bbox_norm")[1] / 20)
    return blocks.where("bbox_norm is not null").withColumn("place", F.row_number().over(W.partitionBy("page_id").orderBy(band, F.col("bbox_norm")[0], "pos")))


def histogram(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(F.col(column).alias("name")).agg(F.count(F.lit(1)).alias("n"))
