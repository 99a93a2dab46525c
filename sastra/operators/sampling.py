"""Reproducible sampling: draws come from hashes of keys, so they do not depend on partitions or order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from sastra.functions.text import sentences, uniform
from sastra.plans.stage import stage


def cumulative(items: DataFrame, name: str, weight: str) -> DataFrame:
    """(name, low, high): each item's part of [0, 1) by weight, in name order; weights not above zero get none.

    For small tables of choices (fonts, templates): one window over all of them.
    """
    w = W.orderBy(name).rowsBetween(W.unboundedPreceding, 0)
    total = W.partitionBy(F.lit(1))
    rows = items.where(f"{weight} > 0").select(name, weight)
    return rows.select(name, ((F.sum(weight).over(w) - F.col(weight)) / F.sum(weight).over(total)).alias("low"), (F.sum(weight).over(w) / F.sum(weight).over(total)).alias("high"))


def weighted_choice(keys: DataFrame, key: str, items: DataFrame, name: str, weight: str, seed: int = 42) -> DataFrame:
    """(key, u, name): one item for each key, drawn by weight."""
    drawn = keys.select(key, uniform(seed, F.col(key)).alias("u"))
    # a small table of choices becomes a literal; rounding may leave the last end just under one
    parts = cumulative(items, name, weight).orderBy("high").collect()
    if not parts:
        raise ValueError("no item has a weight")
    ends = F.array(*[F.struct(F.lit(r.high).alias("high"), F.lit(r[name]).alias("v")) for r in parts])
    picked = F.coalesce(F.try_element_at(F.filter(ends, lambda e: e["high"] > F.col("u")), F.lit(1)), F.element_at(ends, -1))
    return drawn.select(key, "u", picked["v"].alias(name))


def pick(items: Column, u: Column) -> Column:
    """The item of an array at the place that u in [0, 1) points to; null for an empty array."""
    return F.try_element_at(items, F.when(F.size(items) > 0, F.floor(u * F.size(items)).cast("int") + 1).otherwise(1))


def whole(low: int, high: int, u: Column) -> Column:
    """A whole number from low to high, both included."""
    return (F.floor(u * (high - low + 1)) + low).cast("int")


def sample_sentences(docs: DataFrame, seed: int = 42, order: str = "doc_id") -> DataFrame:
    """(order, sentence): one sentence of each text, all alike likely; the text itself if it has none."""
    found = docs.where("text <> ''").select(order, sentences("text").alias("s"), "text")
    return found.select(order, F.coalesce(pick(F.col("s"), uniform(seed, F.col(order))), F.col("text")).alias("sentence"))


# The sentences that stand in where there is no corpus.
POOL = [
    "ប្រទេសកម្ពុជាមានទីតាំងស្ថិតនៅភូមិភាគអាស៊ីអាគ្នេយ៍។",
    "ភាសាខ្មែរគឺជាភាសាផ្លូវការរបស់ប្រទេសកម្ពុជា។",
    "ទីក្រុងភ្នំពេញគឺជារាជធានីនៃព្រះរាជាណាចក្រកម្ពុជា។",
    "ប្រាសាទអង្គរវត្តគឺជាសំណង់ប្រវត្តិសាស្ត្រដ៏ល្បីល្បាញ។",
    "ការអប់រំមានសារៈសំខាន់សម្រាប់ការអភិវឌ្ឍន៍ប្រទេសជាតិ។",
    "សេដ្ឋកិច្ចកម្ពុជាកំពុងមានកំណើនជារៀងរាល់ឆ្នាំ។",
    "បច្ចេកវិទ្យាព័ត៌មានបានផ្លាស់ប្ដូររបៀបរស់នៅរបស់មនុស្ស។",
    "ទេសចរណ៍គឺជាវិស័យសំខាន់មួយក្នុងការរកចំណូលរបស់ប្រទេស។",
]
# What stands in forms and bylines, and in brackets in mixed pages.
FORM_TITLES = ["ពាក្យសុំ", "ប័ណ្ណសម្គាល់ខ្លួន", "ទម្រង់ព័ត៌មាន"]
LABELS = ["ឈ្មោះ", "អាសយដ្ឋាន", "ថ្ងៃខែឆ្នាំកំណើត", "លេខទូរស័ព្ទ", "ភេទ", "សញ្ជាតិ", "មុខរបរ", "លេខអត្តសញ្ញាណប័ណ្ណ"]
VALUES = ["សុខ សំណាង", "ភ្នំពេញ", "០១/០១/២០០០", "០១២ ៣៤៥ ៦៧៨", "ប្រុស", "ខ្មែរ", "គ្រូបង្រៀន", "១២៣៤៥៦៧៨៩"]
BYLINE, PAPER_NAMES = "ដោយ អ្នកនិពន្ធ · ", ["ភ្នំពេញប៉ុស្តិ៍", "ព័ត៌មាន", "សារព័ត៌មាន"]
ENGLISH = ["GDP", "COVID-19", "AI", "USD", "2026"]
# The page layouts and their ranges.
TEMPLATES = {"article_single": 3.0, "article_multicol": 2.0, "doc_with_table": 2.0, "form_label_value": 1.5, "mixed_km_en": 1.5}
COLOURS = ["#101010", "#1a1a2e", "#222222"]
PAPERS = ["#fbf7ee", "#f4f4f4", "#fcfbf7"]
ALIGNMENTS = ["left", "justify"]


def sample_pages(n: int, spark, fonts: DataFrame, seed: int = 42, templates: dict[str, float] | None = None) -> DataFrame:
    """n page styles: template, font, margins, sizes, colours and counts of blocks, each from its own draw of the page number."""
    choices = spark.createDataFrame(sorted((templates or TEMPLATES).items()), "template string, weight double")
    pages = spark.range(n).withColumnRenamed("id", "page")
    usable = fonts.where("usable")
    styled = weighted_choice(pages, "page", choices, "template", "weight", seed).drop("u").join(weighted_choice(pages, "page", usable, "font", "weight", seed + 1).drop("u"), "page")
    u = lambda k: uniform(seed + k, F.col("page"))
    scale = 1.4 + u(3) * 0.8
    body = whole(16, 26, u(2))
    array = lambda xs: F.array(*[F.lit(x) for x in xs])
    white = u(5) < 0.6
    article = F.col("template").isin("article_single", "article_multicol", "mixed_km_en")
    return styled.select(
        "page",
        F.format_string("syn_%07d", "page").alias("page_id"),
        "template",
        "font",
        F.lit(1240).alias("width"),
        whole(60, 140, u(4)).alias("margin"),
        F.when(white, "#ffffff").otherwise(pick(array(PAPERS), u(6))).alias("page_bg"),
        body.alias("body_px"),
        F.floor(body * scale).cast("int").alias("title_px"),
        F.floor(body * (1 + (scale - 1) * 0.6)).cast("int").alias("header_px"),
        F.round(1.4 + u(7) * 0.6, 2).alias("line_height"),
        F.round(u(8) * 0.5, 2).alias("letter_spacing"),
        pick(array(COLOURS), u(9)).alias("color"),
        pick(array(ALIGNMENTS), u(10)).alias("align"),
        F.when(F.col("template") == "article_multicol", 2).otherwise(1).alias("columns"),
        F.when(article, whole(3, 9, u(11))).alias("paragraphs"),
        F.when(F.col("template") == "doc_with_table", whole(3, 8, u(12))).alias("table_rows"),
        F.when(F.col("template") == "doc_with_table", whole(2, 5, u(13))).alias("table_cols"),
        F.when(F.col("template") == "form_label_value", F.least(F.lit(8), whole(4, 10, u(14)))).alias("fields"),
    )


def page_texts(pages: DataFrame, pool: DataFrame, seed: int = 42) -> DataFrame:
    """(page, pos, sentence): sentences of the pool for each title and paragraph of sampled pages.

    pool: (k, sentence) with k from 0 without gaps; each place draws its k, so the join is on a key.
    """
    size = pool.count()
    places = pages.select("page", F.explode(F.sequence(F.lit(0), F.coalesce("paragraphs", F.lit(2)))).alias("pos"))
    drawn = places.withColumn("k", F.floor(uniform(seed, F.col("page"), F.col("pos")) * size).cast("bigint"))
    return drawn.join(pool, "k").select("page", "pos", "sentence")


def page_places(pages: DataFrame, seed: int = 42) -> DataFrame:
    """(page, template, place, kind, n, part, parts): the texts of each sampled page, in order, with their numbers of sentences.

    kind: title, byline, section_header, text, list_item, header (of a table), cell, form_title, field. `part` numbers
    the texts of a list, table row or form; `place` the blocks, table rows by hundreds.
    """
    u = lambda k, *more: uniform(seed + k, F.col("page"), *more)
    place = lambda p, kind, n, part=None: F.struct(F.lit(p).cast("int").alias("place") if not isinstance(p, Column) else p.cast("int").alias("place"), F.lit(kind).alias("kind"), (n if isinstance(n, Column) else F.lit(n)).cast("int").alias("n"), (F.lit(0) if part is None else part).cast("int").alias("part"))
    nothing = F.array().cast("array<struct<place:int,kind:string,n:int,part:int>>")
    count = lambda low, high, k, *more: whole(low, high, u(k, *more))
    # articles: blocks 10 and 11 are title and byline; paragraph i is block 20 + 2 i, its header the one before
    numbers = F.sequence(F.lit(0), F.coalesce("paragraphs", F.lit(1)) - 1)
    paragraph = lambda i: F.concat(
        F.when((i > 0) & (u(21, i) < 0.4), F.array(place(19 + 2 * i, "section_header", 1))).otherwise(nothing),
        F.array(place(20 + 2 * i, "text", count(2, 6, 22, i))),
    )
    items = F.transform(F.sequence(F.lit(0), count(3, 5, 24) - 1), lambda i: place(60, "list_item", 1, i))
    article = F.concat(F.array(place(10, "title", 1), place(11, "byline", 0)), F.flatten(F.transform(numbers, paragraph)), F.when(u(23) < 0.3, items).otherwise(nothing))
    # tables: row r of the body is block 200 + r, the header block 199
    columns = F.sequence(F.lit(0), F.coalesce("table_cols", F.lit(1)) - 1)
    header = F.when(u(27) < 0.9, F.transform(columns, lambda c: place(199, "header", 1, c))).otherwise(nothing)
    body = F.flatten(F.transform(F.sequence(F.lit(0), F.coalesce("table_rows", F.lit(1)) - 1), lambda r: F.transform(columns, lambda c: place(200 + r, "cell", 1, c))))
    table = F.concat(F.array(place(10, "title", 1), place(20, "text", count(2, 4, 25))), header, body, F.array(place(300, "text", count(2, 4, 26))))
    form = F.concat(F.array(place(10, "form_title", 0)), F.transform(F.sequence(F.lit(0), F.coalesce("fields", F.lit(1)) - 1), lambda i: place(20, "field", 0, i)))
    places = F.when(F.col("template") == "doc_with_table", table).when(F.col("template") == "form_label_value", form).otherwise(article)
    return pages.select("page", "template", F.explode(places).alias("p")).select("page", "template", "p.*")


def page_leaf_texts(pages: DataFrame, pool: DataFrame, seed: int = 42) -> DataFrame:
    """(page, place, part, kind, text): the texts of sampled pages, their sentences drawn from the pool.

    pool: (k, sentence) with k from 0 without gaps. Each sentence of each text draws its own k, so pages meet the
    pool by a join on a key. Header cells are cut at 12 characters and cells at 14, as the layouts have it.
    """
    size = pool.count()
    u = lambda k, *more: uniform(seed + k, F.col("page"), *more)
    array = lambda xs: F.array(*[F.lit(x) for x in xs])
    places = stage(page_places(pages, seed), "places")
    drawn = places.where("n > 0").select("page", "place", "part", F.explode(F.sequence(F.lit(1), "n")).alias("s"))
    keyed = drawn.withColumn("k", F.floor(uniform(seed + 30, *[F.col(c) for c in ("page", "place", "part", "s")]) * size).cast("bigint")) if size else drawn.withColumn("k", F.lit(-1).cast("bigint"))
    said = keyed.join(pool, "k").groupBy("page", "place", "part").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("s", "sentence"))), lambda x: x["sentence"]), "").alias("said"))
    rows = places.join(said, ["page", "place", "part"], "left")
    said = F.coalesce("said", F.lit(""))
    suffix = F.when((F.col("template") == "mixed_km_en") & (u(31, F.col("place")) < 0.6), F.concat(F.lit(" ("), pick(array(ENGLISH), u(32, F.col("place"))), F.lit(")"))).otherwise("")
    # a form's labels: all of them in an order of the page's own, the first as many as it has fields
    order = F.transform(F.array_sort(F.transform(F.sequence(F.lit(0), F.lit(len(LABELS) - 1)), lambda i: F.struct(u(33, i).alias("u"), i.alias("i")))), lambda x: x["i"])
    label = F.element_at(array(LABELS), F.element_at(order, F.col("part") + 1) + 1)
    value = pick(array(VALUES), u(34, F.col("part")))
    text = (
        F.when(F.col("kind") == "byline", F.concat(F.lit(BYLINE), pick(array(PAPER_NAMES), u(35))))
        .when(F.col("kind") == "text", F.concat(said, suffix))
        .when(F.col("kind") == "header", F.substring(said, 1, 12))
        .when(F.col("kind") == "cell", F.substring(said, 1, 14))
        .when(F.col("kind") == "form_title", pick(array(FORM_TITLES), u(36)))
        .when(F.col("kind") == "field", F.concat_ws("\t", label, value))
        .otherwise(said)
    )
    return rows.select("page", "place", "part", "kind", text.alias("text"))


def page_blocks(texts: DataFrame) -> DataFrame:
    """(page, blocks): the page model of each page, in the form of `rendering.BLOCKS`, from its texts."""
    none = lambda kind: F.lit(None).cast(kind)
    grouped = texts.withColumn("block", F.when(F.col("kind").isin("header", "cell"), 200).otherwise(F.col("place")))
    # the texts of one block: those of one page at most
    listed = grouped.groupBy("page", "block").agg(F.array_sort(F.collect_list(F.struct("place", "part", "kind", "text"))).alias("t"))
    kind = F.col("t")[0]["kind"]
    of = lambda k: F.filter("t", lambda x: x["kind"] == k)
    texts_of = lambda xs: F.transform(xs, lambda x: x["text"])
    rows = F.transform(F.array_distinct(F.transform(of("cell"), lambda x: x["place"])), lambda r: texts_of(F.filter("t", lambda x: x["place"] == r)))
    fields = F.transform("t", lambda x: F.struct(F.substring_index(x["text"], "\t", 1).alias("label"), F.substring_index(x["text"], "\t", -1).alias("value")))
    is_table = kind.isin("header", "cell")
    block = F.struct(
        F.when(is_table, "table").when(kind == "list_item", "list").when(kind == "field", "form").when(kind == "form_title", "title").otherwise(kind).alias("type"),
        F.when(~is_table & ~kind.isin("list_item", "field"), F.col("t")[0]["text"]).alias("text"),
        F.when(kind == "list_item", texts_of(F.col("t"))).otherwise(none("array<string>")).alias("items"),
        F.when(is_table, F.lit(0)).alias("tid"),
        F.when(is_table & (F.size(of("header")) > 0), texts_of(of("header"))).otherwise(none("array<string>")).alias("header"),
        F.when(is_table, rows).otherwise(none("array<array<string>>")).alias("rows"),
        F.when(kind == "field", fields).otherwise(none("array<struct<label:string,value:string>>")).alias("fields"),
    )
    ordered = listed.select("page", "block", block.alias("b")).groupBy("page").agg(F.array_sort(F.collect_list(F.struct("block", "b"))).alias("l"))
    return ordered.select("page", F.transform("l", lambda x: x["b"]).alias("blocks"))
