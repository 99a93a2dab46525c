"""Sources: corpus files, dumps, feeds, web pages and label files as DataFrames.

Fetching over the network is left to the caller; these read what lies in folders or string columns.
"""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window as W

from sastra import schema
from sastra.functions.text import strip
from sastra.operators.packaging import number_rows
from sastra.operators.sampling import POOL


def read_jsonl(spark: SparkSession, path: str, ddl: str = schema.DOC, mode: str = "FAILFAST") -> DataFrame:
    """JSON lines of a file or folder; malformed lines fail unless `mode` says otherwise.

    `file` and `line` order the rows as the shards do: by file name, then by place.
    """
    rows = spark.read.schema(ddl).option("mode", mode).option("pathGlobFilter", "*.{json,jsonl}").json(path)
    return rows.select("*", F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("line"))


def registry(spark: SparkSession, path: str) -> DataFrame:
    """The source registry of a YAML file as a small table."""
    import yaml

    with open(path, encoding="utf-8") as f:
        entries = yaml.safe_load(f).get("sources", [])
    names = [part.split()[0] for part in schema.SOURCE.split(", ")]
    renamed = [{"source": e.get("name"), "source_type": e.get("type"), **{k: v for k, v in e.items() if k in names}} for e in entries]
    return spark.createDataFrame([tuple(e.get(n) for n in names) for e in renamed], schema.SOURCE)


def enabled_sources(sources: DataFrame, only: list[str] | None = None, limit: int | None = None, smoke: bool = False) -> DataFrame:
    """The sources to fetch, with the row limit of a run (200 in a smoke run) and the reader of each."""
    rows = sources.where("enabled")
    if only:
        rows = rows.where(F.col("source").isin(only))
    reader = F.when(F.col("source_type") == "dump", F.col("parser")).when(F.col("source_type").isin("hf", "scrape"), F.col("source_type"))
    return rows.select("source", "source_type", reader.alias("reader"), F.lit(200 if smoke else limit).cast("int").alias("row_limit"))


def dataset_rows(rows: DataFrame, source: str, license_: str, text_field: str = "text", non_commercial: bool = False, limit: int | None = None) -> DataFrame:
    """Rows of a published dataset as documents: blank texts left out, url from `url` or `meta.url`, up to `limit` rows."""
    has = set(rows.columns)
    meta = F.col("meta.url") if "meta" in has and "struct" in dict(rows.dtypes)["meta"] else F.lit(None).cast("string")
    url = F.coalesce(F.nullif(F.col("url"), F.lit("")), meta) if "url" in has else meta
    text = F.col(text_field)
    out = rows.where(text.isNotNull() & (strip(text) != "")).select(text.alias("text"), F.lit(source).alias("source"), F.lit(license_).alias("license"), url.alias("url"), F.lit(non_commercial).alias("non_commercial"))
    return out.limit(limit) if limit else out


def wiki_pages(spark: SparkSession, path: str) -> DataFrame:
    """(markup): the first text element of each page of a wiki dump, entities as stored; bz2 is read in place."""
    pages = spark.read.option("lineSep", "</page>").text(path)
    return pages.select(F.regexp_extract("value", r"(?s)<text[^>]*>(.*?)</text>", 1).alias("markup"), F.col("value").rlike(r"(?s)<text[^>]*>.*?</text>").alias("ok")).where("ok").drop("ok")


def strip_wiki(c: str | Column) -> Column:
    """Without templates (not nested ones), with links as their labels, without tags; stripped."""
    t = F.regexp_replace(c, r"(?s)\{\{.*?\}\}", "")
    t = F.regexp_replace(t, r"\[\[(?:[^\]|]*\|)?([^\]]*)\]\]", "$1")
    return strip(F.regexp_replace(t, "<[^>]+>", ""))


def sentence_table(lines: DataFrame, limit: int | None = None) -> DataFrame:
    """(text) of lines "number TAB sentence": the second part, stripped, if it isn't blank."""
    parts = F.split("value", "\t", 2)
    out = lines.where(F.size(parts) == 2).select(strip(parts[1]).alias("text")).where("text <> ''")
    return out.limit(limit) if limit else out


def feed_links(feeds: DataFrame, xml: str = "xml", per_feed: int = 200, keep: tuple[str, ...] = ()) -> DataFrame:
    """(keep..., pos, link): the first link of each item and all link addresses of each entry, in order, up to `per_feed`.

    Feeds that aren't well-formed give none.
    """
    safe = F.when(F.col(xml).rlike(r"(?s)^\s*(?:<\?xml[^>]*\?>\s*)?<([A-Za-z_][\w.:-]*)[\s>].*</\1\s*>\s*$"), F.col(xml))
    found = F.concat(F.xpath(safe, F.lit("//*[local-name()='item']/link[1]/text()")), F.xpath(safe, F.lit("//*[local-name()='entry']/*[local-name()='link']/@href")))
    links = feeds.select(*keep, F.posexplode(F.filter(F.transform(found, strip), lambda x: x != "")).alias("pos", "link"))
    return links.where(F.col("pos") < per_feed)


@F.pandas_udf(StringType())
def _unescaped(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else html.unescape(t))


def unescaped(c: Column) -> Column:
    """With all named and numbered entities as characters. Only texts with an ampersand reach Python; the others pass as nulls."""
    return F.coalesce(_unescaped(F.when(F.contains(c, F.lit("&")), c)), c)


def html_text(c: str | Column) -> Column:
    """The text of a page without scripts, styles, navigation, header and footer; null if nothing is left."""
    t = F.regexp_replace(c, r"(?is)<(script|style|nav|header|footer)\b[^>]*>.*?</\1\s*>", "")
    t = unescaped(F.regexp_replace(F.regexp_replace(t, r"(?s)<!--.*?-->", ""), r"(?s)<[^>]+>", "\n"))
    lines = F.filter(F.transform(F.split(t, "\n"), strip), lambda x: x != "")
    return F.nullif(F.array_join(lines, "\n"), F.lit(""))


def article_plan(links: DataFrame, feed: str = "feed", per_feed: str = "max_pages_per_seed") -> DataFrame:
    """The first links of each feed, by its own limit (200 where null)."""
    place = F.row_number().over(W.partitionBy(feed).orderBy("pos"))
    return links.withColumn("place", place).where(F.col("place") <= F.coalesce(F.col(per_feed), F.lit(200)))


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """Label files, one JSON object each."""
    return spark.read.schema(schema.LABEL).option("multiLine", True).option("pathGlobFilter", "*.json").json(path)


def label_leaves(labels: DataFrame) -> DataFrame:
    """One row per leaf of nested labels, in the columns that the page operators take."""
    leaves = labels.select(F.col("id").alias("page_id"), "font", F.posexplode("blocks").alias("pos", "b"))
    return leaves.select("page_id", "pos", "font", "b.block_type", "b.text", "b.bbox", F.col("b.lines").alias("line_boxes"), "b.tbl", F.col("b.row").alias("row_idx"), F.col("b.col").alias("col_idx"), "b.bbox_norm")


def read_tasks(spark: SparkSession, path: str) -> DataFrame:
    """An annotation export: an array of tasks."""
    return spark.read.schema(schema.TASK).option("multiLine", True).json(path)


#: The endings of page images.
IMAGES = ("png", "jpg", "jpeg", "webp", "bmp", "tif", "tiff")


def page_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path) of the files in a folder; contents are not read."""
    return spark.read.format("binaryFile").load(folder).select("path")


def ingest_plan(files: DataFrame, page_counts: DataFrame | None = None, folder: str = "data/real/images") -> DataFrame:
    """(page_id, path, page, image): where each page of the (path) files goes: images in name order as real_0000, real_0001, ...

    Files of other kinds are left out; a PDF gives as many pages as `page_counts` (path, pages) has for it, none
    without, since counting them needs a reader. Numbers come from counts per range of names, not from one task.
    """
    ending = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    known = files.select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), ending.alias("ending"))
    made = known.where(F.col("ending").isin(*IMAGES)).select("name", "path", F.lit(0).alias("page"), "ending")
    if page_counts is not None:
        pdfs = known.where("ending = 'pdf'").join(page_counts.where("pages > 0"), "path")
        made = made.union(pdfs.select("name", "path", F.explode(F.sequence(F.lit(0), F.col("pages").cast("int") - 1)), F.lit("png")))
    numbered = number_rows(made.withColumn("__o", F.struct("name", "path", "page")), "__o", "__n")
    page_id = F.format_string("real_%04d", F.col("__n") - 1)
    return numbered.select(page_id.alias("page_id"), "path", "page", F.concat(F.lit(folder + "/"), page_id, F.lit("."), "ending").alias("image"))


def annotation_tasks(plan: DataFrame) -> DataFrame:
    """(data): the tasks to import for annotating, one per image of an ingest plan."""
    return plan.select(F.struct(F.col("image").alias("image")).alias("data"))


def dump_documents(spark: SparkSession, path: str, parser: str, source: str, license_: str | None = None, url: str | None = None, limit: int | None = None) -> DataFrame:
    """A dump as documents, by its parser: pages of a wiki, or lines of a sentence table; up to `limit`.

    Blank texts give none. The licence is that of the parser's usual dumps where none is named.
    """
    # fixed values: the parsers and the licences of their dumps
    usual = {"mediawiki": "CC BY-SA 4.0", "leipzig": "CC BY 4.0"}
    if parser == "mediawiki":
        texts = wiki_pages(spark, path).select(strip_wiki("markup").alias("text")).where("text <> ''")
    elif parser == "leipzig":
        texts = sentence_table(spark.read.text(path))
    else:
        raise ValueError(f"unknown parser {parser!r}")
    docs = texts.withColumns({"source": F.lit(source), "license": F.lit(license_ or usual[parser]), "url": F.lit(url)})
    return schema.as_documents(docs.limit(limit) if limit else docs)


def best_stage(*stages: DataFrame) -> DataFrame:
    """The first stage with a text, in order of preference; where there is none, the built-in sentences."""
    for df in stages:
        if not df.where("text <> ''").isEmpty():
            return df
    return stages[0].sparkSession.createDataFrame([(i, t) for i, t in enumerate(POOL)], "doc_id bigint, text string")
