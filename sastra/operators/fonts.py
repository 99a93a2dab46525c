"""Font coverage: which fonts hold the characters that a script needs."""

from __future__ import annotations

import base64
import html

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Consonants, dependent vowels, signs with the subscript sign, digits.
REQUIRED = [*range(0x1780, 0x17A3), *range(0x17B6, 0x17C6), *range(0x17C6, 0x17CD), 0x17D2, *range(0x17E0, 0x17EA)]


def coverage(fonts: DataFrame, required: list[int] | None = None, least: float = 0.95, by: str = "font", points: str = "codepoints") -> DataFrame:
    """(font, covered, coverage, usable) of (font, codepoints array<int>); faces of one font count together."""
    need = sorted(set(required or REQUIRED))
    hit = F.size(F.array_intersect(F.array_distinct(F.flatten(F.collect_list(points))), F.array(*[F.lit(p) for p in need])))
    counts = fonts.groupBy(by).agg(hit.alias("covered"))
    share = F.col("covered") / len(need)
    return counts.select(by, "covered", F.round(share, 4).alias("coverage"), (share >= least).alias("usable"))


def with_settings(found: DataFrame, settings: DataFrame) -> DataFrame:
    """Covered fonts with family, difficulty and weight of the settings, or their defaults."""
    joined = found.join(settings.select("font", "family", "difficulty", "weight"), "font", "left")
    return joined.withColumns({"family": F.coalesce("family", "font"), "difficulty": F.coalesce("difficulty", F.lit("unknown")), "weight": F.coalesce("weight", F.lit(1.0))})


# The texts of the page that shows a font: its title, clusters that are hard to shape, and digits.
QA_TITLE = "ការសាកល្បងពុម្ពអក្សរ "
QA_SAMPLE = "ស្ត្រីខ្មែរ សាស្ត្រាចារ្យ បណ្ឌិត កុម្ភៈ សន្តិភាព ភ្នំពេញ ប្រទេសកម្ពុជា អក្សរសាស្ត្រ វិទ្យាស្ថាន គ្រួសារ"
QA_DIGITS = "លេខ៖ ០១២៣៤៥៦៧៨៩"


def qa_pages(usable: DataFrame) -> DataFrame:
    """The fonts with the page model that shows each: one page, the same for all but for font and title."""
    block = lambda kind, text: F.struct(F.lit(kind).alias("type"), text.alias("text"))
    blocks = F.array(block("title", F.concat(F.lit(QA_TITLE), "font")), block("text", F.lit(QA_SAMPLE)), block("text", F.lit(QA_DIGITS)))
    # fixed values: the style of the page
    style = {"template": "article_single", "width": 900, "margin": 50, "body_px": 30, "title_px": 44, "header_px": 36, "line_height": 1.9, "letter_spacing": 0.0, "color": "#101010", "align": "left", "columns": 1}
    return usable.withColumns({**{k: F.lit(v) for k, v in style.items()}, "blocks": blocks})


def coverage_text(coverage: str = "coverage") -> Column:
    return F.when(F.col(coverage).isNull(), "n/a").otherwise(F.concat(F.round(F.col(coverage) * 100).cast("int").cast("string"), F.lit("%")))


def contact_sheet(cards: DataFrame) -> str:
    """An HTML page of the fonts' pictures: cards (font, difficulty, coverage, png, info); without a picture, `info` says why.

    For the few fonts of a manifest: all cards come to the driver.
    """
    text = lambda v: html.escape(str(v))
    out = ["<!doctype html><meta charset='utf-8'><title>Fonts</title><h1>Fonts</h1>"]
    for r in cards.orderBy("font").withColumn("covered", coverage_text()).collect():
        shown = f"<img src='data:image/png;base64,{base64.b64encode(r.png).decode()}'>" if r.png else "<p>no picture</p>"
        out.append(f"<section><h2>{text(r.font)}</h2><p>difficulty {text(r.difficulty or '?')}, coverage {r.covered}, {text(r['info'])}</p>{shown}</section>")
    return "\n".join(out)
