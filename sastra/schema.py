"""Schemas of the corpus and page-label records."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: One corpus text; `extra` is JSON, since its values have several types.
DOC = "text STRING, source STRING, license STRING, url STRING, lang_mix DOUBLE, n_chars BIGINT, non_commercial BOOLEAN, fetched_at STRING, extra STRING"

#: One source of the registry.
SOURCE = (
    "source STRING, source_type STRING, license STRING, enabled BOOLEAN, non_commercial BOOLEAN, hf_path STRING, hf_config STRING, hf_split STRING, "
    "text_field STRING, url STRING, parser STRING, seeds ARRAY<STRING>, rate_limit_seconds DOUBLE, max_pages_per_seed INT"
)

LEAF = "block_type STRING, text STRING, bbox ARRAY<DOUBLE>, lines ARRAY<ARRAY<DOUBLE>>, tbl STRING, row STRING, col STRING, bbox_norm ARRAY<INT>"

#: One page label, its leaves nested. Labels of real pages lack template, font and sizes.
LABEL = f"id STRING, image STRING, template STRING, font STRING, image_width INT, image_height INT, blocks ARRAY<STRUCT<{LEAF}>>, markdown STRING, grounded STRING, source_text STRING, source STRING"

MANIFEST = "image STRING, prompt STRING, answer STRING, source STRING, label STRING"

_RESULTS = "ARRAY<STRUCT<result ARRAY<STRUCT<id STRING, value STRUCT<x DOUBLE, y DOUBLE, width DOUBLE, height DOUBLE, rectanglelabels ARRAY<STRING>, text STRING>>>>>"

#: One exported annotation task. `completions` is another name of `annotations`; `text` is a string, or the JSON of a list of strings.
TASK = f"data STRUCT<image STRING>, annotations {_RESULTS}, completions {_RESULTS}"


def as_documents(rows: DataFrame, now: str | None = None) -> DataFrame:
    """Only the fields of a document; missing ones null, and null licence, flag and time of fetching at their defaults.

    `now`: the time of fetching where there is none (ISO, to the second); by default that of this call, in UTC.
    """
    now = now or datetime.now(timezone.utc).isoformat(timespec="seconds")
    names = [part.split()[0] for part in DOC.split(", ")]
    kinds = dict(part.split() for part in DOC.split(", "))
    columns = [F.col(n) if n in rows.columns else F.lit(None) for n in names]
    typed = rows.select(*[c.cast(kinds[n]).alias(n) for c, n in zip(columns, names)])
    return typed.fillna({"license": "unknown", "non_commercial": False, "fetched_at": now})
