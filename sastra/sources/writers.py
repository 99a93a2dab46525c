"""Sinks: shards of JSON lines and text, statistics, manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_jsonl(docs: DataFrame, path: str, max_lines: int = 50_000) -> None:
    """JSON lines, at most `max_lines` a file. A rerun replaces the folder, so no old shard stays."""
    docs.write.mode("overwrite").option("maxRecordsPerFile", max_lines).option("ignoreNullFields", False).json(path)


def write_lines(docs: DataFrame, path: str, max_lines: int = 50_000) -> None:
    """Plain text, one document a line."""
    docs.where("text is not null").select(F.translate("text", "\n", " ").alias("value")).write.mode("overwrite").option("maxRecordsPerFile", max_lines).text(path)


def write_manifests(rows: DataFrame, path: str) -> None:
    """JSON lines in one folder per split."""
    rows.write.mode("overwrite").partitionBy("split").json(path)


def write_stats(stats: DataFrame, path: str) -> None:
    stats.coalesce(1).write.mode("overwrite").json(path)
