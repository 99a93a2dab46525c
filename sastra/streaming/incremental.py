"""Incremental corpus building with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sastra import schema
from sastra.functions import text as T
from sastra.operators.quality import reasons


def read_raw(spark: SparkSession, path: str, files_per_trigger: int = 16) -> DataFrame:
    """New shards of raw JSON lines as they arrive."""
    return spark.readStream.schema(schema.DOC).option("maxFilesPerTrigger", files_per_trigger).option("pathGlobFilter", "*.jsonl").json(path)


def first_arrivals(docs: DataFrame, ts: str = "ingested_at", late: str = "7 days") -> DataFrame:
    """The first of equal texts; the state of a text lasts for `late` of event time."""
    hashed = docs.where("text <> ''").withColumn("text_sha1", F.sha1("text")).withWatermark(ts, late)
    return hashed.dropDuplicatesWithinWatermark(["text_sha1"])


def cleaned(docs: DataFrame) -> DataFrame:
    """Cleaned texts with the rules they break."""
    return docs.withColumn("text", T.clean_text(F.coalesce("text", F.lit("")))).where("text <> ''").withColumn("reasons", reasons())


def arrivals_per_source(docs: DataFrame, ts: str = "ingested_at", window: str = "1 day", late: str = "3 days") -> DataFrame:
    """(window, source, docs, chars): tumbling counts, closed once the watermark passes."""
    return docs.withWatermark(ts, late).groupBy(F.window(ts, window), "source").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.length("text")).alias("chars"))


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Appends all that is there now as Parquet, exactly once per row, and stops."""
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()


def run_updates(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Runs a windowed aggregate over all that is there now; each batch leaves the groups it changed in a folder of its own.

    A batch that is run again replaces its folder. Open windows are there too, as they stand.
    """

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = stream.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).outputMode("update").trigger(availableNow=True).start()
    query.awaitTermination()


def latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Each group as its last batch left it."""
    rows = spark.read.parquet(path)
    rest = [c for c in rows.columns if c not in (*keys, "batch")]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("__last"))
    return last.select(*keys, "__last.*")
