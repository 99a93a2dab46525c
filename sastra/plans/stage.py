"""Stage tables: results written once to the shared folder and read back, which cuts lineage.

The folder is the session's ``spark.checkpoint.dir``. Where that is unset, as in tests on one
machine, a temporary folder is made, for local masters only. Folders are removed when the driver ends.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="sastra-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session is gone; the folder's owner cleans up
        pass


def stage(df: DataFrame, name: str) -> DataFrame:
    """Writes `df` as a table in the shared folder and reads it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/sastra-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def spread(table: DataFrame) -> DataFrame:
    """A scanned table over all cores: shuffled once if its files give fewer partitions than there are cores.

    Only for tables read straight from files, since counting partitions would run any shuffle before them.
    Large tables have more splits than cores and pass as they are.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    splits = table._jdf.queryExecution().toRdd().getNumPartitions()
    return table.repartition(cores) if splits < cores else table
