"""From pairs of class representatives to pairs of all members.

Members (id, rep, copies) meet in blocks of about `BLOCK`: a class that holds a third of all rows spreads
over as many tasks as it has pairs of blocks, and no class is cut short.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Members of a class that meet others within one task.
BLOCK = 1000


def blocks(n: str, block: int) -> Column:
    return F.ceil(F.col(n) / block).cast("int")


def each_block(n: str, block: int) -> Column:
    return F.explode(F.sequence(F.lit(0), blocks(n, block) - 1))


def own_block(n: str, block: int) -> Column:
    return F.pmod(F.xxhash64("id"), blocks(n, block)).cast("int")


def pairs_within(members: DataFrame, block: int = BLOCK) -> DataFrame:
    """(x, y), x < y: all pairs of different ids of one class."""
    several = members.where("copies > 1").withColumn("own", own_block("copies", block))
    x = several.select("rep", F.col("id").alias("x"), F.col("own").alias("i"), each_block("copies", block).alias("j"))
    y = several.select("rep", F.col("id").alias("y"), each_block("copies", block).alias("i"), F.col("own").alias("j"))
    return x.join(y, ["rep", "i", "j"]).where("x < y").select("x", "y")


def pairs_across(links: DataFrame, left: DataFrame, right: DataFrame, block: int = BLOCK) -> DataFrame:
    """(x, y), x < y: for each link (a, b) all members of class a of `left` with all of class b of `right`."""
    size = lambda m, key, n: m.where("id = rep").select(F.col("rep").alias(key), F.col("copies").alias(n)).distinct()
    sized = links.select("a", "b").join(size(left, "a", "na"), "a").join(size(right, "b", "nb"), "b")
    spread = sized.select("a", "b", "nb", each_block("na", block).alias("i")).select("a", "b", "i", each_block("nb", block).alias("j"))
    placed = lambda m, name, key, part: m.select(F.col("id").alias(name), F.col("rep").alias(key), own_block("copies", block).alias(part))
    met = spread.join(placed(left, "x", "a", "i"), ["a", "i"]).join(placed(right, "y", "b", "j"), ["b", "j"]).where("x <> y")
    return met.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
