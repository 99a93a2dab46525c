"""Problem 4: lines that a source repeats in many of its documents.

PrefixSpan over the line-identifier sequences of each source, as joins and counts:

1. A document is the sequence of its lines' identifiers (64-bit hashes of the lines' keys; lines without a letter
   have none), staged once. Only identifiers are shuffled; the texts of frequent lines are looked up at the end.
2. The patterns of length one are the identifiers with enough distinct documents.
3. A longer pattern is grown from its projected table (document, end of an occurrence) by a line that follows.
   The lines of an occurrence may be parted by any other lines where `max_gap` is None, and the earliest end of
   an occurrence then stands for a document; else by at most `max_gap` - 1 of them, and all ends are kept.
4. Deletion takes out of each text the occurrences of frequent sequences of adjacent lines, of `min_length` on.

Support counts a document once. All counts are partial sums before the shuffle and keyed by line, so a
source that holds a third of all rows spreads over its lines.

A source has at most (lines per document) / `min_share` frequent lines, so the list of a source is small
whatever its documents; it meets the documents by a join on the source.

Cases: null and empty texts count as documents of their source; documents of null source are in no source
and are left as they are; keys without a letter are no lines; a document that repeats a line counts once;
repeated rows count as rows; columns of the same names as helpers do not clash.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sastra.functions.text import once
from sastra.plans.stage import stage


def line_keys(text: Column) -> Column:
    """The keys of the text's lines, in order: blanks made even, trimmed, runs of digits as 0."""
    even = F.regexp_replace(F.regexp_replace(text, "[ \t\r\u00a0]+", " "), "[0-9\u17e0-\u17e9]+", "0")
    return F.transform(F.split(even, "\n"), lambda k: F.trim(k))


def line_ids(text: Column) -> Column:
    """The identifiers of the text's lines, in order; null for a line without a letter."""
    return F.transform(line_keys(text), lambda k: F.when(k.rlike(r"\p{L}"), F.xxhash64(k)))


class RepeatedLines:
    def __init__(self, docs: DataFrame, source_col: str = "source", text_col: str = "text", min_docs: int = 4, min_share: float = 0.1, max_gap: int | None = 1):
        self.docs, self.source_col, self.text_col, self.max_gap = docs, source_col, text_col, max_gap
        self.rows = docs.select(F.col(f"`{source_col}`").alias("source"), F.col(f"`{text_col}`").alias("text")).where("source is not null")
        #: (source, doc, ids): the sequences; doc numbers them.
        self.sequenced = stage(self.rows.select("source", F.monotonically_increasing_id().alias("doc"), line_ids(F.col("text")).alias("ids")), "sequences")
        need = F.greatest(F.lit(min_docs), F.ceil(F.count(F.lit(1)) * F.lit(min_share) - F.lit(1e-9)))
        #: (source, n_docs, need): the number of documents a line needs in its source.
        self.sources = self.sequenced.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), need.alias("need"))
        ids = self.sequenced.select("source", F.explode(F.array_distinct("ids")).alias("id")).where("id is not null")
        counts = ids.groupBy("source", "id").agg(F.count(F.lit(1)).alias("docs"))
        #: (source, id, docs, n_docs): the frequent patterns of length one.
        self.first = stage(counts.join(self.sources, "source").where("docs >= need").select("source", "id", "docs", "n_docs"), "frequent")

    def levels(self) -> Iterator[DataFrame]:
        """(source, ids, docs): the frequent sequences of length 1, of length 2, and so on while there are any."""
        yield self.first.select("source", F.array("id").alias("ids"), "docs")
        items = self.sequenced.select("source", "doc", F.posexplode("ids").alias("pos", "id"))
        kept = stage(items.join(self.first.select("source", "id"), ["source", "id"]), "kept")
        ends = lambda df: df.distinct() if self.max_gap is not None else df.groupBy("source", "doc", "ids").agg(F.min("end").alias("end"))
        projected = ends(kept.select("source", "doc", F.array("id").alias("ids"), F.col("pos").alias("end")))
        following = kept.select("doc", F.col("pos").alias("next"), "id")
        while True:
            near = F.col("next") > F.col("end")
            if self.max_gap is not None:
                near &= F.col("next") <= F.col("end") + self.max_gap
            grown = ends(projected.join(following, "doc").where(near).select("source", "doc", F.array_append("ids", F.col("id")).alias("ids"), F.col("next").alias("end")))
            counts = grown.select("source", "ids", "doc").distinct().groupBy("source", "ids").agg(F.count(F.lit(1)).alias("docs"))
            level = stage(counts.join(self.sources, "source").where("docs >= need").select("source", "ids", "docs"), "level")
            if level.isEmpty():
                return
            yield level
            projected = stage(grown.join(level.select("source", "ids"), ["source", "ids"], "left_semi").select("source", "doc", "ids", "end"), "projected")

    def names(self) -> DataFrame:
        """(source, id, line_key) of the frequent lines, looked up in the texts."""
        lines = self.rows.select("source", F.explode(F.array_distinct(line_keys(F.col("text")))).alias("line_key")).select("source", F.xxhash64("line_key").alias("id"), "line_key")
        return lines.join(self.first.select("source", "id"), ["source", "id"]).groupBy("source", "id").agg(F.min("line_key").alias("line_key"))

    def frequent_lines(self) -> DataFrame:
        """(source, line_key, docs, n_docs): the frequent sequences of length one."""
        return self.first.join(self.names(), ["source", "id"]).select("source", "line_key", "docs", "n_docs")

    def sequences(self) -> DataFrame:
        """(source, lines, docs): all frequent sequences of lines within `max_gap`, from length one on.

        Without a limit, m frequent lines that stand in one order in enough documents give 2^m - 1 sequences.
        """
        found = None
        for level in self.levels():
            found = level if found is None else found.union(level)
        # a source's few frequent lines, by identifier
        names = stage(self.names(), "names").groupBy("source").agg(F.map_from_entries(F.collect_list(F.struct("id", "line_key"))).alias("names"))
        return found.join(names, "source").select("source", F.transform("ids", lambda i: F.element_at("names", i)).alias("lines"), "docs")

    def cleaned(self, min_length: int = 1) -> DataFrame:
        """The documents without the occurrences of frequent sequences of `min_length` adjacent lines or more.

        Every part of a frequent sequence of adjacent lines is frequent, so the occurrences of those of just that
        length cover the occurrences of all longer ones.
        """
        near = RepeatedLines.__new__(RepeatedLines)
        near.__dict__ |= self.__dict__ | {"max_gap": 1}
        level = None
        for n, found in enumerate(near.levels(), 1):
            if n == min_length:
                level = found
                break
        if level is None:
            return self.docs
        bad = level.groupBy(F.col("source").alias("__source")).agg(F.collect_set("ids").alias("__bad"))
        joined = self.docs.join(bad, F.col(f"`{self.source_col}`") == F.col("__source"), "left")
        text = F.col(f"`{self.text_col}`")
        held = joined.withColumn("__ids", once(F.when(F.col("__bad").isNotNull(), line_ids(text))))
        runs = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("__ids") - (min_length - 1))), lambda p: F.array_contains(F.col("__bad"), F.slice("__ids", p, min_length)))
        # a line goes if one of the sequences that may hold it is frequent
        starts = held.withColumn("__runs", once(F.when(F.col("__ids").isNotNull(), runs)))
        gone = lambda i: F.exists(F.slice("__runs", F.greatest(F.lit(1), i + 2 - min_length), F.least(F.lit(min_length), i + 1)), lambda x: F.coalesce(x, F.lit(False)))
        left = F.filter(F.split(text, "\n"), lambda line, i: ~gone(i))
        clean = F.when(F.col("__bad").isNull() | text.isNull(), text).otherwise(F.array_join(left, "\n"))
        return starts.withColumn(self.text_col, clean).drop("__source", "__bad", "__ids", "__runs")
