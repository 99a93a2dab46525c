"""Problem 9: a mixture in which each source gives its target share of all tokens.

Sources overlap: one text may stand in several. Distinct texts are gathered by membership pattern (the set
of target sources that hold them); only the token totals per pattern go to the driver. There a min-cost
flow routes each pattern's tokens to the sources' quotas. The r-th use of a pattern's tokens is a layer
that costs r - 1, open to sources whose cap is r at least; so costs are convex, uses spread evenly, and
augmenting layer by layer is the successive-shortest-path method. With `strict` the total is the largest that
lets every source meet its share under its cap (or the one asked for, if that is less), found from min cuts.
Otherwise the total is the one asked for, or that of all target sources' texts: small sources are repeated up to
their caps, and a source that still can't fill its quota falls short, which the report of shares says.

Documents are then chosen on the cluster: a pattern's texts in seeded order form a line, each layer's flow
is cut into one segment per source, and a text goes to the segment that holds its middle. Places on the
line are two-level prefix sums (hash buckets, then within a bucket), so no pattern passes through one task.
Whole texts seldom end where a segment does; so each segment then takes the one free text, or gives back the
one of its own, that brings it closest to its quota.

The driver's table has at most `PATTERNS` patterns, those of most tokens; texts of rarer ones count for the
scarcest of their sources alone.

Cases: sources with no target, null sources, null and empty texts give nothing; targets with no documents
keep their row with zero tokens, and the other shares are scaled to fill the whole; repeated rows and equal
texts of one source are one record; shares of zero or null and caps under one get nothing.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from sastra.llm.tokens import token_counts
from sastra.plans.stage import stage

BUCKETS = 4096
#: Membership patterns that the flow tells apart.
PATTERNS = 5_000


class Flow:
    """Integer max-flow by level graphs (Dinic); arcs may be added between runs, keeping the flow."""

    def __init__(self, n: int):
        self.arcs: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.left: list[int] = []

    def add(self, a: int, b: int, capacity: int) -> int:
        self.arcs[a].append(len(self.to))
        self.arcs[b].append(len(self.to) + 1)
        self.to += [b, a]
        self.left += [capacity, 0]
        return len(self.to) - 2

    def levels(self, s: int) -> list[int]:
        level = [-1] * len(self.arcs)
        level[s] = 0
        queue = deque([s])
        while queue:
            a = queue.popleft()
            for e in self.arcs[a]:
                if self.left[e] > 0 and level[self.to[e]] < 0:
                    level[self.to[e]] = level[a] + 1
                    queue.append(self.to[e])
        return level

    def run(self, s: int, t: int) -> int:
        total = 0
        while True:
            level = self.levels(s)
            if level[t] < 0:
                return total
            at = [0] * len(self.arcs)
            path: list[int] = []
            a = s
            while True:
                if a == t:
                    push = min(self.left[e] for e in path)
                    for e in path:
                        self.left[e] -= push
                        self.left[e ^ 1] += push
                    total += push
                    path, a = [], s
                    continue
                while at[a] < len(self.arcs[a]):
                    e = self.arcs[a][at[a]]
                    if self.left[e] > 0 and level[self.to[e]] == level[a] + 1:
                        break
                    at[a] += 1
                if at[a] < len(self.arcs[a]):
                    path.append(e)
                    a = self.to[e]
                elif not path:
                    break
                else:
                    e = path.pop()
                    a = self.to[e ^ 1]
                    at[a] += 1


def route(patterns: dict[tuple[str, ...], int], shares: dict[str, float], caps: dict[str, int], total: int | None = None, strict: bool = True) -> tuple[int, dict[tuple[tuple[str, ...], int, str], int]]:
    """The total, and the tokens that each (pattern, use, source) carries."""
    have = {s for p in patterns for s in p}
    live = sorted(s for s in shares if s in have and shares[s] > 0 and caps[s] >= 1)
    if not live:
        return 0, {}
    whole = sum(shares[s] for s in live)
    share = {s: shares[s] / whole for s in live}
    keys = sorted(patterns)
    most = max(caps[s] for s in live)
    size = sum(t * max([caps[s] for s in p if s in share] or [0]) for p, t in patterns.items())
    if not strict:
        size = sum(patterns.values()) if total is None else total
    elif total is not None:
        size = min(size, total)
    while True:
        flow = Flow(2 + len(live) + len(keys) * most)
        node = {s: 2 + i for i, s in enumerate(live)}
        quota = {s: int(size * share[s]) for s in live}
        for s in live:
            flow.add(node[s], 1, quota[s])
        carried, arcs = 0, {}
        for r in range(1, most + 1):  # cheapest use first
            for i, p in enumerate(keys):
                to = [s for s in p if s in share and caps[s] >= r]
                if to and patterns[p]:
                    layer = 2 + len(live) + i * most + r - 1
                    flow.add(0, layer, patterns[p])
                    for s in to:
                        arcs[p, r, s] = flow.add(layer, node[s], patterns[p])
            carried += flow.run(0, 1)
        if not strict or carried >= sum(quota.values()):
            return size, {k: flow.left[e ^ 1] for k, e in arcs.items() if flow.left[e ^ 1] > 0}
        # The min cut: sources on the root's side are filled, the tokens of those beyond it bound the total.
        reach = flow.levels(0)
        beyond = [s for s in live if reach[node[s]] < 0]
        got = sum(flow.left[e ^ 1] for k, e in arcs.items() if k[2] in beyond)
        size = min(size - 1, int(got / sum(share[s] for s in beyond)))


def counted_records(docs: DataFrame, targets: DataFrame, file: str | None = None) -> DataFrame:
    """(cls, source, doc_id, n_tokens, pattern): each target source's distinct texts, with their token counts."""
    wanted = targets.where("target_share > 0 and max_repeats >= 1").select("source").distinct()
    # the table of targets has one row per source; AQE broadcasts it if it is small
    kept = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source", "text").where("length(text) > 0").join(wanted, "source", "left_semi")
    counted = token_counts(kept.withColumn("cls", F.unhex(F.md5("text"))).select("doc_id", "source", "cls", "text"), file, keep=["doc_id", "source", "cls"], exact=True)
    records = counted.groupBy("cls", "source").agg(F.min("doc_id").alias("doc_id"), F.min("n_tokens").alias("n_tokens"))
    pattern = F.array_sort(F.collect_set("source").over(W.partitionBy("cls")))
    return records.withColumn("pattern", F.concat_ws("\n", pattern))


def bounded_patterns(records: DataFrame, most: int = PATTERNS) -> DataFrame:
    """The records with patterns of which there are at most `most` and one for each source."""
    sums = stage(records.groupBy("cls", "pattern").agg(F.min("n_tokens").alias("n_tokens")).groupBy("pattern").agg(F.sum("n_tokens").alias("tokens")), "patterns")
    if sums.count() <= most:
        return records
    kept = stage(sums.orderBy(F.desc("tokens"), "pattern").limit(most).select("pattern", F.lit(True).alias("__kept")), "kept")
    # a row per source
    supply = records.groupBy("source").agg(F.sum("n_tokens").alias("__supply"))
    scarcest = records.join(supply, "source").groupBy("cls").agg(F.min_by("source", F.struct("__supply", "source")).alias("__scarcest"))
    joined = records.join(kept, "pattern", "left").join(scarcest, "cls")
    return stage(joined.withColumn("pattern", F.when(F.col("__kept"), F.col("pattern")).otherwise(F.col("__scarcest"))).drop("__kept", "__scarcest"), "bounded")


def mixture(docs: DataFrame, targets: DataFrame, total: int | None = None, seed: int = 17, file: str | None = None, strict: bool = True) -> DataFrame:
    """(doc_id, source, repeats, n_tokens): the chosen records, how often each is used for its source."""
    spark = docs.sparkSession
    records = bounded_patterns(stage(counted_records(docs, targets, file), "records"))
    texts = records.groupBy("cls", "pattern").agg(F.min("n_tokens").alias("n_tokens"))
    sums = texts.groupBy("pattern").agg(F.sum("n_tokens").alias("tokens"))
    # PATTERNS rows and one per target at most
    patterns = {tuple(r.pattern.split("\n")): int(r.tokens) for r in sums.toLocalIterator()}
    goal = {r.source: r for r in targets.where("target_share > 0 and max_repeats >= 1").dropDuplicates(["source"]).collect()}
    _, flows = route(patterns, {s: float(r.target_share) for s, r in goal.items()}, {s: int(r.max_repeats) for s, r in goal.items()}, total, strict)
    segments, ends = [], {}
    for (p, use, s), tokens in sorted(flows.items()):
        low = ends.get((p, use), 0)
        ends[p, use] = low + tokens
        segments.append(("\n".join(p), use, s, low, low + tokens))
    cuts = spark.createDataFrame(segments, "pattern string, use int, source string, low bigint, high bigint")
    bucket = F.pmod(F.col("h"), F.lit(BUCKETS))
    placed = texts.withColumn("h", F.xxhash64(F.lit(seed), "cls")).withColumn("bucket", bucket)
    before = placed.groupBy("pattern", "bucket").agg(F.sum("n_tokens").alias("t")).withColumn("before", F.sum("t").over(W.partitionBy("pattern").orderBy("bucket")) - F.col("t")).drop("t")
    inner = F.sum("n_tokens").over(W.partitionBy("pattern", "bucket").orderBy("h", "cls").rowsBetween(W.unboundedPreceding, 0))
    line = stage(placed.withColumn("end", inner).join(before, ["pattern", "bucket"]).select("cls", "pattern", "n_tokens", (F.col("before") + F.col("end") - F.col("n_tokens") / 2).alias("middle")), "line")
    hit = stage(line.join(cuts, "pattern").where((F.col("middle") >= F.col("low")) & (F.col("middle") < F.col("high"))).select("cls", "pattern", "use", "source", "n_tokens"), "hit")
    used = repaired(line, hit, cuts).groupBy("cls", "source").agg(F.count(F.lit(1)).cast("int").alias("repeats"))
    return used.join(records, ["cls", "source"]).select("doc_id", "source", "repeats", "n_tokens")


def repaired(line: DataFrame, hit: DataFrame, cuts: DataFrame) -> DataFrame:
    """(cls, use, source) of `hit`, each segment with one text more or less where that brings it closer to its quota.

    A free text that several segments of its layer want goes to the one it helps most, and each takes one at most.
    """
    segment = ["pattern", "use", "source"]
    sums = hit.groupBy(*segment).agg(F.sum("n_tokens").alias("got"))
    # a row per segment: PATTERNS times the uses and sources of each at most
    gaps = stage(cuts.join(sums, segment, "left").select(*segment, (F.col("high") - F.col("low") - F.coalesce("got", F.lit(0))).alias("gap")).where("gap <> 0"), "gaps")
    gain = F.abs("gap") - F.abs(F.abs("gap") - F.col("n_tokens"))
    over = hit.join(gaps.where("gap < 0"), segment).withColumn("gain", gain).where("gain > 0")
    drops = over.groupBy(*segment).agg(F.max(F.struct("gain", "cls")).alias("b")).select(*segment, F.col("b.cls").alias("cls"))
    layers = gaps.where("gap > 0").join(line.select("pattern", "cls", "n_tokens"), "pattern").withColumn("gain", gain).where("gain > 0")
    free = layers.join(hit.select("pattern", "use", "cls"), ["pattern", "use", "cls"], "left_anti")
    wanted = free.groupBy(*segment).agg(F.max(F.struct("gain", "cls")).alias("b")).select(*segment, "b.gain", F.col("b.cls").alias("cls"))
    adds = wanted.groupBy("pattern", "use", "cls").agg(F.max_by("source", F.struct("gain", "source")).alias("source"))
    kept = hit.join(drops, [*segment, "cls"], "left_anti")
    return kept.select("cls", "use", "source").union(adds.select("cls", "use", "source"))


def mixture_shares(docs: DataFrame, targets: DataFrame, total: int | None = None, seed: int = 17, file: str | None = None, strict: bool = True) -> DataFrame:
    """(source, target_share, actual_share, shortfall, tokens, docs, most_repeats) of every target.

    shortfall: the target share less the actual one, where that is positive.
    """
    chosen = mixture(docs, targets, total, seed, file, strict).groupBy("source").agg(F.sum(F.col("repeats") * F.col("n_tokens")).alias("tokens"), F.count(F.lit(1)).alias("docs"), F.max("repeats").alias("most_repeats"))
    joined = targets.dropDuplicates(["source"]).join(chosen, "source", "left").withColumn("tokens", F.coalesce("tokens", F.lit(0)))
    # one row per target, so one window over all of them
    share = F.col("tokens") / F.sum("tokens").over(W.partitionBy(F.lit(1)))
    rows = joined.withColumn("actual_share", share)
    short = F.greatest(F.lit(0.0), F.col("target_share") - F.coalesce("actual_share", F.lit(0.0)))
    return rows.select("source", "target_share", "actual_share", short.alias("shortfall"), "tokens", F.coalesce("docs", F.lit(0)).alias("docs"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"))
