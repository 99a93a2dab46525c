"""Command line: the pipeline's stages over folders of JSON lines, and the label gates.

    python -m sastra.cli clean --input raw --output clean
    python -m sastra.cli dedup --input clean --output dedup [--threshold 0.8] [--ngram 5] [--num-perm 128]
    python -m sastra.cli quality --input dedup --output filtered --rejected rejected
    python -m sastra.cli package --input filtered --output lm [--permissive-only] [--max-docs N] [--smoke]
    python -m sastra.cli registry --config sources.yaml [--list] [--only a,b] [--limit N] [--smoke]
    python -m sastra.cli manifest --labels labels --output manifests [--val-frac 0.05]
    python -m sastra.cli fonts --input font-codepoints.jsonl [--min-coverage 0.95]
    python -m sastra.cli box-sanity --labels labels [--max-show 10]   exit code 1 if the gate fails
    python -m sastra.cli roundtrip --labels labels         exit code 1 if the gate fails
    python -m sastra.cli stats --labels labels
    python -m sastra.cli ingest --input raw_documents --output real
    python -m sastra.cli from-export --input export.json --output labels
    python -m sastra.cli dump --input dump.xml.bz2 --parser mediawiki --source wiki --output raw [--limit N]
    python -m sastra.cli sample --input lm/jsonl --fonts font_manifest.json --output pages [--pages 100]
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sastra import schema
from sastra.operators import cleaning, dedup, exports, fonts, manifests, packaging, pages, quality, sampling
from sastra.plans.stage import stage
from sastra.sources import readers, writers


def _docs(spark, path):
    rows = readers.read_jsonl(spark, path)
    return packaging.number_rows(rows.withColumn("__o", F.struct("file", "line")), "__o", "doc_id").drop("__o", "file", "line")


def given(value, default):
    """The value of an option, also where it is zero."""
    return default if value is None else value


def _labels(spark, path):
    labels = readers.read_labels(spark, path)
    return labels.withColumnRenamed("id", "page_id"), pages.clean_leaves(readers.label_leaves(labels))


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="sastra", description=__doc__.splitlines()[0])
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("clean", "dedup", "quality", "package", "registry", "manifest", "box-sanity", "roundtrip", "stats", "from-export", "fonts", "ingest", "dump", "sample"):
        s = sub.add_parser(name)
        s.add_argument("--input")
        s.add_argument("--output")
        s.add_argument("--labels")
        s.add_argument("--rejected")
        s.add_argument("--config")
        s.add_argument("--only")
        s.add_argument("--limit", type=int)
        s.add_argument("--smoke", action="store_true")
        s.add_argument("--permissive-only", action="store_true")
        s.add_argument("--max-docs", type=int, default=0)
        s.add_argument("--min-khmer", type=float)
        s.add_argument("--min-chars", type=int)
        s.add_argument("--max-chars", type=int, default=20_000)
        s.add_argument("--max-symbol-ratio", type=float, default=0.30)
        s.add_argument("--max-repetition", type=float, default=0.50)
        s.add_argument("--threshold", type=float, default=0.8)
        s.add_argument("--unverified", action="store_true", help="take every candidate for a near duplicate")
        s.add_argument("--val-frac", type=float, default=0.05)
        s.add_argument("--ngram", type=int, default=5)
        s.add_argument("--num-perm", type=int, default=128)
        s.add_argument("--list", action="store_true", help="the configured sources, enabled or not")
        s.add_argument("--min-coverage", type=float, default=0.95)
        s.add_argument("--max-show", type=int, default=10, help="pages whose first issues are shown")
        s.add_argument("--parser", choices=("mediawiki", "leipzig"))
        s.add_argument("--source")
        s.add_argument("--license")
        s.add_argument("--fonts")
        s.add_argument("--pages", type=int, default=100)
        s.add_argument("--seed", type=int, default=42)
    a = p.parse_args(args)
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    names = [part.split()[0] for part in schema.DOC.split(", ")]
    if a.command == "clean":
        carry = ["source", "license", "url", "non_commercial", "fetched_at", "extra"]
        docs = schema.as_documents(_docs(spark, a.input))
        kept = cleaning.kept_segments(docs, carry, min_script=given(a.min_khmer, 0.5), min_chars=given(a.min_chars, 20), max_chars=a.max_chars)
        writers.write_jsonl(kept.select(*names), a.output)
    elif a.command == "dedup":
        marked = dedup.deduplicate(_docs(spark, a.input), threshold=a.threshold, verify=not a.unverified, k=a.ngram, permutations=a.num_perm)
        marked = stage(marked, "marked")
        writers.write_jsonl(schema.as_documents(marked.where("verdict = 'kept'")), a.output)
        marked.groupBy("verdict").count().show()
    elif a.command == "quality":
        rules = {"min_chars": given(a.min_chars, 25), "max_symbol": a.max_symbol_ratio, "max_repetition": a.max_repetition, "min_script": given(a.min_khmer, 0.60)}
        # judged once for both outputs
        kept, rejected = quality.split(stage(quality.assess(readers.read_jsonl(spark, a.input), **rules), "judged"))
        writers.write_jsonl(schema.as_documents(kept), a.output)
        if a.rejected:
            writers.write_jsonl(schema.as_documents(rejected), a.rejected)
    elif a.command == "package":
        docs = _docs(spark, a.input)
        docs = packaging.permissive(docs) if a.permissive_only else docs
        docs = packaging.first_docs(docs, 500 if a.smoke else a.max_docs)
        writers.write_jsonl(schema.as_documents(docs), f"{a.output}/jsonl")
        writers.write_lines(docs, f"{a.output}/txt")
        writers.write_stats(packaging.corpus_totals(docs), f"{a.output}/stats")
        print(packaging.dataset_card(docs))
    elif a.command == "registry" and a.list:
        readers.registry(spark, a.config).select("source", "source_type", "license", "enabled").show(1000, False)
    elif a.command == "registry":
        readers.enabled_sources(readers.registry(spark, a.config), a.only.split(",") if a.only else None, a.limit, a.smoke).show(1000, False)
    elif a.command == "manifest":
        labels, _ = _labels(spark, a.labels)
        writers.write_manifests(manifests.manifest_rows(labels, a.val_frac), a.output)
    elif a.command in ("box-sanity", "roundtrip"):
        labels, leaves = _labels(spark, a.labels)
        result = pages.gate(pages.leaf_issues(leaves, labels), "clean") if a.command == "box-sanity" else pages.gate(pages.roundtrip(leaves, labels), "same")
        if a.command == "box-sanity" and a.max_show:
            shown = pages.first_issues(leaves, labels)
            first = shown.select("page_id").distinct().orderBy("page_id").limit(a.max_show)
            for r in shown.join(first, "page_id", "left_semi").orderBy("page_id", "n").collect():
                print(f"{r.page_id}: {r.issue}")
        row = result.first()
        print(f"{a.command}: {row.passed} of {row.total} ({row.rate} %)")
        return 0 if row.gate else 1
    elif a.command == "stats":
        labels, leaves = _labels(spark, a.labels)
        pages.page_statistics(leaves).show()
        for rows, column in ((labels, "font"), (labels, "template"), (leaves, "block_type")):
            pages.histogram(rows, column).orderBy(F.desc("n"), "name").show(100, False)
    elif a.command == "from-export":
        leaves = exports.as_leaves(exports.regions(readers.read_tasks(spark, a.input)))
        extra = leaves.withColumns({c: F.lit(None).cast("string") for c in ("tbl", "row_idx", "col_idx")})
        out = pages.grounded_targets(leaves).join(pages.markdown_pages(extra), "page_id").withColumn("source", F.lit("real"))
        out.write.mode("overwrite").json(a.output)
    elif a.command == "fonts":
        points = spark.read.schema("font string, codepoints array<int>").json(a.input)
        fonts.coverage(points, least=a.min_coverage).orderBy("font").show(1000, False)
    elif a.command == "ingest":
        plan = readers.ingest_plan(readers.page_files(spark, a.input))
        plan.write.mode("overwrite").json(f"{a.output}/plan")
        readers.annotation_tasks(plan).write.mode("overwrite").json(f"{a.output}/tasks")
    elif a.command == "dump":
        writers.write_jsonl(readers.dump_documents(spark, a.input, a.parser, a.source, a.license, limit=200 if a.smoke else a.limit), a.output)
    elif a.command == "sample":
        found = readers.best_stage(_docs(spark, a.input)) if a.input else readers.best_stage(spark.createDataFrame([], "doc_id bigint, text string"))
        numbered = packaging.number_rows(sampling.sample_sentences(found.select("doc_id", "text")).select("doc_id", "sentence"), "doc_id", "n")
        styles = sampling.sample_pages(a.pages, spark, spark.read.option("multiLine", True).json(a.fonts), a.seed)
        texts = sampling.page_leaf_texts(styles, numbered.select((F.col("n") - 1).alias("k"), "sentence"), a.seed)
        styles.join(sampling.page_blocks(texts), "page").write.mode("overwrite").json(a.output)
    return 0


if __name__ == "__main__":
    sys.exit(main())
