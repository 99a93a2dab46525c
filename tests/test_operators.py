"""Operators on small tables, with ties, nulls, empty tables and repeated rows."""

import random

from pyspark.sql import functions as F

from sastra.operators import cleaning, dedup, exports, fonts, manifests, packaging, pages, quality, sampling
from sastra.operators.components import connected_components
from sastra.sources import readers, writers
from sastra.streaming import incremental


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def greedy(n, edges):
    kept = []
    for j in range(n):
        if not any((i, j) in edges for i in kept):
            kept.append(j)
    return set(range(n)) - set(kept)


def test_greedy_drops_equal_sequential(spark):
    random.seed(4)
    for _ in range(3):
        n = 30
        edges = {(a, b) for a in range(n) for b in range(a + 1, n) if random.random() < 0.08}
        df = spark.createDataFrame(sorted(edges), "a bigint, b bigint")
        assert {r.id for r in dedup.greedy_drops(df).collect()} == greedy(n, edges)
    assert dedup.greedy_drops(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 6), (6, 5), (9, 9), (3, 1), (20, 21), (21, 22), (22, 23), (23, 24), (24, 25)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 5: 5, 6: 5, 20: 20, 21: 20, 22: 20, 23: 20, 24: 20, 25: 20}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_deduplicate(spark):
    random.seed(5)
    base = "".join(random.choice("abcdefgh") for _ in range(300))
    docs = [(1, base), (2, base), (3, base[:150] + "Z" + base[150:]), (4, ""), (5, None), (6, "something else entirely " * 3), (7, base[:150] + "Z" + base[150:])]
    got = dict(rows(dedup.deduplicate(spark.createDataFrame(docs, "doc_id bigint, text string")).select("doc_id", "verdict")))
    assert got == {1: "kept", 2: "exact_dup", 3: "near_dup", 4: "empty", 5: "empty", 6: "kept", 7: "exact_dup"}


def test_segments(spark):
    docs = [(1, "<p>" + "ក" * 30 + "</p>\n\nshort\n\n" + "english only words in here now"), (2, None), (3, " "), (4, "ខ" * 25)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = rows(cleaning.segments(df, ["doc_id"]).select("doc_id", "seg_no", "verdict"))
    assert got == [(1, 0, "kept"), (1, 1, "dropped_short"), (1, 2, "dropped_script"), (4, 0, "kept")]
    counts = cleaning.clean_counts(df).first()
    assert (counts.docs_in, counts.kept, counts.dropped_length) == (4, 2, 1)
    assert cleaning.clean_counts(df.limit(0)).first().kept == 0


def test_quality_routes_everything(spark):
    docs = [(1, "ក" * 40, 1.0, '{"a": 1}'), (2, None, None, None), (3, "!!!\n!!!\n!!!", 0.9, "not json"), (4, "ក" * 40, 0.2, "{}")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang_mix double, extra string")
    kept, rejected = quality.route(df)
    assert [r.doc_id for r in kept.collect()] == [1]
    got = {r.doc_id: (r.reasons, r.extra) for r in rejected.collect()}
    assert got[2][0] == ["too_short", "symbol_ratio", "low_khmer_conf"]
    assert got[3][0] == ["too_short", "symbol_ratio", "repetition"]
    assert "reject_reasons" in got[4][1]


def test_totals_and_card(spark):
    docs = [("a", "x", 0, "hello", True), ("a", None, None, "abc", None), (None, "x", 9, None, False)]
    df = spark.createDataFrame(docs, "source string, license string, n_chars bigint, text string, non_commercial boolean")
    got = {(r.kind, r["name"]): (r.docs, r.chars, r.nc_docs, r.est_tokens) for r in packaging.corpus_totals(df).collect()}
    assert got["all", "all"] == (3, 17, 1, 5) and got["source", "a"] == (2, 8, 1, 2) and got["license", "unknown"] == (1, 3, 0, 1)
    assert packaging.corpus_totals(df.limit(0)).count() == 0
    assert "| x | 2 | 14 |" in packaging.dataset_card(df)


def test_numbering(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1009).alias("k")).repartition(5)
    got = {r.k: r.n for r in packaging.number_rows(df, "k", "n").collect()}
    assert [got[k] for k in sorted(got)] == list(range(1, 1001))
    shards = packaging.assign_shards(df, "k", 300).groupBy("shard").count()
    assert rows(shards) == [("lm-00000", 300), ("lm-00001", 300), ("lm-00002", 300), ("lm-00003", 100)]
    assert packaging.number_rows(df.limit(0), "k", "n").count() == 0


LEAF = "page_id string, pos int, block_type string, text string, bbox array<double>, tbl string, row_idx string, col_idx string, bbox_norm array<int>"


def leaf(pos, kind, text, tbl=None, r=None, c=None, box=(1.0, 2.0, 30.0, 40.0), norm=(1, 2, 3, 4)):
    return ("p", pos, kind, text, list(box), tbl, r, c, list(norm) if norm else None)


def test_markdown(spark):
    leaves = [
        leaf(0, "Title", "T"), leaf(1, "table_cell", "a", "0", "0", "0"), leaf(2, "table_cell", "b", "0", "0", "1"), leaf(3, "table_cell", "c", "0", "1", "1"),
        leaf(4, "table_cell", "d", "1", "2", ""), leaf(5, "caption", "cap"), leaf(6, "form_label", None), leaf(6, "form_label", None),
    ]
    df = pages.clean_leaves(spark.createDataFrame(leaves, LEAF))
    assert pages.markdown_pages(df).first().markdown == "# T\n\n| a | b |\n| --- | --- |\n|  | c |\n\n| d |\n\n*cap*\n\n****"
    assert pages.grounded_targets(df).first().grounded.split("\n")[0] == "<|ref|># T<|/ref|><|det|>[[1, 2, 3, 4]]<|/det|>"


def test_box_issues_and_gate(spark):
    leaves = [leaf(0, "text", "x"), leaf(1, "text", "y", box=(5.0, 5.0, 5.0, 9.0)), leaf(2, "text", "z", box=(-1.0, 0.0, 5.0, 9.0), norm=(0, 0, 1000, 1)), leaf(3, "text", "w", norm=None)]
    labels = spark.createDataFrame([("p", "article_single", 100, 100)], "page_id string, template string, image_width int, image_height int")
    got = pages.leaf_issues(spark.createDataFrame(leaves, LEAF), labels).first()
    assert (got.blocks, got.out_of_bounds, got.no_area, got.off_grid, got.clean) == (4, 1, 1, 1, False)
    assert pages.gate(spark.createDataFrame([], "ok boolean"), "ok").first().gate is False


def test_regions(spark):
    value = "x double, y double, width double, height double, rectanglelabels array<string>, text array<string>"
    ddl = f"data struct<image:string>, annotations array<struct<result:array<struct<id:string,value:struct<{value.replace(' ', ':').replace(':array', ':array').replace(',:', ',')}>>>>>"
    box = ("r1", (10.0, 20.0, 30.0, 40.0, ["title"], None))
    words = ("r1", (None, None, None, None, None, ["hello"]))
    lone = ("r2", (1.0, 1.0, 1.0, 1.0, ["text"], None))
    df = spark.createDataFrame([(("a/b/page_7.png",), [([box, words, lone],)]), (("c.png",), []), (("d.png",), None)], ddl)
    found = exports.regions(df).collect()
    assert [(r.block_type, r.bbox, r.text) for r in found] == [("title", [100, 200, 400, 599], "hello")]
    assert exports.as_leaves(exports.regions(df)).first().page_id == "page_7"


def test_fonts(spark):
    full = list(fonts.REQUIRED)
    df = spark.createDataFrame([("a", full[:40]), ("a", full[40:]), ("b", full[:10]), ("c", [])], "font string, codepoints array<int>")
    assert rows(fonts.coverage(df)) == [("a", 70 - 1, 1.0, True), ("b", 10, round(10 / 69, 4), False), ("c", 0, 0.0, False)]


def test_split(spark):
    labels = [(f"p{i:03d}", f"img{i:03d}", "synthetic", "g") for i in range(40)] + [("r1", "x", "real", "g"), ("r2", "y", "real", ""), ("r3", "", "real", "g")]
    got = manifests.split_pages(spark.createDataFrame(labels, "page_id string, image string, source string, grounded string"))
    assert {r.split: r["count"] for r in got.groupBy("split").count().collect()} == {"val": 2, "train": 38, "test": 1}
    only = manifests.split_pages(spark.createDataFrame(labels[:1], "page_id string, image string, source string, grounded string"))
    assert [r.split for r in only.collect()] == ["val"]


def test_weighted_choice(spark):
    items = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", 0.0)], "name string, weight double")
    got = {r["name"]: r["count"] for r in sampling.weighted_choice(spark.range(8000), "id", items, "name", "weight").groupBy("name").count().collect()}
    assert set(got) == {"a", "b"} and abs(got["b"] / 8000 - 0.75) < 0.03


def test_sources(spark, tmp_path):
    df = spark.createDataFrame([("t1", "s", None), ("កខ\nគ", "s", "CC0")], "text string, source string, license string")
    writers.write_jsonl(df, str(tmp_path / "j"), 1)
    import os

    for name in os.listdir(tmp_path / "j"):
        if name.endswith(".json"):
            os.rename(tmp_path / "j" / name, tmp_path / "j" / (name + "l"))
    assert {r.text for r in readers.read_jsonl(spark, str(tmp_path / "j")).collect()} == {"t1", "កខ\nគ"}
    writers.write_lines(df, str(tmp_path / "t"))
    assert {r.value for r in spark.read.text(str(tmp_path / "t")).collect()} == {"t1", "កខ គ"}
    (tmp_path / "dump.xml").write_text("<mediawiki><page><text x='1'>a {{b}} [[c|d]] <ref>e</ref> &amp;</text></page><page><title>no text</title></page></mediawiki>")
    assert [r.x for r in readers.wiki_pages(spark, str(tmp_path / "dump.xml")).select(readers.strip_wiki("markup").alias("x")).collect()] == ["a  d e &amp;"]
    feeds = [("<rss><channel><item><link> u1 </link></item><item><link>u2</link><link>u3</link></item></channel></rss>",), ('<feed xmlns="http://www.w3.org/2005/Atom"><entry><link href="v1"/><link rel="self" href="v2"/></entry></feed>',), ("broken <",), (None,)]
    assert [r.link for r in readers.feed_links(spark.createDataFrame(feeds, "xml string")).collect()] == ["u1", "u2", "v1", "v2"]
    html = spark.createDataFrame([("<html><script>x<y</script><nav>n</nav><p>a&amp;b</p><footer>f</footer></html>",), ("<nav>n</nav>",)], "h string")
    assert [r.x for r in html.select(readers.html_text("h").alias("x")).collect()] == ["a&b", None]


def test_registry(spark, tmp_path):
    (tmp_path / "s.yaml").write_text("sources:\n- {name: a, type: hf, enabled: true, hf_path: x/y}\n- {name: b, type: dump, enabled: true, parser: mediawiki}\n- {name: c, type: scrape, enabled: false, seeds: [u, v]}\n")
    got = readers.enabled_sources(readers.registry(spark, str(tmp_path / "s.yaml")), only=["a", "b", "c"], smoke=True)
    assert rows(got) == [("a", "hf", "hf", 200), ("b", "dump", "mediawiki", 200)]


def test_stream(spark, tmp_path):
    import json

    folder = tmp_path / "raw"
    folder.mkdir()
    for i in range(3):
        (folder / f"s{i}.jsonl").write_text("\n".join(json.dumps({"text": t, "source": "x"}) for t in ("same", f"own {i}", "")) + "\n")
    stream = incremental.read_raw(spark, str(folder)).withColumn("ingested_at", F.to_timestamp(F.lit("2026-01-01")))
    incremental.run_to_table(incremental.first_arrivals(stream).select("text"), str(tmp_path / "out"), str(tmp_path / "check"))
    assert sorted(r.text for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["own 0", "own 1", "own 2", "same"]


def test_command_line(spark, tmp_path, capsys):
    import json

    from sastra.cli import main

    raw = tmp_path / "raw"
    raw.mkdir()
    text = "ភាសាខ្មែរ ជា ភាសា របស់ យើង ទាំងអស់ គ្នា នៅ ប្រទេស កម្ពុជា។"
    (raw / "a.jsonl").write_text("\n".join(json.dumps(r) for r in ({"text": text, "source": "s"}, {"text": text, "source": "t"}, {"text": "only english here, nothing else", "source": "s"})) + "\n")

    def stage(name, *more):
        assert main([name, *more]) == 0

    def renamed(folder):
        for f in list(folder.iterdir()):
            if f.suffix == ".json":
                f.rename(f.with_suffix(".jsonl"))
        return str(folder)

    stage("clean", "--input", str(raw), "--output", str(tmp_path / "clean"))
    stage("dedup", "--input", renamed(tmp_path / "clean"), "--output", str(tmp_path / "dedup"))
    stage("quality", "--input", renamed(tmp_path / "dedup"), "--output", str(tmp_path / "kept"), "--rejected", str(tmp_path / "rejected"))
    stage("package", "--input", renamed(tmp_path / "kept"), "--output", str(tmp_path / "lm"))
    assert "- documents: 1" in capsys.readouterr().out
    labels = tmp_path / "labels"
    labels.mkdir()
    block = {"block_type": "text", "text": "ក", "bbox": [0, 0, 10, 10], "bbox_norm": [0, 0, 99, 99]}
    (labels / "p.json").write_text(json.dumps({"id": "p", "image": "p.jpg", "template": "article_single", "font": "f", "image_width": 100, "image_height": 100, "blocks": [block], "grounded": "g", "source_text": "ក"}))
    assert main(["box-sanity", "--labels", str(labels)]) == 0 and main(["roundtrip", "--labels", str(labels)]) == 0
    stage("stats", "--labels", str(labels))
    stage("manifest", "--labels", str(labels), "--output", str(tmp_path / "m"))


def test_expected_leaves(spark):
    from sastra.operators import rendering

    def block(kind, text=None, items=None, tid=None, header=None, body=None, fields=None):
        return (kind, text, items, tid, header, body, fields)

    page = [block("title", " T "), block("byline", "by"), block("list", items=["a", "b"]), block("table", tid=0, header=["h"], body=[["1"], ["2"]]), block("form", fields=[("k", "v")]), block("other", "x")]
    df = spark.createDataFrame([("p", page), ("q", []), ("r", None)], f"page_id string, blocks {rendering.BLOCKS}")
    got = [(r.block_type, r.text, r.row_idx) for r in rendering.expected_leaves(df).orderBy("pos").collect()]
    assert got == [("title", " T ", None), ("caption", "by", None), ("list_item", "a", None), ("list_item", "b", None), ("table_cell", "h", "0"), ("table_cell", "1", "1"), ("table_cell", "2", "2"), ("form_label", "k", None), ("form_value", "v", None)]
    assert rendering.source_texts(df).first().source_text == "Tbyabh12kv"


def test_augmentation_and_hook(spark):
    from sastra.operators import rendering

    plan = rendering.augmentation_plan(rendering.page_range(spark, 4000, 3), "page")
    stats = plan.agg(F.count("rotate_deg").alias("r"), F.max(F.abs("rotate_deg")).alias("m"), F.count_if(F.col("blur_kernel").isNotNull() & F.col("motion_kernel").isNotNull()).alias("both"), F.collect_set("motion_kernel").alias("k")).first()
    assert abs(stats.r / 4000 - 0.425) < 0.04 and stats.m <= 2 and stats.both == 0 and set(stats.k) <= {3, 5, 7}
    made = rendering.render_with(rendering.page_range(spark, 10, 2), lambda: lambda row: {"page": row["page"], "w": 7} if row["page"] % 2 else None, "page bigint, w int")
    assert rows(made) == [(i, 7) for i in range(1, 10, 2)]
    families = spark.createDataFrame([("Noto Sans",)], "family string")
    assert rendering.font_addresses(families, "x/").first().address == "x/ofl/notosans/NotoSans-Regular.ttf"
