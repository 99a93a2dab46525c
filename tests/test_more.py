"""Operators of the later rounds: duplicates over batches, ingest, exports, page models, labels, command options."""

import json
import random

import numpy as np
import pyarrow as pa
import pytest

from sastra import cli, schema
from sastra.functions import grams
from sastra.functions import minhash as M
from sastra.operators import dedup, exports, fonts, pages, rendering, sampling
from sastra.sources import readers
from sastra.streaming import incremental


def shingles(text, k=5):
    t = text.replace("\n", " ")
    return {t} if 0 < len(t) <= k else {t[i : i + k] for i in range(len(t) - k + 1)}


def test_distinct_grams():
    texts = ["abcdefabcdef", "", None, "abc", "abcde", "a\nb c a b", "កខគ😀ឃង" * 3, "x" * 40]
    hashes, starts = grams.distinct_grams(pa.array(texts), 5)
    assert np.diff(starts).tolist() == [len(shingles(t or "")) for t in texts]
    assert (grams.distinct_grams(pa.array(["a\nb"]), 5)[0] == grams.distinct_grams(pa.array(["a b"]), 5)[0]).all()
    assert list(grams.row_ranges(pa.array(["x" * (3 << 20), "y", "z"]))) == [(0, 1), (1, 3)]


def test_minima_agree_as_often_as_sets_do():
    rng = random.Random(1)
    found, want = [], []
    for _ in range(150):
        a = "".join(rng.choice("abcdefgh ") for _ in range(300))
        b = "".join(c if rng.random() > 0.03 else rng.choice("abcdefgh ") for c in a)
        x = M.signatures(*grams.distinct_grams(pa.array([a, b]), 5))
        found.append((x[0] == x[1]).mean())
        want.append(len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b)))
    assert abs(np.mean(found) - np.mean(want)) < 0.02 and np.corrcoef(found, want)[0, 1] > 0.8


def kept_first(pairs):
    gone = set()
    for a, b in sorted(pairs):
        if a not in gone:
            gone.add(b)
    return gone


def test_greedy_equals_the_loop_either_way(spark):
    rng = random.Random(2)
    pairs = [tuple(sorted(rng.sample(range(60), 2))) for _ in range(50)] + [(100 + i, 101 + i) for i in range(30)]
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    for small in (1_000, 6, 0):  # in one task; by components; in rounds
        assert {r.id for r in dedup.greedy_drops(df, small).collect()} == kept_first(pairs)
    assert dedup.greedy_drops(df.limit(0)).count() == 0


def test_options_of_near_duplicates(spark):
    texts = ["the cat sat on the mat today", "the cat sat on the mat todaz", "something else entirely here", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.verdict for r in dedup.deduplicate(df, k=3, permutations=64).collect()}
    assert got == {0: "kept", 1: "near_dup", 2: "kept", 3: "empty", 4: "empty"}
    assert dedup.banding(0.8, 128) == (25, 5)
    with pytest.raises(ValueError):
        dedup.near_candidates(df.select(df.doc_id.alias("id"), "text"), bands=30, rows=5)


def test_exports_take_both_names_and_plain_strings(spark, tmp_path):
    def task(name, image, text):
        box = {"id": "r", "value": {"x": 10, "y": 20, "width": 30, "height": 40, "rectanglelabels": ["title"]}}
        return {"data": {"image": image}, name: [{"result": [box, {"id": "r", "value": {"text": text}}]}]}

    tasks = [task("annotations", "a", ["one", "two"]), task("completions", "b", "plain [1]"), {**task("completions", "c", "[not json"), "annotations": []}, {"data": {"image": "d"}}]
    (tmp_path / "export.json").write_text(json.dumps(tasks), encoding="utf-8")
    rows = exports.regions(readers.read_tasks(spark, str(tmp_path / "export.json"))).collect()
    assert sorted((r.image, r.text, r.block_type, tuple(r.bbox)) for r in rows) == [(i, t, "title", (100, 200, 400, 599)) for i, t in (("a", "one"), ("b", "plain [1]"), ("c", "[not json"))]


def test_ingest_and_dumps(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for name in ("b.PNG", "a.jpg", "c.pdf", "notes.txt"):
        (raw / name).write_bytes(b"x")
    files = readers.page_files(spark, str(raw))
    pdf = files.where("path like '%.pdf'")
    plan = readers.ingest_plan(files, pdf.selectExpr("path", "2 as pages"))
    got = [(r.page_id, r.path.rsplit("/", 1)[1], r.page, r.image) for r in plan.orderBy("page_id").collect()]
    assert got == [("real_0000", "a.jpg", 0, "data/real/images/real_0000.jpg"), ("real_0001", "b.PNG", 0, "data/real/images/real_0001.png"), ("real_0002", "c.pdf", 0, "data/real/images/real_0002.png"), ("real_0003", "c.pdf", 1, "data/real/images/real_0003.png")]
    assert readers.annotation_tasks(plan).count() == 4 and readers.ingest_plan(files.limit(0)).count() == 0
    wiki = tmp_path / "wiki.xml"
    wiki.write_text("<mediawiki><page><text x='y'>[[a|One]] {{t}}</text></page>\n<page><text>  </text></page><page><title>n</title></page><page><text>Two</text></page></mediawiki>", encoding="utf-8")
    docs = readers.dump_documents(spark, str(wiki), "mediawiki", "w", url="u")
    assert sorted((r.text, r.license, r.url, r.fetched_at is not None) for r in docs.collect()) == [("One", "CC BY-SA 4.0", "u", True), ("Two", "CC BY-SA 4.0", "u", True)]
    table = tmp_path / "sentences.txt"
    table.write_text("1\tone\n2\t \nbad\n3\ttwo\tmore\n", encoding="utf-8")
    assert sorted(r.text for r in readers.dump_documents(spark, str(table), "leipzig", "l").collect()) == ["one", "two\tmore"]
    assert readers.dump_documents(spark, str(table), "leipzig", "l", limit=1).count() == 1
    with pytest.raises(ValueError):
        readers.dump_documents(spark, str(table), "other", "l")


def test_pool_stands_in_and_entities(spark):
    empty = spark.createDataFrame([(1, ""), (2, None)], "doc_id bigint, text string")
    assert readers.best_stage(empty).count() == len(sampling.POOL)
    some = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")
    assert readers.best_stage(empty, some).first().text == "a"
    page = spark.createDataFrame([("<p>caf&eacute; &#x1780;&#6017; &hellip; &amp;lt; &unknown;</p>",), ("<p>plain</p>",), (None,)], "h string")
    assert [r[0] for r in page.select(readers.html_text(page.h)).collect()] == ["café កខ … &lt; &unknown;", "plain", None]
    docs = schema.as_documents(spark.createDataFrame([("t", "s", None), ("u", "s", "2020")], "text string, source string, fetched_at string"), "now")
    assert [r.fetched_at for r in docs.collect()] == ["now", "2020"]


def test_page_models_give_their_leaves(spark):
    manifest = spark.createDataFrame([("f", 1.0, True)], "font string, weight double, usable boolean")
    styles = sampling.sample_pages(60, spark, manifest)
    pool = spark.createDataFrame([(i, f"s{i}.") for i in range(9)], "k bigint, sentence string")
    texts = sampling.page_leaf_texts(styles, pool)
    blocks = sampling.page_blocks(texts)
    assert blocks.count() == 60
    leaves = rendering.expected_leaves(blocks, "page")
    made = {}
    for r in texts.collect():
        made.setdefault(r.page, []).append((r.place, r.part, r.text))
    want = {p: [x for _, _, t in sorted(rows) for x in t.split("\t")] for p, rows in made.items()}
    got = {}
    for r in leaves.orderBy("page", "pos").collect():
        got.setdefault(r.page, []).append(r.text)
    assert got == want
    assert sampling.page_leaf_texts(styles, pool.limit(0)).where("kind = 'text'").first().text in ("", *[f" ({x})" for x in sampling.ENGLISH])
    # a rendered page: the layout's boxes doubled, and its label
    placed = leaves.selectExpr("printf('p%d', page) as page_id", "pos", "block_type", "text", "array(10d, 10d + 20 * pos, 100d, 25d + 20 * pos) as bbox", "array(array(10d, 10d, 20d, 20d)) as line_boxes", "tbl", "row_idx", "col_idx")
    sizes = placed.select("page_id").distinct().selectExpr("page_id", "2000 as image_width", "8000 as image_height", "1000 as css_width", "4000 as css_height")
    scaled = rendering.scaled_leaves(placed, sizes)
    first = scaled.where("pos = 0").first()
    assert list(first.bbox) == [20.0, 20.0, 200.0, 50.0] and [list(b) for b in first.line_boxes] == [[20.0, 20.0, 40.0, 40.0]]
    models = blocks.join(styles.select("page", "template", "font"), "page").selectExpr("printf('p%d', page) as page_id", "template", "font", "blocks")
    labels = rendering.labels_of(scaled, models, sizes)
    assert labels.count() == 60 and pages.roundtrip(scaled, labels).where("not same").count() == 0


def test_fonts_sheet(spark):
    usable = spark.createDataFrame([("A", "easy", 0.987, "x"), ("B<", None, None, "y")], "font string, difficulty string, coverage double, family string")
    made = fonts.qa_pages(usable).collect()
    assert [r.blocks[0].text for r in made] == [fonts.QA_TITLE + "A", fonts.QA_TITLE + "B<"] and made[0].width == 900
    cards = spark.createDataFrame([("A", "easy", 0.987, bytearray(b"png"), "3"), ("B<", None, None, None, "failed")], "font string, difficulty string, coverage double, png binary, info string")
    sheet = fonts.contact_sheet(cards)
    assert "data:image/png;base64,cG5n" in sheet and "coverage 99%" in sheet and "B&lt;" in sheet and "difficulty ?, coverage n/a, failed" in sheet


def test_updates_hold_open_windows(spark, tmp_path):
    rows = [(1, "s", "ab", "2024-01-01 10:00:00"), (2, "s", None, "2024-01-01 23:00:00"), (3, "t", "abc", "2024-01-05 00:00:00")]
    for i, r in enumerate(rows):
        spark.createDataFrame([r], "doc_id bigint, source string, text string, at string").selectExpr("doc_id", "source", "text", "timestamp(at) as ingested_at").write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema("doc_id bigint, source string, text string, ingested_at timestamp").parquet(f"{tmp_path}/in")
        incremental.run_updates(incremental.arrivals_per_source(stream), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    got = sorted((str(r.window.start)[:10], r.source, r.docs, r.chars) for r in incremental.latest(spark, f"{tmp_path}/out", ["window", "source"]).collect())
    assert got == [("2024-01-01", "s", 2, 2), ("2024-01-05", "t", 1, 3)]


def test_zero_options_count(spark, tmp_path, capsys):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.jsonl").write_text("\n".join(json.dumps({"text": t, "source": "s"}) for t in ("short", "latin words only, and nothing else here")), encoding="utf-8")
    assert cli.main(["quality", "--input", str(src), "--output", str(tmp_path / "q"), "--rejected", str(tmp_path / "r"), "--min-chars", "0", "--min-khmer", "0"]) == 0
    kept = spark.read.schema(schema.DOC).json(str(tmp_path / "q"))
    assert kept.count() == 2 and kept.where("fetched_at is null").count() == 0
    assert cli.main(["quality", "--input", str(src), "--output", str(tmp_path / "q2"), "--rejected", str(tmp_path / "r2")]) == 0
    trail = [json.loads(r.extra) for r in spark.read.schema(schema.DOC).json(str(tmp_path / "r2")).collect()]
    assert {tuple(x["reject_reasons"]) for x in trail} == {("too_short", "low_khmer_conf"), ("low_khmer_conf",)}
