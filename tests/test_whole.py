"""Queries over whole tables, on rows that are hard for them."""

import datetime
import hashlib

import pytest

from sastra.plans import catalog
from tests.sqlcheck import differences


def answer(spark, folder, name, rows, ddl):
    """The query's rows over a table of documents of its own; they must also be the SQL's."""
    duckdb = pytest.importorskip("duckdb")
    spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{folder}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS FROM '{folder}/documents.parquet/*.parquet'")
    got = catalog.queries()[name](spark, str(folder))
    assert differences(con, catalog.oracle_sql()[name], got) == ({}, {})
    return sorted(tuple(r) for r in got.collect())


def test_sentence_table_takes_every_line(spark, tmp_path):
    rows = [(1, "one\n two\tx \r\n\n \nthree"), (2, "four"), (3, ""), (4, None), (5, "\n")]
    assert answer(spark, tmp_path, "sentence_table", rows, "doc_id bigint, text string") == [("four",), ("one",), ("three",), ("two\tx",)]


MARKED = [(1, "a < b & c\n&lt;p&gt; &amp;amp; &nbsp;x"), (2, "<p>t</p>\n\n {{u}} "), (3, "plain"), (4, None), (5, " ")]


def test_html_main_text_keeps_stored_tags_and_entities(spark, tmp_path):
    want = [(1, "a < b & c\n&lt;p&gt; &amp;amp; &nbsp;x"), (2, "<p>t</p>\n{{u}}"), (3, "plain"), (5, None)]
    assert answer(spark, tmp_path, "html_main_text", MARKED, "doc_id bigint, text string") == want


def test_feed_links_keeps_query_strings(spark, tmp_path):
    rows = [(1, "https://a.example/?x=1&y=2"), (2, "https://a.example/<b>&amp;"), (3, "https://a.example/"), (4, ""), (5, None)]
    assert answer(spark, tmp_path, "feed_links", rows, "doc_id bigint, url string") == [
        r for i, u in rows[:3] for r in ((i, 0, u), (i, 1, f"https://site.example/{i}"), (i, 2, f"https://site.example/{i}?a=1&b=2"))
    ]


def test_wiki_strip_meets_stored_markup(spark, tmp_path):
    rows = [(1, "a {{t|x\ny}} b"), (2, "[[c|d]] and [[e]] [f]"), (3, "<ref\nname=x>g</ref> 1 < 2"), (4, "{{open [[h"), (5, " plain "), (6, None)]
    want = [(1, "a  b"), (2, "d and e [f]"), (3, "g 1 < 2"), (4, "{{open [[h"), (5, "plain")]
    assert answer(spark, tmp_path, "wiki_strip", rows, "doc_id bigint, text string") == want


def test_stream_gives_repeated_texts_once(spark, tmp_path):
    texts = ["a", "b", "a", "a", "c", "c", "", None]
    rows = [(i, t, datetime.datetime(2024, 1, 1 + i)) for i, t in enumerate(texts)]
    want = sorted((hashlib.sha1(t.encode()).hexdigest(), 1) for t in "abc")
    assert answer(spark, tmp_path, "stream_first_arrivals", rows, "doc_id bigint, text string, ingested_at timestamp") == want
