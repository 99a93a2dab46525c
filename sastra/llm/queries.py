"""The queries of the training-data problems, by problem number."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sastra.plans.stage import spread


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _texts(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table of long texts, over all cores."""
    return spread(_t(spark, sf, name).select(*columns))


def _common_words(spark: SparkSession, sf: str) -> list[tuple[str, str]]:
    # a fixed table of 228 words, whatever the corpus
    return [(r.word, r.lang) for r in _t(spark, sf, "common_words").select("word", "lang").distinct().orderBy("word", "lang").collect()]


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    from sastra.llm.quality import judged

    return judged(_texts(spark, sf, "documents", "doc_id", "text"), _common_words(spark, sf)).where("is_junk").select(F.col("id").alias("doc_id"))


def p1_statistics(spark: SparkSession, sf: str) -> DataFrame:
    from sastra.llm.quality import flagged

    return flagged(_texts(spark, sf, "documents", "doc_id", "text"), _common_words(spark, sf))


def p1_counts(spark: SparkSession, sf: str) -> DataFrame:
    from sastra.llm.quality import document_statistics

    return document_statistics(_texts(spark, sf, "documents", "doc_id", "text"), _common_words(spark, sf)).select(F.col("id").alias("doc_id"), "n_chars", "n_words", "n_lines")


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    from sastra.llm.neardup import NearDuplicates

    return NearDuplicates(_texts(spark, sf, "documents", "doc_id", "text")).pairs().toDF("doc_id_a", "doc_id_b")


def p2_groups(spark: SparkSession, sf: str) -> DataFrame:
    from sastra.llm.neardup import NearDuplicates

    return NearDuplicates(_texts(spark, sf, "documents", "doc_id", "text")).groups().withColumnRenamed("id", "doc_id")


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    from sastra.llm.overlap import SplitOverlap

    return SplitOverlap(_texts(spark, sf, "manifest", "row_id", "split", "source", "answer")).pairs()


def p3_report(spark: SparkSession, sf: str) -> DataFrame:
    from sastra.llm.overlap import SplitOverlap

    return SplitOverlap(_texts(spark, sf, "manifest", "row_id", "split", "source", "answer")).report()


def p3_weighted(spark: SparkSession, sf: str) -> DataFrame:
    from sastra.llm.overlap import weighted_overlap

    return weighted_overlap(_texts(spark, sf, "manifest", "row_id", "split", "source", "answer"))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    from sastra.llm.lines import RepeatedLines

    return RepeatedLines(_texts(spark, sf, "documents", "source", "text")).frequent_lines().select("source", "line_key")


def p4_sequences(spark: SparkSession, sf: str) -> DataFrame:
    from sastra.llm.lines import RepeatedLines

    return RepeatedLines(_texts(spark, sf, "documents", "source", "text"), max_gap=None).sequences()


def p4_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    from sastra.llm.lines import RepeatedLines

    return RepeatedLines(_texts(spark, sf, "documents", "doc_id", "source", "text")).cleaned()


def p4_cleaned_blocks(spark: SparkSession, sf: str) -> DataFrame:
    from sastra.llm.lines import RepeatedLines

    return RepeatedLines(_texts(spark, sf, "documents", "doc_id", "source", "text")).cleaned(min_length=2)


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    from sastra.llm.sentences import fit, sentence_ends

    marked = _t(spark, sf, "sentence_docs").select("doc_id").distinct()
    model = fit(_texts(spark, sf, "documents", "text"))
    return sentence_ends(_t(spark, sf, "documents").join(marked, "doc_id", "left_semi"), model=model)


def p5_sentences(spark: SparkSession, sf: str) -> DataFrame:
    from sastra.llm.sentences import sentence_units

    return sentence_units(_texts(spark, sf, "documents", "doc_id", "text"))


def p6_doc_tokens(spark: SparkSession, sf: str) -> DataFrame:
    from sastra.llm.tokens import token_counts

    return token_counts(_texts(spark, sf, "documents", "doc_id", "source", "lang", "url", "license", "text"), keep=["doc_id", "source", "lang", "url", "license"])


def p6_budget(spark: SparkSession, sf: str) -> DataFrame:
    from sastra.llm.tokens import token_budget

    return token_budget(_texts(spark, sf, "documents", "source", "lang", "url", "license", "text"))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    from sastra.llm.lookalike import same_to_the_eye

    return same_to_the_eye(_texts(spark, sf, "documents", "doc_id", "text"))


def p7_forms(spark: SparkSession, sf: str) -> DataFrame:
    from sastra.llm.lookalike import one_form

    return one_form(_texts(spark, sf, "documents", "doc_id", "text")).select("id", "form").toDF("doc_id", "form")


def p8_ids(spark: SparkSession, sf: str) -> DataFrame:
    from sastra.llm.tokens import encode_corpus

    return encode_corpus(_texts(spark, sf, "documents", "doc_id", "text"))


def p9_mix(spark: SparkSession, sf: str) -> DataFrame:
    from sastra.llm.mixing import mixture

    return mixture(_texts(spark, sf, "documents", "doc_id", "source", "text"), _t(spark, sf, "mix_targets"))


def p9_shares(spark: SparkSession, sf: str) -> DataFrame:
    from sastra.llm.mixing import mixture_shares

    return mixture_shares(_texts(spark, sf, "documents", "doc_id", "source", "text"), _t(spark, sf, "mix_targets"))


def p9_mix_repeated(spark: SparkSession, sf: str) -> DataFrame:
    # as many tokens as the target sources hold: small ones are repeated, and fall short where their caps end
    from sastra.llm.mixing import mixture

    return mixture(_texts(spark, sf, "documents", "doc_id", "source", "text"), _t(spark, sf, "mix_targets"), strict=False)


def p9_shares_repeated(spark: SparkSession, sf: str) -> DataFrame:
    from sastra.llm.mixing import mixture_shares

    return mixture_shares(_texts(spark, sf, "documents", "doc_id", "source", "text"), _t(spark, sf, "mix_targets"), strict=False)


def _ranked_words(spark: SparkSession, sf: str) -> list[tuple[str, int]]:
    return [(r.word, r.freq_rank) for r in _t(spark, sf, "common_words").select("word", "freq_rank").orderBy("word", "freq_rank").collect()]


def p10_levels(spark: SparkSession, sf: str) -> DataFrame:
    from sastra.llm.reading import reading_levels

    return reading_levels(_texts(spark, sf, "documents", "doc_id", "text"), _t(spark, sf, "reading_grades"), _ranked_words(spark, sf))


def p10_held_out(spark: SparkSession, sf: str) -> DataFrame:
    from sastra.llm.reading import cross_validated

    return cross_validated(_texts(spark, sf, "documents", "doc_id", "text"), _t(spark, sf, "reading_grades"), _ranked_words(spark, sf))


def queries() -> dict:
    return {k: f for k, f in globals().items() if k[:1] == "p" and k[1:2].isdigit()}


def _alike_sql(texts: str, a: str, b: str, across: str) -> str:
    """Pairs of (id, side, t) at 5-gram Jaccard >= 0.8, by a join of all grams."""
    return f"""
        WITH f AS ({texts}),
        g AS (SELECT DISTINCT id, side, substr(t, i::BIGINT, 5) AS g FROM (SELECT id, side, t, unnest(range(1, length(t) - 3)) AS i FROM f WHERE length(t) >= 25)),
        n AS (SELECT id, count(*) AS n FROM g GROUP BY id),
        o AS (SELECT x.id AS a, y.id AS b, count(*) AS shared FROM g x JOIN g y ON x.g = y.g AND x.id < y.id{across} GROUP BY ALL)
        SELECT a AS {a}, b AS {b} FROM o JOIN n x ON x.id = a JOIN n y ON y.id = b WHERE shared >= 0.8::DOUBLE * (x.n + y.n - shared) - 1e-9
    """


_READING = r"""
    SELECT row_id AS id, split = 'train' AS side, trim(regexp_replace(regexp_replace(t, '[\x{200B}-\x{200D}\x{FEFF}]', '', 'g'), '[\t-\r\x1c-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g'), ' ') AS t
    FROM (SELECT row_id, split, CASE WHEN len(p) > 0 THEN array_to_string(p, ' ') ELSE answer END AS t FROM (SELECT *, regexp_extract_all(answer, '(?s)<\|ref\|>(.*?)<\|/ref\|>', 1) AS p FROM manifest WHERE answer IS NOT NULL AND split IS NOT NULL))
"""


_GRAMS = """g AS (SELECT DISTINCT id, side, substr(t, i::BIGINT, 5) AS g FROM (SELECT id, side, t, unnest(range(1, length(t) - 3)) AS i FROM f)), n AS (SELECT id, count(*) AS n FROM g GROUP BY id)"""

_GROUPS = f"""
    WITH RECURSIVE d AS (SELECT doc_id AS id, translate(text, chr(10), ' ') AS t FROM documents WHERE length(text) >= 25),
    c AS (SELECT t, min(id) AS id, count(*) AS copies FROM d GROUP BY t), f AS (SELECT id, true AS side, t FROM c), {_GRAMS},
    e AS (SELECT x.id AS a, y.id AS b, count(*) AS shared FROM g x JOIN g y ON x.g = y.g AND x.id <> y.id GROUP BY ALL),
    l AS (SELECT a, b FROM e JOIN n x ON x.id = a JOIN n y ON y.id = b WHERE shared >= 0.8::DOUBLE * (x.n + y.n - shared) - 1e-9),
    r(id, least) AS (SELECT id, id FROM c UNION SELECT l.b, r.least FROM r JOIN l ON l.a = r.id WHERE r.least < l.b)
    SELECT d.id AS doc_id, c.id AS class_id, m.least AS group_id, copies, coalesce(k.links, 0) AS links FROM d JOIN c ON d.t = c.t JOIN (SELECT id, min(least) AS least FROM r GROUP BY id) m ON m.id = c.id
    LEFT JOIN (SELECT a, count(*) AS links FROM l GROUP BY a) k ON k.a = c.id
"""

_REPORT = f"""
    WITH f AS (SELECT id, side, t FROM ({_READING}) WHERE length(t) >= 25), {_GRAMS},
    o AS (SELECT y.id AS b, x.id AS a, count(*) AS shared FROM g x JOIN g y ON x.g = y.g AND x.side AND NOT y.side GROUP BY ALL),
    m AS (SELECT b, max((shared = x.n AND shared = y.n)::INT) AS same FROM o JOIN n x ON x.id = a JOIN n y ON y.id = b WHERE shared >= 0.8::DOUBLE * (x.n + y.n - shared) - 1e-9 GROUP BY b)
    SELECT split, source, count(*) AS rows, count(m.b) AS overlapping, coalesce(sum(same), 0)::BIGINT AS exact FROM f JOIN manifest w ON w.row_id = f.id LEFT JOIN m ON m.b = f.id WHERE NOT side GROUP BY split, source
"""

#: Code points that show nothing or only change a letter, as the statistics leave them out.
_HIDDEN = r"[\p{Cf}\x{300}-\x{36F}]"
_COUNTS = rf"""
    SELECT doc_id, length(text)::BIGINT AS n_chars, len(regexp_extract_all(t, '[^\t-\r\x1c-\x20\x{{85}}\pZ]+'))::BIGINT AS n_words,
        len(list_filter(string_split_regex(t, '[\n\r\x{{2028}}]'), lambda x: regexp_matches(x, '[^\t-\r\x1c-\x20\x{{85}}\pZ]')))::BIGINT AS n_lines
    FROM (SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '{_HIDDEN}', '', 'g') AS t FROM documents)
"""


_KEY = r"regexp_replace(trim(regexp_replace({}, '[ \t\r\x{{A0}}]+', ' ', 'g'), ' '), '[0-9\x{{17E0}}-\x{{17E9}}]+', '0', 'g')"
_FREQUENT = rf"""
    WITH lines AS (SELECT DISTINCT doc_id, source, {_KEY.format('line')} AS line_key FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL)),
    sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
    counts AS (SELECT source, line_key, count(*) AS docs FROM lines WHERE regexp_matches(line_key, '\pL') GROUP BY source, line_key)
    SELECT counts.source, line_key FROM counts JOIN sizes ON counts.source = sizes.source WHERE docs >= 4 AND docs * 10 >= n
"""


#: Subsequences of each document's frequent lines, one more line at each step; a document counts once for each.
_SEQUENCES = rf"""
    WITH RECURSIVE frequent AS (SELECT * FROM ({_FREQUENT})),
    items AS (
        SELECT l.source, l.doc_id, l.pos, l.line_key FROM (
            SELECT doc_id, source, pos, {_KEY.format('line')} AS line_key
            FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents WHERE text IS NOT NULL)
        ) l JOIN frequent f ON l.source = f.source AND l.line_key = f.line_key
    ),
    grown(source, doc_id, lines, pos) AS (
        SELECT source, doc_id, [line_key], min(pos) FROM items GROUP BY source, doc_id, line_key
        UNION
        SELECT g.source, g.doc_id, list_append(g.lines, i.line_key), i.pos FROM grown g JOIN items i ON g.doc_id = i.doc_id AND i.pos > g.pos
    ),
    sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source)
    SELECT g.source, lines, count(DISTINCT doc_id) AS docs FROM grown g JOIN sizes s ON g.source = s.source GROUP BY g.source, lines, n HAVING count(DISTINCT doc_id) >= 4 AND count(DISTINCT doc_id) * 10 >= n
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_counts": _COUNTS,
        "p2_groups": _GROUPS,
        "p3_report": _REPORT,
        "p4_sequences": _SEQUENCES,
        "p2_found": _alike_sql("SELECT doc_id AS id, true AS side, translate(text, chr(10), ' ') AS t FROM documents", "doc_id_a", "doc_id_b", ""),
        "p3_found": _alike_sql(_READING, "row_id_a", "row_id_b", " AND x.side <> y.side"),
        "p4_found": _FREQUENT,
        "p4_cleaned": f"""
            WITH bad AS (SELECT source, list(line_key) AS bad FROM ({_FREQUENT}) GROUP BY source)
            SELECT doc_id, d.source, CASE WHEN bad IS NULL THEN text ELSE array_to_string(list_filter(string_split(text, chr(10)), lambda x: NOT list_contains(bad, {_KEY.format('x')})), chr(10)) END AS text
            FROM documents d LEFT JOIN bad ON d.source = bad.source
        """,
    }
