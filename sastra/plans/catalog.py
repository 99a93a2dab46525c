"""Named queries over the test tables, each with its SQL where SQL can express it.

All run over whole tables and whole texts. A limit appears only where it is the feature.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from sastra import schema
from sastra.functions import boxes as B
from sastra.functions import text as T
from sastra.functions.minhash import minhash
from sastra.operators import cleaning, dedup, exports, fonts, manifests, packaging, pages, quality, rendering, sampling
from sastra.plans.stage import shared_dir, spread
from sastra.sources import readers
from sastra.streaming import incremental

_QUERIES: dict[str, Callable] = {}
_SQL: dict[str, str] = {}


class Tables:
    """The tables of a folder by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def texts(self, *columns: str) -> DataFrame:
        """Columns of the documents for work that is heavy per text, over all cores."""
        return spread(self.documents.select(*columns))


def query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = lambda spark, folder: f(Tables(spark, folder))
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# SQL text of the expressions -------------------------------------------------------------------

_WS, _KH = T.BLANKS, T.KHMER
_NL = "chr(10)"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{_WS}]+|[{_WS}]+$', '', 'g')"


def _count(x: str, cls: str) -> str:
    return f"length(regexp_replace({x}, '[^{cls}]', '', 'g'))"


def _ratio(x: str) -> str:
    letters = _count(x, rf"\pL{_KH}")
    return f"CASE WHEN {letters} = 0 THEN 0.0::DOUBLE ELSE {_count(x, _KH)}::DOUBLE / {letters} END"


def _symbols(x: str) -> str:
    filled = f"length(regexp_replace({x}, '[{_WS}]', '', 'g'))"
    return f"CASE WHEN {filled} = 0 THEN 1.0::DOUBLE ELSE ({filled} - {_count(x, rf'\pL\pN{_KH}')})::DOUBLE / {filled} END"


def _reorder(x: str) -> str:
    def part(cls: str, of: str) -> str:
        return f"array_to_string(regexp_extract_all({of}, '{cls}'), '')"

    rest = f"regexp_replace(k[2:], '(?s){T.COENG}.', '', 'g')"
    fixed = (
        f"k[1:1] || {part(T.ROBAT, rest)} || {part(f'(?s){T.COENG}.', 'k[2:]')} || {part(f'[{T.SHIFTERS}]', rest)} || {part(f'[{T.VOWELS}]', rest)} || {part(f'[{T.ABOVE}]', rest)} || "
        + part(f"[{T.OTHER}{T.COENG}]", rest)
    )
    tokens = f"regexp_extract_all({x}, '(?s)[{T.BASE}](?:{T.COENG}.|[{T.MARKS}])*|[^{T.BASE}]+')"
    return f"array_to_string(list_transform({tokens}, lambda k: CASE WHEN regexp_matches(k, '(?s)^[{T.BASE}]..') THEN {fixed} ELSE k END), '')"


def _even(x: str) -> str:
    x = f"translate({x}, '\u00a0\u200b\u200c\u200d', ' ')"
    x = f"regexp_replace({x}, '[ \t]+', ' ', 'g')"
    x = f"regexp_replace({x}, ' *\n *', {_NL}, 'g')"
    return f"regexp_replace({x}, '\n{{3,}}', {_NL} || {_NL}, 'g')"


def _normalize(x: str) -> str:
    return _strip(_reorder(_even(f"nfc_normalize({x})")))


def _unmark(x: str) -> str:
    x = f"regexp_replace({x}, '<[^>]+>', ' ', 'g')"
    x = rf"regexp_replace({x}, '[\pL\pN_][\pL\pN_-]*[{_WS}]*:[{_WS}]*[^;{{}}]+;', ' ', 'g')"
    x = rf"regexp_replace({x}, '&(?:[a-zA-Z]+|#\p{{Nd}}+);', ' ', 'g')"
    return f"regexp_replace({x}, 'https?://[^{_WS}]+', ' ', 'g')"


def _u(seed: int, key: str) -> str:
    return f"(('0x' || substr(md5('{seed}:' || {key}), 1, 12))::BIGINT::DOUBLE / 281474976710656)"


def _whole(low: int, high: int, u: str) -> str:
    return f"(floor({u} * {high - low + 1}) + {low})::INT"


def _pick(items: list[str], u: str) -> str:
    return f"[{', '.join(repr(x) for x in items)}][(floor({u} * {len(items)}) + 1)::BIGINT]"


_CLEAN = f"SELECT doc_id, source, {_normalize(_unmark('text'))} AS clean FROM documents WHERE text <> ''"
_PARTS = f"list_filter(list_transform(string_split_regex(clean, '\n[{_WS}]*\n'), lambda x: {_strip('x')}), lambda x: x <> '')"
_SEGMENTS = f"""
    WITH c AS ({_CLEAN}),
    p AS (SELECT doc_id, source, CASE WHEN len({_PARTS}) > 0 THEN {_PARTS} ELSE [clean] END AS parts FROM c WHERE clean <> ''),
    s AS (SELECT doc_id, source, unnest(parts) AS text, unnest(range(len(parts)))::INT AS seg_no FROM p),
    m AS (SELECT *, length(text)::BIGINT AS n_chars, {_ratio('text')} AS ratio FROM s),
    v AS (SELECT *, CASE WHEN n_chars < 20 THEN 'dropped_short' WHEN n_chars > 20000 THEN 'dropped_long' WHEN ratio < 0.5 THEN 'dropped_script' ELSE 'kept' END AS verdict FROM m)
"""
_LINES = f"list_filter(string_split(t, {_NL}), lambda x: regexp_matches(x, '[^{_WS}]'))"
_REPEAT = f"""
    SELECT doc_id, CASE WHEN sum(n) < 2 THEN 0.0::DOUBLE ELSE max(n)::DOUBLE / sum(n) END AS repetition FROM (
        SELECT doc_id, line, count(*) AS n FROM (SELECT doc_id, unnest({_LINES}) AS line FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)) GROUP BY ALL
    ) GROUP BY doc_id
"""
_JUDGED = f"""
    WITH r AS ({_REPEAT}), j AS (
        SELECT d.doc_id, d.source, list_filter([
            CASE WHEN length(coalesce(text, '')) < 25 THEN 'too_short' END,
            CASE WHEN {_symbols("coalesce(text, '')")} > 0.30 THEN 'symbol_ratio' END,
            CASE WHEN coalesce(repetition, 0) > 0.50 THEN 'repetition' END,
            CASE WHEN coalesce(lang_mix, {_ratio("coalesce(text, '')")}) < 0.60 THEN 'low_khmer_conf' END], lambda x: x IS NOT NULL) AS reasons
        FROM documents d LEFT JOIN r ON d.doc_id = r.doc_id)
"""


# Text ------------------------------------------------------------------------------------------


@query(f"SELECT doc_id, {_normalize(_unmark('text'))} AS clean FROM documents WHERE text IS NOT NULL")
def clean_text(t):
    bare = t.texts("doc_id", "text").where("text is not null").select("doc_id", T.once(T.strip_markup("text")).alias("bare"))
    return bare.select("doc_id", T.normalize("bare").alias("clean"))


@query(f"SELECT doc_id, {_normalize('text')} AS normal FROM documents WHERE text IS NOT NULL")
def normalize_text(t):
    return t.texts("doc_id", "text").where("text is not null").select("doc_id", T.normalize("text").alias("normal"))


@query(f"SELECT doc_id, {_reorder('text')} AS reordered FROM documents WHERE text IS NOT NULL")
def khmer_reorder(t):
    return t.texts("doc_id", "text").where("text is not null").select("doc_id", T.reorder_clusters("text").alias("reordered"))


@query(f"SELECT doc_id, {_ratio('text')} AS ratio, regexp_matches(text, '[{_KH}]') AS has_script FROM documents WHERE text IS NOT NULL")
def script_ratio(t):
    return t.texts("doc_id", "text").where("text is not null").select("doc_id", T.script_ratio("text").alias("ratio"), T.contains_script("text").alias("has_script"))


@query(f"SELECT doc_id, {_symbols('text')} AS symbols FROM documents WHERE text IS NOT NULL")
def symbol_ratio(t):
    return t.texts("doc_id", "text").where("text is not null").select("doc_id", T.symbol_ratio("text").alias("symbols"))


@query(f"SELECT d.doc_id, coalesce(repetition, 0.0::DOUBLE) AS repetition FROM documents d LEFT JOIN ({_REPEAT}) r ON d.doc_id = r.doc_id")
def repetition_ratio(t):
    return t.texts("doc_id", "text").select("doc_id", T.repetition_ratio(F.coalesce("text", F.lit(""))).alias("repetition"))


@query(
    f"""SELECT doc_id, list_filter(list_transform(regexp_extract_all(text, '[^{T.TERMINATORS}\n]*[{T.TERMINATORS}]|[^{T.TERMINATORS}\n]+'), lambda x: {_strip('x')}), lambda x: x <> '') AS pieces
    FROM documents WHERE text IS NOT NULL"""
)
def sentences(t):
    return t.texts("doc_id", "text").where("text is not null").select("doc_id", T.sentences("text").alias("pieces"))


@query(
    f"""WITH c AS (SELECT doc_id, text AS clean FROM documents WHERE text <> '')
    SELECT doc_id, CASE WHEN len({_PARTS}) > 0 THEN {_PARTS} ELSE [clean] END AS parts FROM c"""
)
def paragraphs(t):
    return t.documents.where("text <> ''").select("doc_id", T.paragraphs("text").alias("parts"))


@query("SELECT doc_id, lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)) AS host FROM documents WHERE regexp_matches(url, '^https?://')")
def url_host(t):
    return t.documents.where("url rlike '^https?://'").select("doc_id", F.lower(T.url_host("url")).alias("host"))


@query(
    """SELECT doc_id, count(DISTINCT g)::INT AS shingles FROM (
        SELECT doc_id, CASE WHEN length(x) <= 5 THEN x ELSE substr(x, i::BIGINT, 5) END AS g
        FROM (SELECT doc_id, x, unnest(range(1, greatest(length(x) - 3, 2))) AS i FROM (SELECT doc_id, translate(text, chr(10), ' ') AS x FROM documents WHERE text <> ''))
    ) GROUP BY doc_id"""
)
def char_shingles(t):
    return t.texts("doc_id", "text").where("text <> ''").select("doc_id", F.size(T.char_shingles("text")).alias("shingles"))


# Cleaning --------------------------------------------------------------------------------------


@query(f"{_SEGMENTS} SELECT doc_id, source, seg_no, text, round(ratio, 3) AS lang_mix, n_chars FROM v WHERE verdict = 'kept'")
def clean_segments(t):
    return cleaning.kept_segments(t.texts("doc_id", "source", "text"), ["doc_id", "source"])


@query(
    f"""{_SEGMENTS} SELECT (SELECT count(*) FROM documents) AS docs_in, count(*) FILTER (verdict = 'kept') AS kept, count(*) FILTER (verdict = 'dropped_short') AS dropped_short,
    count(*) FILTER (verdict = 'dropped_long') AS dropped_long, count(*) FILTER (verdict = 'dropped_script') AS dropped_script,
    count(*) FILTER (verdict IN ('dropped_short', 'dropped_long')) AS dropped_length FROM v"""
)
def clean_stats(t):
    return cleaning.clean_counts(t.texts("text"))


# Duplicates ------------------------------------------------------------------------------------

_EXACT = "SELECT doc_id, text, CASE WHEN coalesce(text, '') = '' THEN 'empty' WHEN doc_id = min(doc_id) OVER (PARTITION BY sha1(text)) THEN 'first' ELSE 'exact_dup' END AS verdict FROM documents"


@query(f"SELECT doc_id, verdict FROM ({_EXACT})")
def dedup_exact(t):
    return dedup.mark_exact(t.documents.select("doc_id", "text")).select("doc_id", "verdict")


_PAIRS = f"""
    WITH f AS (SELECT doc_id, translate(text, chr(10), ' ') AS x FROM ({_EXACT}) WHERE verdict = 'first'),
    g AS (SELECT DISTINCT doc_id, CASE WHEN length(x) <= 5 THEN x ELSE substr(x, i::BIGINT, 5) END AS g FROM (SELECT doc_id, x, unnest(range(1, greatest(length(x) - 3, 2))) AS i FROM f)),
    n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
    o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL)
    SELECT a, b, shared::DOUBLE / (x.n + y.n - shared) AS jaccard FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE shared::DOUBLE / (x.n + y.n - shared) >= 0.8
"""


@query(_PAIRS)
def near_dup_pairs(t):
    first = dedup.mark_exact(t.texts("doc_id", "text")).where("verdict = 'first'").select(F.col("doc_id").alias("id"), "text")
    return dedup.near_pairs(first)


@query()
def lsh_candidates(t):
    texts = t.texts("doc_id", "text").where("text <> ''").select(F.col("doc_id").alias("id"), "text")
    return dedup.near_candidates(texts, bands=9, rows=13).select("a", "b")


@query()
def minhash_signature(t):
    texts = t.texts("doc_id", "text").where("text <> ''").select(F.col("doc_id").alias("id"), "text")
    return minhash(texts).select(F.col("id").alias("doc_id"), "signature")


#: Keep-first over the alike pairs: one step per text that is in a pair, in order, with the kept ones so far.
_GREEDY = f"""
    WITH RECURSIVE pairs AS ({_PAIRS}),
    nodes AS (SELECT id, row_number() OVER (ORDER BY id) AS r FROM (SELECT a AS id FROM pairs UNION SELECT b FROM pairs)),
    earlier AS (SELECT n.r, n.id, coalesce(list(p.a) FILTER (p.a IS NOT NULL), []::BIGINT[]) AS before FROM nodes n LEFT JOIN pairs p ON p.b = n.id GROUP BY ALL),
    walk(r, kept) AS (
        SELECT 0::BIGINT, []::BIGINT[]
        UNION ALL SELECT e.r, CASE WHEN list_has_any(w.kept, e.before) THEN w.kept ELSE list_append(w.kept, e.id) END FROM walk w JOIN earlier e ON e.r = w.r + 1
    ),
    kept AS (SELECT unnest(kept) AS id FROM (SELECT kept FROM walk ORDER BY r DESC LIMIT 1)),
    near AS (SELECT id FROM nodes WHERE id NOT IN (SELECT id FROM kept))
    SELECT doc_id, CASE WHEN verdict <> 'first' THEN verdict WHEN doc_id IN (SELECT id FROM near) THEN 'near_dup' ELSE 'kept' END AS verdict FROM ({_EXACT})
"""


@query(_GREEDY)
def dedup_near_greedy(t):
    return dedup.deduplicate(t.texts("doc_id", "text")).select("doc_id", "verdict")


@query(f"SELECT verdict, count(*) AS docs FROM ({_GREEDY}) GROUP BY verdict")
def dedup_stats(t):
    return dedup.deduplicate(t.texts("doc_id", "text")).groupBy("verdict").agg(F.count(F.lit(1)).alias("docs"))


# Quality ---------------------------------------------------------------------------------------


@query(f"{_JUDGED} SELECT doc_id, reasons FROM j")
def quality_reasons(t):
    return quality.assess(t.texts("doc_id", "text", "lang_mix")).select("doc_id", "reasons")


@query(f"{_JUDGED} SELECT source, count(*) FILTER (len(reasons) = 0) AS kept, count(*) FILTER (len(reasons) > 0) AS rejected FROM j GROUP BY source")
def quality_by_source(t):
    judged = quality.assess(t.texts("source", "text", "lang_mix"))
    return judged.groupBy("source").agg(F.count_if(F.size("reasons") == 0).alias("kept"), F.count_if(F.size("reasons") > 0).alias("rejected"))


@query(f"{_JUDGED} SELECT doc_id FROM j WHERE len(reasons) = 0")
def quality_kept(t):
    return quality.route(t.texts("doc_id", "text", "lang_mix", "extra"))[0].select("doc_id")


@query(
    f"""{_JUDGED} SELECT doc_id, reasons, to_json(reasons)::VARCHAR AS trail, CASE WHEN json_valid(extra) THEN extra->>'$.shard' END AS shard, CASE WHEN json_valid(extra) THEN extra->>'$.tries' END AS tries
    FROM j JOIN (SELECT doc_id AS id, extra FROM documents) ON id = doc_id WHERE len(reasons) > 0"""
)
def quality_rejected(t):
    rejected = quality.route(t.texts("doc_id", "text", "lang_mix", "extra"))[1]
    part = lambda name: F.get_json_object("extra", f"$.{name}").alias(name)
    return rejected.select("doc_id", "reasons", part("reject_reasons").alias("trail"), part("shard"), part("tries"))


@query(f"{_JUDGED} SELECT reason, count(*) AS docs FROM (SELECT unnest(reasons) AS reason FROM j) GROUP BY reason")
def quality_reason_counts(t):
    return quality.reason_counts(t.texts("text", "lang_mix"))


# Packaging -------------------------------------------------------------------------------------

_TOTALS = "count(*) AS docs, coalesce(sum(c), 0)::BIGINT AS chars, count(*) FILTER (nc) AS nc_docs, greatest(1, coalesce(sum(c), 0) // 3)::BIGINT AS est_tokens"
_CHARS = "(SELECT *, coalesce(nullif(n_chars, 0), length(text), 0) AS c, coalesce(non_commercial, false) AS nc FROM documents)"


@query(
    f"""SELECT 'source' AS kind, coalesce(source, 'unknown') AS name, {_TOTALS} FROM {_CHARS} GROUP BY 2
    UNION ALL SELECT 'license', coalesce(license, 'unknown') AS name, {_TOTALS} FROM {_CHARS} GROUP BY 2 UNION ALL SELECT 'all', 'all', {_TOTALS} FROM {_CHARS}"""
)
def corpus_totals(t):
    return packaging.corpus_totals(t.documents)


@query("SELECT doc_id, source FROM documents WHERE NOT coalesce(non_commercial, false) ORDER BY doc_id LIMIT 500")
def first_n_permissive(t):
    return packaging.first_docs(packaging.permissive(t.documents), 500).select("doc_id", "source")


@query("SELECT doc_id, 'lm-' || lpad(((row_number() OVER (ORDER BY doc_id) - 1) // 300)::VARCHAR, 5, '0') AS shard FROM documents")
def shard_assign(t):
    return packaging.assign_shards(t.documents.select("doc_id"), size=300)


@query("SELECT translate(text, chr(10), ' ') AS value FROM documents WHERE text IS NOT NULL")
def text_lines(t):
    return packaging.text_lines(t.documents)


@query("SELECT doc_id, coalesce(license, 'unknown') AS license, coalesce(non_commercial, false) AS non_commercial FROM documents")
def document_defaults(t):
    docs = t.documents
    return schema.as_documents(docs.withColumn("source", F.col("doc_id").cast("string"))).select(F.col("source").cast("bigint").alias("doc_id"), "license", "non_commercial")


# Registry and joins ----------------------------------------------------------------------------


@query("SELECT count(*) FILTER (enabled) AS enabled, count(*) AS total FROM source_registry")
def registry_summary(t):
    return t.source_registry.agg(F.count_if("enabled").alias("enabled"), F.count(F.lit(1)).alias("total"))


@query(
    """SELECT source, source_type, CASE WHEN source_type = 'dump' THEN parser WHEN source_type IN ('hf', 'scrape') THEN source_type END AS reader, 200 AS row_limit FROM source_registry WHERE enabled"""
)
def registry_dispatch(t):
    return readers.enabled_sources(t.source_registry, smoke=True)


@query("SELECT d.doc_id, d.source, s.source_type, coalesce(s.license, 'unknown') AS source_license FROM documents d LEFT JOIN source_registry s ON d.source = s.source")
def dim_left_join(t):
    dim = t.source_registry.select("source", "source_type", F.col("license").alias("l"))
    return t.documents.select("doc_id", "source").join(dim, "source", "left").select("doc_id", "source", "source_type", F.coalesce("l", F.lit("unknown")).alias("source_license"))


@query("SELECT source FROM source_registry WHERE source NOT IN (SELECT source FROM documents WHERE source IS NOT NULL)")
def sources_without_documents(t):
    return t.source_registry.select("source").join(t.documents.select("source").distinct(), "source", "left_anti")


@query("SELECT source, count(*) AS docs FROM documents SEMI JOIN (SELECT source FROM source_registry WHERE enabled) r USING (source) GROUP BY source")
def enabled_documents(t):
    return t.documents.join(t.source_registry.where("enabled"), "source", "left_semi").groupBy("source").agg(F.count(F.lit(1)).alias("docs"))


@query(
    """SELECT source, url, place FROM (SELECT source, url, row_number() OVER (PARTITION BY source ORDER BY doc_id)::INT AS place FROM documents WHERE url <> '') WHERE place <= 5"""
)
def topk_per_group(t):
    links = t.documents.where("url <> ''").select("source", "url", F.col("doc_id").alias("pos"), F.lit(5).alias("k"))
    return readers.article_plan(links, "source", "k").select("source", "url", "place")


@query("SELECT event_type, count(*) AS n, sum((props::JSON->>'$.k')::BIGINT)::BIGINT AS k FROM events GROUP BY event_type")
def event_json(t):
    return t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.get_json_object("props", "$.k").cast("bigint")).alias("k"))


@query("SELECT user_id, count(*) FILTER (value < before) AS drops FROM (SELECT user_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events) GROUP BY user_id")
def lag_inversions(t):
    before = F.lag("value").over(W.partitionBy("user_id").orderBy("ts", "event_id"))
    return t.events.withColumn("before", before).groupBy("user_id").agg(F.count_if(F.col("value") < F.col("before")).alias("drops"))


# Pages -----------------------------------------------------------------------------------------

_REST = ["font", "block_type", "text", "bbox", "line_boxes", "tbl", "row_idx", "col_idx", "bbox_norm"]
_LEAVES = f"""(SELECT DISTINCT ON (page_id, pos) page_id, pos, font, block_type, text, bbox, line_boxes, tbl, row_idx, col_idx, bbox_norm FROM (SELECT * REPLACE (lower(block_type) AS block_type) FROM page_blocks)
    ORDER BY page_id, pos, {' + '.join(f'({c} IS NOT NULL)::INT' for c in _REST)} DESC, {', '.join(f'{c} DESC NULLS LAST' for c in _REST)})"""
_SIZES = "(SELECT DISTINCT page_id, template, image_width, image_height FROM page_labels WHERE image_width IS NOT NULL)"
_MD = """CASE block_type WHEN 'title' THEN '# ' || coalesce(text, '') WHEN 'section_header' THEN '## ' || coalesce(text, '') WHEN 'list_item' THEN '- ' || coalesce(text, '')
    WHEN 'caption' THEN '*' || coalesce(text, '') || '*' WHEN 'form_label' THEN '**' || coalesce(text, '') || '**' ELSE coalesce(text, '') END"""


def _leaves(t):
    return pages.clean_leaves(t.page_blocks.select("page_id", "pos", *_REST))


def _grid(v: str, n: str) -> str:
    return f"greatest(0, least(999, round_even({v} / {n} * 999, 0)))::INT"


@query(f"SELECT block_type AS name, count(*) AS n FROM {_LEAVES} GROUP BY 1")
def layout_block_hist(t):
    return pages.histogram(_leaves(t), "block_type")


@query("SELECT lower(font) AS name, count(DISTINCT page_id) AS n FROM page_labels GROUP BY 1")
def layout_font_hist(t):
    return t.page_labels.groupBy(F.lower("font").alias("name")).agg(F.countDistinct("page_id").alias("n"))


@query("SELECT template AS name, count(*) AS n FROM (SELECT DISTINCT page_id, template FROM page_labels) GROUP BY 1")
def layout_template_hist(t):
    return pages.histogram(t.page_labels.select("page_id", "template").distinct(), "template")


@query(
    f"""WITH p AS (SELECT page_id, count(*) AS boxes, sum(length(coalesce(text, '')))::BIGINT AS chars FROM {_LEAVES} GROUP BY page_id)
    SELECT count(*) AS pages, round(avg(chars), 1) AS chars_mean, min(chars) AS chars_min, max(chars) AS chars_max, round(avg(boxes), 1) AS boxes_mean, min(boxes) AS boxes_min, max(boxes) AS boxes_max FROM p"""
)
def layout_page_stats(t):
    return pages.page_statistics(_leaves(t))


@query(f"SELECT page_id, pos, block_type FROM {_LEAVES} WHERE bbox[3] - bbox[1] >= 1 AND bbox[4] - bbox[2] >= 1 AND {_strip('coalesce(text, ' + chr(39) * 2 + ')')} <> ''")
def layout_leaf_filter(t):
    return _leaves(t).where(pages.renderable()).select("page_id", "pos", "block_type")


@query(f"SELECT page_id, pos, [bbox[1] * 2, bbox[2] * 3, bbox[3] * 2, bbox[4] * 3] AS scaled FROM {_LEAVES}")
def bbox_scale(t):
    return _leaves(t).select("page_id", "pos", B.scale("bbox", F.lit(2.0), F.lit(3.0)).alias("scaled"))


@query(
    f"""SELECT page_id, pos, [{_grid('bbox[1]', 'image_width')}, {_grid('bbox[2]', 'image_height')}, {_grid('bbox[3]', 'image_width')}, {_grid('bbox[4]', 'image_height')}] AS grid
    FROM {_LEAVES} JOIN {_SIZES} USING (page_id)"""
)
def bbox_norm(t):
    sizes = t.page_labels.where("image_width is not null").select("page_id", "image_width", "image_height").distinct()
    return _leaves(t).join(sizes, "page_id").select("page_id", "pos", B.to_grid("bbox", F.col("image_width"), F.col("image_height")).alias("grid"))


def _turned() -> str:
    x = lambda a, b: f"(cos(radians(2)) * (bbox[{a}] - image_width / 2) + sin(radians(2)) * (bbox[{b}] - image_height / 2) + image_width / 2)"
    y = lambda a, b: f"(-sin(radians(2)) * (bbox[{a}] - image_width / 2) + cos(radians(2)) * (bbox[{b}] - image_height / 2) + image_height / 2)"
    corners = [(1, 2), (3, 2), (3, 4), (1, 4)]
    xs, ys = ", ".join(x(*c) for c in corners), ", ".join(y(*c) for c in corners)
    cut = lambda f, v, n: f"round(greatest(0, least({n}, {f}({v}))), 4)::DOUBLE"
    return f"[{cut('least', xs, 'image_width')}, {cut('least', ys, 'image_height')}, {cut('greatest', xs, 'image_width')}, {cut('greatest', ys, 'image_height')}]"


@query(f"SELECT page_id, pos, {_turned()} AS turned FROM {_LEAVES} JOIN {_SIZES} USING (page_id)")
def bbox_rotate(t):
    sizes = t.page_labels.where("image_width is not null").select("page_id", "image_width", "image_height").distinct()
    turned = B.rotate("bbox", F.lit(2.0), F.col("image_width"), F.col("image_height"))
    return _leaves(t).join(sizes, "page_id").select("page_id", "pos", F.transform(turned, lambda v: F.round(v, 4)).alias("turned"))


_ISSUES = f"""WITH b AS (SELECT page_id, pos, template, bbox, bbox_norm, image_width AS w, image_height AS h, coalesce(block_type <> 'table_cell', true) AS flow, (bbox[2] + bbox[4]) / 2 AS mid
        FROM {_LEAVES} JOIN {_SIZES} USING (page_id)),
    l AS (SELECT *, lag(mid) OVER (PARTITION BY page_id, flow ORDER BY pos) AS above FROM b),
    c AS (SELECT page_id, template, count(*) AS blocks,
        count(*) FILTER (NOT (least(bbox[1], bbox[3]) >= 0 AND greatest(bbox[1], bbox[3]) <= w + 1 AND least(bbox[2], bbox[4]) >= 0 AND greatest(bbox[2], bbox[4]) <= h + 1)) AS out_of_bounds,
        count(*) FILTER (bbox[3] <= bbox[1] OR bbox[4] <= bbox[2]) AS no_area,
        count(*) FILTER (len(list_filter(bbox_norm, lambda v: v < 0 OR v > 999)) > 0) AS off_grid,
        count(*) FILTER (flow AND mid < above - 0.02::DOUBLE * h) AS inversions, count(*) FILTER (flow) AS flowing FROM l GROUP BY page_id, template),
    d AS (SELECT *, coalesce(template IN ('article_single', 'doc_with_table', 'form_label_value', 'mixed_km_en'), false) AND inversions > greatest(1.0::DOUBLE, flowing * 0.1::DOUBLE) AS disorder FROM c)
    SELECT *, out_of_bounds + no_area + off_grid = 0 AND NOT disorder AS clean FROM d"""


@query(_ISSUES)
def box_issues(t):
    return pages.leaf_issues(_leaves(t), t.page_labels)


@query(
    f"""SELECT total, passed, total - passed AS failed, CASE WHEN total = 0 THEN 0 ELSE round(passed * 100 / total, 1) END::DOUBLE AS rate, total > 0 AND total = passed AS gate
    FROM (SELECT count(*) AS total, count(*) FILTER (clean) AS passed FROM ({_ISSUES}))"""
)
def box_gate(t):
    return pages.gate(pages.leaf_issues(_leaves(t), t.page_labels), "clean")


@query(
    f"""SELECT page_id, n, issue FROM (SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY pos, place)::INT AS n, issue FROM (
        SELECT page_id, pos, 1 AS place, pos || ': out of bounds' AS issue FROM {_LEAVES} JOIN {_SIZES} USING (page_id)
            WHERE NOT (least(bbox[1], bbox[3]) >= 0 AND greatest(bbox[1], bbox[3]) <= image_width + 1 AND least(bbox[2], bbox[4]) >= 0 AND greatest(bbox[2], bbox[4]) <= image_height + 1)
        UNION ALL SELECT page_id, pos, 2, pos || ': no area' FROM {_LEAVES} JOIN {_SIZES} USING (page_id) WHERE bbox[3] <= bbox[1] OR bbox[4] <= bbox[2]
        UNION ALL SELECT page_id, pos, 3, pos || ': off the grid' FROM {_LEAVES} JOIN {_SIZES} USING (page_id) WHERE len(list_filter(bbox_norm, lambda v: v < 0 OR v > 999)) > 0)) WHERE n <= 5"""
)
def box_first_issues(t):
    return pages.first_issues(_leaves(t), t.page_labels)


@query(f"SELECT page_id, pos, {_MD} AS md FROM {_LEAVES}")
def md_text(t):
    return _leaves(t).select("page_id", "pos", B.markdown_text("block_type", F.coalesce("text", F.lit(""))).alias("md"))


@query(
    f"""SELECT page_id, string_agg('<|ref|>' || {_MD} || '<|/ref|><|det|>[[' || array_to_string(bbox_norm, ', ') || ']]<|/det|>', {_NL} ORDER BY pos) AS grounded
    FROM {_LEAVES} WHERE bbox_norm IS NOT NULL GROUP BY page_id"""
)
def grounded(t):
    return pages.grounded_targets(_leaves(t))


_RUNS = f"""
    WITH b AS (SELECT *, coalesce(block_type = 'table_cell', false) AS is_cell FROM {_LEAVES}),
    s AS (SELECT *, CASE WHEN is_cell AND lag(is_cell) OVER w AND lag(tbl) OVER w IS NOT DISTINCT FROM tbl THEN 0 ELSE 1 END AS st FROM b WINDOW w AS (PARTITION BY page_id ORDER BY pos)),
    r AS (SELECT *, sum(st) OVER (PARTITION BY page_id ORDER BY pos)::BIGINT AS run FROM s)
"""


@query(f"{_RUNS} SELECT page_id, pos, is_cell, run FROM r")
def islands_group(t):
    return pages.table_runs(_leaves(t)).select("page_id", "pos", "is_cell", "run")


@query(
    f"""{_RUNS},
    c AS (SELECT page_id, run, coalesce(try_cast(nullif(row_idx, '') AS INT), 0) AS r, coalesce(try_cast(nullif(col_idx, '') AS INT), 0) AS c, arg_max(coalesce(text, ''), pos) AS text FROM r WHERE is_cell GROUP BY 1, 2, 3, 4),
    w AS (SELECT page_id, run, max(c) AS wide FROM c GROUP BY 1, 2),
    k AS (SELECT DISTINCT page_id, run, r FROM c),
    x AS (SELECT k.page_id, k.run, k.r, g.i AS i, wide FROM k JOIN w ON k.page_id = w.page_id AND k.run = w.run, LATERAL (SELECT unnest(range(wide + 1)) AS i) g),
    l AS (SELECT x.page_id, x.run, x.r, '| ' || string_agg(coalesce(c.text, ''), ' | ' ORDER BY x.i) || ' |' || CASE WHEN x.r = 0 THEN {_NL} || '| ' || string_agg('---', ' | ') || ' |' ELSE '' END AS line
        FROM x LEFT JOIN c ON c.page_id = x.page_id AND c.run = x.run AND c.r = x.r AND c.c = x.i GROUP BY 1, 2, 3),
    t AS (SELECT page_id, run, string_agg(line, {_NL} ORDER BY r) AS md FROM l GROUP BY 1, 2 UNION ALL SELECT page_id, run, {_MD} AS md FROM r WHERE NOT is_cell)
    SELECT page_id, string_agg(md, {_NL} || {_NL} ORDER BY run) AS markdown FROM t GROUP BY page_id"""
)
def md_pages(t):
    return pages.markdown_pages(_leaves(t))


_TRIP = f"""
    SELECT s.page_id, {_normalize('source_text')} = coalesce({_normalize('joined')}, '') AS same FROM (SELECT DISTINCT page_id, source_text FROM page_labels WHERE source_text IS NOT NULL) s
    LEFT JOIN (SELECT page_id, string_agg(coalesce(text, ''), '' ORDER BY pos) AS joined FROM {_LEAVES} GROUP BY page_id) b ON s.page_id = b.page_id
"""


@query(_TRIP)
def roundtrip_pages(t):
    return pages.roundtrip(_leaves(t), t.page_labels)


@query(
    f"""SELECT total, passed, total - passed AS failed, CASE WHEN total = 0 THEN 0 ELSE round(passed * 100 / total, 1) END::DOUBLE AS rate, total > 0 AND total = passed AS gate
    FROM (SELECT count(*) AS total, count(*) FILTER (same) AS passed FROM ({_TRIP}))"""
)
def roundtrip_gate(t):
    return pages.gate(pages.roundtrip(_leaves(t), t.page_labels), "same")


@query(f"SELECT page_id, pos, row_number() OVER (PARTITION BY page_id ORDER BY round_even(bbox_norm[2] / 20, 0), bbox_norm[1], pos)::INT AS place FROM {_LEAVES} WHERE bbox_norm IS NOT NULL")
def reading_order(t):
    return pages.reading_order(_leaves(t)).select("page_id", "pos", "place")


@query(
    f"""SELECT page_id, 0 AS pos, 'title' AS block_type, md5(page_id) AS text, NULL::VARCHAR AS tbl, NULL::VARCHAR AS row_idx, NULL::VARCHAR AS col_idx FROM {_SIZES}
    UNION ALL SELECT page_id, 1, 'table_cell', template, '0', '0', '0' FROM {_SIZES} UNION ALL SELECT page_id, 2, 'table_cell', image_width::VARCHAR, '0', '1', '0' FROM {_SIZES}
    UNION ALL SELECT page_id, 3, 'caption', 'by', NULL, NULL, NULL FROM {_SIZES}"""
)
def expected_leaves(t):
    none = lambda kind: F.lit(None).cast(kind)

    def block(kind, text, header=None, body=None):
        parts = {"type": F.lit(kind), "text": text, "items": none("array<string>"), "tid": F.lit(0), "header": none("array<string>") if header is None else header, "rows": none("array<array<string>>") if body is None else body, "fields": none("array<struct<label:string,value:string>>")}
        return F.struct(*[c.alias(n) for n, c in parts.items()])

    sizes = t.page_labels.where("image_width is not null").select("page_id", "template", "image_width", "image_height").distinct()
    table = block("table", none("string"), F.array("template"), F.array(F.array(F.col("image_width").cast("string"))))
    blocks = F.array(block("title", F.md5("page_id")), table, block("byline", F.lit("by")))
    return rendering.expected_leaves(sizes.select("page_id", blocks.alias("blocks")))


_V = lambda k: _u(42 + k, "page_id")
_ANY = f"{_V(0)} <= 0.85::DOUBLE"
_EFFECT = lambda k, chance, value: f"CASE WHEN {_ANY} AND {_V(k)} < {chance}::DOUBLE THEN {value} END"
_BETWEEN = lambda k, low, high: f"({low}::DOUBLE + {_V(k)} * {high - low!r}::DOUBLE)"
_AUGMENTED = f"""SELECT page_id, {_EFFECT(1, 0.5, _BETWEEN(2, -2.0, 2.0))} AS rotate_deg, {_EFFECT(3, 0.5, '1 + ' + _BETWEEN(4, -0.12, 0.12))} AS contrast,
    {_EFFECT(3, 0.5, _BETWEEN(5, -0.12, 0.12) + ' * 255')} AS brightness, {_EFFECT(6, 0.2, _BETWEEN(7, 0.8, 1.2))} AS gamma, {_EFFECT(8, 0.4, _BETWEEN(11, 5.0, 25.0))} AS noise_var,
    {_EFFECT(9, 0.3, _whole(1, 2, _V(10)) + ' * 2 + 1')} AS blur_kernel,
    CASE WHEN NOT ({_ANY} AND {_V(9)} < 0.3::DOUBLE) THEN {_EFFECT(12, 0.1, _whole(1, 3, _V(13)) + ' * 2 + 1')} END AS motion_kernel,
    {_EFFECT(14, 0.15, 'true')} AS shadow, {_EFFECT(15, 0.6, _whole(55, 92, _V(16)))} AS jpeg_quality FROM """


@query(_AUGMENTED + "(SELECT DISTINCT page_id FROM page_labels WHERE source IS NULL OR source <> 'real')")
def augmentation_plan(t):
    return rendering.augmentation_plan(t.page_labels.where("source is null or source <> 'real'").select("page_id").distinct())


def _rotated(box: str) -> str:
    """A box turned by rotate_deg about the page's centre and clipped, to three places."""
    corners = [(1, 2), (3, 2), (3, 4), (1, 4)]
    xs = ", ".join(f"(co * ({box}[{a}] - image_width / 2) + si * ({box}[{b}] - image_height / 2) + image_width / 2)" for a, b in corners)
    ys = ", ".join(f"(-si * ({box}[{a}] - image_width / 2) + co * ({box}[{b}] - image_height / 2) + image_height / 2)" for a, b in corners)
    cut = lambda f, v, n: f"greatest(0, least({n}, {f}({v})))::DOUBLE"
    return f"CASE WHEN rotate_deg IS NULL THEN {box} ELSE [{cut('least', xs, 'image_width')}, {cut('least', ys, 'image_height')}, {cut('greatest', xs, 'image_width')}, {cut('greatest', ys, 'image_height')}] END"


_PLACES3 = lambda x: f"list_transform({x}, lambda v: round(v, 3))"


@query(
    f"""WITH p AS ({_AUGMENTED} (SELECT DISTINCT page_id FROM page_labels WHERE image_width IS NOT NULL)),
    l AS (SELECT l.page_id, pos, bbox, line_boxes, image_width, image_height, rotate_deg, cos(radians(rotate_deg)) AS co, sin(radians(rotate_deg)) AS si FROM {_LEAVES} l JOIN {_SIZES} s ON l.page_id = s.page_id JOIN p ON p.page_id = l.page_id),
    r AS (SELECT *, {_rotated('bbox')} AS box, list_transform(line_boxes, lambda b: {_rotated('b')}) AS boxes FROM l)
    SELECT page_id, pos, {_PLACES3('box')} AS bbox, list_transform(boxes, lambda b: {_PLACES3('b')}) AS line_boxes,
        [{_grid('box[1]', 'image_width')}, {_grid('box[2]', 'image_height')}, {_grid('box[3]', 'image_width')}, {_grid('box[4]', 'image_height')}] AS bbox_norm FROM r"""
)
def rotated_leaves(t):
    sizes = t.page_labels.where("image_width is not null").select("page_id", "image_width", "image_height").distinct()
    turned = rendering.rotated_leaves(_leaves(t), rendering.augmentation_plan(sizes.select("page_id")), sizes)
    places = lambda c: F.transform(c, lambda v: F.round(v, 3))
    return turned.select("page_id", "pos", places("bbox").alias("bbox"), F.transform("line_boxes", places).alias("line_boxes"), "bbox_norm")


@query(
    f"""SELECT page_id, pos, [bbox[1] * 1.5::DOUBLE, bbox[2] * 1.5::DOUBLE, bbox[3] * 1.5::DOUBLE, bbox[4] * 1.5::DOUBLE] AS bbox,
        list_transform(line_boxes, lambda b: [b[1] * 1.5::DOUBLE, b[2] * 1.5::DOUBLE, b[3] * 1.5::DOUBLE, b[4] * 1.5::DOUBLE]) AS line_boxes FROM {_LEAVES} JOIN {_SIZES} USING (page_id)"""
)
def scaled_leaves(t):
    sizes = t.page_labels.where("image_width is not null").select("page_id", F.col("image_width").alias("css_width"), F.col("image_height").alias("css_height")).distinct()
    sizes = sizes.withColumns({"image_width": F.col("css_width") * 1.5, "image_height": F.col("css_height") * 1.5})
    return rendering.scaled_leaves(_leaves(t), sizes).select("page_id", "pos", "bbox", "line_boxes")


# Fonts -----------------------------------------------------------------------------------------


@query("SELECT font, weight FROM font_manifest WHERE usable AND coverage >= 0.95")
def usable_fonts(t):
    return t.font_manifest.where("usable and coverage >= 0.95").select("font", "weight")


@query(f"SELECT b.page_id, b.pos, b.font, coalesce(f.family, b.font) AS family, coalesce(f.difficulty, 'unknown') AS difficulty, coalesce(f.weight, 1.0) AS weight FROM {_LEAVES} b LEFT JOIN font_manifest f ON b.font = f.font")
def leaf_fonts(t):
    return fonts.with_settings(_leaves(t), t.font_manifest).select("page_id", "pos", "font", "family", "difficulty", "weight")


_NEED = ", ".join(f"chr({p})" for p in fonts.REQUIRED)


@query(
    f"""SELECT source AS font, covered, round(covered / {len(fonts.REQUIRED)}, 4) AS coverage, covered / {len(fonts.REQUIRED)} >= 0.95 AS usable FROM (
        SELECT source, count(DISTINCT c) FILTER (c IN ({_NEED}))::INT AS covered FROM (SELECT source, unnest(regexp_extract_all(text, '(?s).')) AS c FROM documents WHERE text IS NOT NULL) GROUP BY source)"""
)
def set_coverage(t):
    # the characters that each source uses stand in for a font's character map
    points = F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit(f"[{T.KHMER}]"), F.lit(0)), lambda c: F.conv(F.hex(F.encode(c, "UTF-16BE")), 16, 10).cast("int")))
    used = t.documents.where("text is not null").select(F.col("source").alias("font"), F.explode_outer(points).alias("p")).distinct()
    return fonts.coverage(used.select("font", F.when(F.col("p").isNotNull(), F.array("p")).otherwise(F.array().cast("array<int>")).alias("codepoints")))


# Manifests -------------------------------------------------------------------------------------

def _labels(t):
    # a page's rows differ at most in a missing target
    return t.page_labels.groupBy("page_id").agg(F.min("image").alias("image"), F.min("source").alias("source"), F.max("grounded").alias("grounded"))


_SPLIT = """
    WITH p AS (SELECT page_id, min(image) AS image, min(source) AS source, max(grounded) AS grounded FROM page_labels GROUP BY page_id),
    s AS (SELECT *, row_number() OVER (ORDER BY image, page_id) AS n, count(*) OVER () AS total FROM p WHERE coalesce(source, 'synthetic') <> 'real')
    SELECT image, page_id, 'synthetic' AS source, CASE WHEN n <= greatest(1, floor(total * 0.05::DOUBLE)) THEN 'val' ELSE 'train' END AS split FROM s
    UNION ALL SELECT image, page_id, 'real', 'test' FROM p WHERE source = 'real' AND image <> '' AND grounded <> ''
"""


@query(_SPLIT)
def split_manifest(t):
    return manifests.split_pages(_labels(t))


@query(f"SELECT split, source, count(*) AS n FROM ({_SPLIT}) GROUP BY ALL")
def split_counts(t):
    return manifests.split_pages(_labels(t)).groupBy("split", "source").agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT m.row_id, regexp_extract(m.label, '([^/]+)\\.json$', 1) AS page_id, p.page_id IS NOT NULL AS known FROM manifest m
    LEFT JOIN (SELECT DISTINCT page_id FROM page_labels) p ON regexp_extract(m.label, '([^/]+)\\.json$', 1) = p.page_id"""
)
def manifest_pages(t):
    known = t.page_labels.select("page_id").distinct().withColumn("known", F.lit(True))
    rows = t.manifest.select("row_id", F.coalesce(F.regexp_extract("label", r"([^/]+)\.json$", 1)).alias("page_id"))
    return rows.join(known, "page_id", "left").select("row_id", "page_id", F.coalesce("known", F.lit(False)).alias("known"))


# Sampling --------------------------------------------------------------------------------------


@query(
    f"""WITH w AS (SELECT font, weight, sum(weight) OVER (ORDER BY font ROWS UNBOUNDED PRECEDING) / sum(weight) OVER () AS high FROM font_manifest WHERE usable AND weight > 0),
    d AS (SELECT doc_id, {_u(42, 'doc_id')} AS u FROM documents)
    SELECT doc_id, u, arg_min(font, high) AS font FROM d JOIN w ON high > u GROUP BY doc_id, u"""
)
def weighted_sample(t):
    return sampling.weighted_choice(t.documents, "doc_id", t.font_manifest.where("usable"), "font", "weight")


_SENT = f"list_filter(list_transform(regexp_extract_all(text, '[^{T.TERMINATORS}\n]*[{T.TERMINATORS}]|[^{T.TERMINATORS}\n]+'), lambda x: {_strip('x')}), lambda x: x <> '')"


@query(f"SELECT doc_id, coalesce(s[(floor({_u(42, 'doc_id')} * len(s)) + 1)::BIGINT], text) AS sentence FROM (SELECT doc_id, text, {_SENT} AS s FROM documents WHERE text <> '')")
def sample_sentences(t):
    return sampling.sample_sentences(t.texts("doc_id", "text"))


def _chosen(seed: int, of: str, name: str, n: int) -> str:
    """(page, name) by weight; see weighted_sample."""
    return f"""(SELECT page, arg_min({name}, high) AS {name} FROM (SELECT range AS page, {_u(seed, 'range')} AS u FROM range({n}))
        JOIN (SELECT {name}, sum(weight) OVER (ORDER BY {name} ROWS UNBOUNDED PRECEDING) / sum(weight) OVER () AS high FROM {of} WHERE weight > 0) ON high > u GROUP BY page)"""


_TEMPLATES = "(SELECT unnest([" + ", ".join(repr(k) for k in sorted(sampling.TEMPLATES)) + "]) AS template, unnest([" + ", ".join(f"{sampling.TEMPLATES[k]}::DOUBLE" for k in sorted(sampling.TEMPLATES)) + "]) AS weight)"


def _pages(n: int) -> str:
    v = lambda k: _u(42 + k, "page")
    return f"""(SELECT page, printf('syn_%07d', page) AS page_id, template, font, 1240 AS width, {_whole(60, 140, v(4))} AS margin, CASE WHEN {v(5)} < 0.6::DOUBLE THEN '#ffffff' ELSE {_pick(sampling.PAPERS, v(6))} END AS page_bg, body AS body_px,
        floor(body * scale)::INT AS title_px, floor(body * (1 + (scale - 1) * 0.6::DOUBLE))::INT AS header_px, round(1.4::DOUBLE + {v(7)} * 0.6::DOUBLE, 2) AS line_height, round({v(8)} * 0.5::DOUBLE, 2) AS letter_spacing,
        {_pick(sampling.COLOURS, v(9))} AS color, {_pick(sampling.ALIGNMENTS, v(10))} AS align, CASE WHEN template = 'article_multicol' THEN 2 ELSE 1 END AS columns,
        CASE WHEN template IN ('article_single', 'article_multicol', 'mixed_km_en') THEN {_whole(3, 9, v(11))} END AS paragraphs, CASE WHEN template = 'doc_with_table' THEN {_whole(3, 8, v(12))} END AS table_rows,
        CASE WHEN template = 'doc_with_table' THEN {_whole(2, 5, v(13))} END AS table_cols, CASE WHEN template = 'form_label_value' THEN least(8, {_whole(4, 10, v(14))}) END AS fields
        FROM (SELECT page, template, font, {_whole(16, 26, v(2))} AS body, 1.4::DOUBLE + {v(3)} * 0.8::DOUBLE AS scale FROM {_chosen(42, _TEMPLATES, 'template', n)} JOIN {_chosen(43, "(SELECT * FROM font_manifest WHERE usable)", 'font', n)} USING (page)))"""


@query(f"SELECT * FROM {_pages(2000)}")
def sample_page(t):
    return sampling.sample_pages(2000, t.spark, t.font_manifest)


_POOL = f"(SELECT row_number() OVER (ORDER BY doc_id) - 1 AS k, coalesce(s[(floor({_u(42, 'doc_id')} * len(s)) + 1)::BIGINT], text) AS sentence FROM (SELECT doc_id, text, {_SENT} AS s FROM documents WHERE text <> ''))"


def _pool(t):
    numbered = packaging.number_rows(sampling.sample_sentences(t.texts("doc_id", "text")).select("doc_id", "sentence"), "doc_id", "n")
    return numbered.select((F.col("n") - 1).alias("k"), "sentence")


@query(
    f"""WITH pool AS {_POOL}, d AS (SELECT page, pos, floor({_u(42, "page || ':' || pos")} * (SELECT count(*) FROM pool))::BIGINT AS k FROM (SELECT page, unnest(range(coalesce(paragraphs, 2) + 1)) AS pos FROM {_pages(500)}))
    SELECT page, pos::INT AS pos, sentence FROM d JOIN pool USING (k)"""
)
def sample_page_texts(t):
    return sampling.page_texts(sampling.sample_pages(500, t.spark, t.font_manifest), _pool(t))


def _page_texts() -> str:
    v = lambda k, *more: _u(42 + k, " || ':' || ".join(["page", *more]))
    labels, n = sampling.LABELS, len(sampling.LABELS)
    order = f"list_transform(list_sort([{', '.join(f'{{u: {v(33, repr(str(i)))}, i: {i}}}' for i in range(n))}]), lambda x: x.i)"
    return f"""WITH pool AS {_POOL}, pages AS {_pages(500)},
    a AS (SELECT page, template, unnest(range(paragraphs)) AS i FROM pages WHERE paragraphs IS NOT NULL),
    c AS (SELECT page, template, table_rows, unnest(range(table_cols)) AS c FROM pages WHERE table_cols IS NOT NULL),
    places AS (
        SELECT page, template, 10 AS place, CASE template WHEN 'form_label_value' THEN 'form_title' ELSE 'title' END AS kind, CASE template WHEN 'form_label_value' THEN 0 ELSE 1 END AS n, 0 AS part FROM pages
        UNION ALL SELECT page, template, 11, 'byline', 0, 0 FROM pages WHERE paragraphs IS NOT NULL
        UNION ALL SELECT page, template, 19 + 2 * i, 'section_header', 1, 0 FROM a WHERE i > 0 AND {v(21, 'i')} < 0.4::DOUBLE
        UNION ALL SELECT page, template, 20 + 2 * i, 'text', {_whole(2, 6, v(22, 'i'))}, 0 FROM a
        UNION ALL SELECT page, template, 60, 'list_item', 1, unnest(range({_whole(3, 5, v(24))})) FROM pages WHERE paragraphs IS NOT NULL AND {v(23)} < 0.3::DOUBLE
        UNION ALL SELECT page, template, 20, 'text', {_whole(2, 4, v(25))}, 0 FROM pages WHERE table_rows IS NOT NULL
        UNION ALL SELECT page, template, 300, 'text', {_whole(2, 4, v(26))}, 0 FROM pages WHERE table_rows IS NOT NULL
        UNION ALL SELECT page, template, 199, 'header', 1, c FROM c WHERE {v(27)} < 0.9::DOUBLE
        UNION ALL SELECT page, template, 200 + unnest(range(table_rows)), 'cell', 1, c FROM c
        UNION ALL SELECT page, template, 20, 'field', 0, unnest(range(fields)) FROM pages WHERE fields IS NOT NULL),
    said AS (SELECT page, place, part, string_agg(sentence, '' ORDER BY s) AS said FROM (
        SELECT page, place, part, s, floor({_u(72, "page || ':' || place || ':' || part || ':' || s")} * (SELECT count(*) FROM pool))::BIGINT AS k FROM (SELECT page, place, part, unnest(range(1, n + 1)) AS s FROM places)) JOIN pool USING (k) GROUP BY ALL)
    SELECT p.page, p.place::INT AS place, p.part::INT AS part, kind, CASE kind WHEN 'byline' THEN '{sampling.BYLINE}' || {_pick(sampling.PAPER_NAMES, v(35).replace('page', 'p.page'))} WHEN 'header' THEN substr(said, 1, 12) WHEN 'cell' THEN substr(said, 1, 14)
        WHEN 'text' THEN said || CASE WHEN template = 'mixed_km_en' AND {v(31, 'place').replace('page', 'p.page').replace('|| place', '|| p.place')} < 0.6::DOUBLE THEN ' (' || {_pick(sampling.ENGLISH, v(32, 'place').replace('page', 'p.page').replace('|| place', '|| p.place'))} || ')' ELSE '' END
        WHEN 'form_title' THEN {_pick(sampling.FORM_TITLES, v(36).replace('page', 'p.page'))}
        WHEN 'field' THEN [{', '.join(repr(x) for x in labels)}][{order.replace('page', 'p.page')}[p.part + 1] + 1] || chr(9) || {_pick(sampling.VALUES, v(34, 'part').replace('page', 'p.page').replace('|| part', '|| p.part'))} ELSE said END AS text
    FROM places p LEFT JOIN said ON said.page = p.page AND said.place = p.place AND said.part = p.part"""


@query(_page_texts())
def sample_page_leaves(t):
    return sampling.page_leaf_texts(sampling.sample_pages(500, t.spark, t.font_manifest), _pool(t))


@query(
    f"""SELECT page, (row_number() OVER (PARTITION BY page ORDER BY place, part, half) - 1)::INT AS pos,
        CASE kind WHEN 'byline' THEN 'caption' WHEN 'header' THEN 'table_cell' WHEN 'cell' THEN 'table_cell' WHEN 'form_title' THEN 'title' WHEN 'field' THEN CASE half WHEN 1 THEN 'form_label' ELSE 'form_value' END ELSE kind END AS block_type,
        CASE kind WHEN 'field' THEN split_part(text, chr(9), half) ELSE text END AS text, CASE WHEN kind IN ('header', 'cell') THEN '0' END AS tbl,
        CASE kind WHEN 'header' THEN '0' WHEN 'cell' THEN (place - 199)::VARCHAR END AS row_idx, CASE WHEN kind IN ('header', 'cell') THEN part::VARCHAR END AS col_idx
    FROM (SELECT *, unnest(CASE kind WHEN 'field' THEN [1, 2] ELSE [1] END) AS half FROM ({_page_texts()}))"""
)
def page_model_leaves(t):
    # the whole way: styles, texts, blocks, and the leaves that a template gives
    blocks = sampling.page_blocks(sampling.page_leaf_texts(sampling.sample_pages(500, t.spark, t.font_manifest), _pool(t)))
    return rendering.expected_leaves(blocks, "page")


@query(
    f"""SELECT font, coalesce(difficulty, '?') AS difficulty, CASE WHEN coverage IS NULL THEN 'n/a' ELSE round(coverage * 100)::INT || '%' END AS coverage, '{fonts.QA_TITLE}' || font AS title FROM font_manifest WHERE usable"""
)
def font_qa_pages(t):
    return fonts.qa_pages(t.font_manifest.where("usable")).select("font", F.coalesce("difficulty", F.lit("?")).alias("difficulty"), fonts.coverage_text().alias("coverage"), F.col("blocks")[0]["text"].alias("title"))


# Ingest ----------------------------------------------------------------------------------------


@query(f"SELECT text, 'published' AS source, 'CC BY 4.0' AS license, nullif(url, '') AS url, false AS non_commercial FROM documents WHERE {_strip('text')} <> ''")
def dataset_rows(t):
    return readers.dataset_rows(t.documents, "published", "CC BY 4.0").select("text", "source", "license", "url", "non_commercial")


def _escaped(c: str):
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(char), F.lit(name))
    return c


@query(
    f"""SELECT doc_id, nullif(array_to_string(list_filter(list_transform(string_split(text, {_NL}), lambda x: {_strip('x')}), lambda x: x <> ''), {_NL}), '') AS main
    FROM documents WHERE text IS NOT NULL"""
)
def html_main_text(t):
    docs = t.documents.where("text is not null")
    page = F.concat(F.lit("<html><head><style>p{}</style><script>if (a) { b(); }</script></head><body><nav>Home</nav><!-- ad -->"), F.replace(_escaped("text"), F.lit("\n"), F.lit("<br/>")), F.lit("<footer>Foot</footer></body></html>"))
    return docs.select("doc_id", readers.html_text(page).alias("main"))


@query(f"SELECT doc_id, pos, CASE pos WHEN 0 THEN {_strip('url')} ELSE 'https://site.example/' || doc_id || CASE pos WHEN 1 THEN '' ELSE '?a=1&b=2' END END AS link FROM documents, (SELECT unnest([0, 1, 2]) AS pos) WHERE {_strip('url')} <> ''")
def feed_links(t):
    # an item, a second item, and an entry with two links, of which the one with an address counts
    docs = t.documents.where("url <> ''")
    item = lambda link: F.concat(F.lit("<item><title>t</title><link> "), link, F.lit(" </link></item>"))
    more = F.concat(F.lit("https://site.example/"), F.col("doc_id").cast("string"))
    entry = F.concat(F.lit("<entry><link>none</link><link rel='alternate' href='"), more, F.lit("?a=1&amp;b=2'/></entry>"))
    xml = F.concat(F.lit("<rss version=\"2.0\"><channel><link>https://site.example</link>"), item(_escaped("url")), item(more), entry, F.lit("</channel></rss>"))
    return readers.feed_links(docs.select("doc_id", xml.alias("xml")), keep=("doc_id",))


_PLAIN = r"regexp_replace(regexp_replace(regexp_replace(text, '(?s)\{\{.*?\}\}', '', 'g'), '\[\[(?:[^\]|]*\|)?([^\]]*)\]\]', '\1', 'g'), '<[^>]+>', '', 'g')"


@query(f"SELECT doc_id, {_strip(_PLAIN)} AS plain FROM documents WHERE text IS NOT NULL")
def wiki_strip(t):
    # the stored texts themselves, with whatever markup they hold
    return t.documents.where("text is not null").select("doc_id", readers.strip_wiki("text").alias("plain"))


@query(f"SELECT {_strip('line')} AS text FROM (SELECT unnest(string_split(text, {_NL})) AS line FROM documents WHERE text IS NOT NULL) WHERE {_strip('line')} <> ''")
def sentence_table(t):
    # whole texts: each line is a numbered line of the table
    lines = t.documents.where("text is not null").select(F.posexplode(F.split("text", "\n")).alias("n", "line"))
    return readers.sentence_table(lines.select(F.concat(F.col("n").cast("string"), F.lit("\t"), "line").alias("value")))


@query(
    f"""SELECT page_id AS image, pos::VARCHAR AS id, coalesce(block_type, 'text') AS block_type, CASE WHEN bbox_norm IS NULL THEN [0, 0, 999, 999] ELSE bbox_norm END AS bbox, text FROM {_LEAVES} WHERE text <> ''"""
)
def region_merge(t):
    """Leaves as annotated regions and back: without a grid box the whole page, without a type no label, texts as lists or plain strings, results under either name."""
    leaf = _leaves(t)
    part = lambda i, whole: F.coalesce(F.col("bbox_norm")[i] / F.lit(9.99), F.lit(whole))
    none = lambda kind: F.lit(None).cast(kind)

    def result(x, y, width, height, labels, text):
        value = F.struct(x.alias("x"), y.alias("y"), width.alias("width"), height.alias("height"), labels.alias("rectanglelabels"), text.alias("text"))
        return F.struct(F.col("pos").cast("string").alias("id"), value.alias("value"))

    labels = F.when(F.col("block_type").isNotNull(), F.array("block_type"))
    box = result(part(0, 0.0), part(1, 0.0), part(2, 100.0) - part(0, 0.0), part(3, 100.0) - part(1, 0.0), labels, none("string"))
    said = F.when(F.col("text").isNotNull(), F.when(F.col("pos") % 2 == 0, F.to_json(F.array("text"))).otherwise(F.col("text")))
    words = result(*[none("double")] * 4, none("array<string>"), said)
    lists = leaf.select("page_id", box.alias("box"), words.alias("words")).groupBy("page_id").agg(F.concat(F.collect_list("box"), F.collect_list("words")).alias("result"))
    odd = F.pmod(F.xxhash64("page_id"), F.lit(2)) == 1
    found = F.array(F.struct("result"))
    tasks = lists.select(F.struct(F.col("page_id").alias("image")).alias("data"), F.when(~odd, found).alias("annotations"), F.when(odd, found).alias("completions"))
    return exports.regions(tasks).drop("pos")


@query(
    f"""SELECT printf('real_%04d', row_number() OVER (ORDER BY name, page) - 1) AS page_id, name, page::INT AS page FROM (
        SELECT regexp_extract(image, '([^/]+)$', 1) AS name, 0 AS page FROM (SELECT DISTINCT image FROM page_labels WHERE regexp_matches(lower(image), '\\.(png|jpg|jpeg|webp|bmp|tif|tiff)$'))
        UNION ALL SELECT page_id || '.pdf', unnest(range(2)) FROM (SELECT DISTINCT page_id FROM page_labels))"""
)
def ingest_plan(t):
    # the labels' images, and a PDF of two pages for each label
    images = t.page_labels.select(F.col("image").alias("path")).distinct()
    pdfs = t.page_labels.select(F.concat("page_id", F.lit(".pdf")).alias("path")).distinct()
    plan = readers.ingest_plan(images.union(pdfs), pdfs.withColumn("pages", F.lit(2)))
    return plan.select("page_id", F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "page")


# Streaming -------------------------------------------------------------------------------------


def _raw_stream(t, name: str, schema_of: DataFrame) -> tuple[DataFrame, str]:
    """A table as a stream, and a folder for its run."""
    base = f"{shared_dir(t.spark)}/sastra-stream-{uuid.uuid4().hex}"
    source = t.spark.readStream.schema(schema_of.schema)
    return source.parquet(f"{t.folder}/{name}.parquet") if _is_folder(t, name) else source.option("pathGlobFilter", f"{name}.parquet").parquet(t.folder), base


def _stream(t, name: str, schema_of: DataFrame, build) -> DataFrame:
    """Runs a stream over a table to its end, into a folder of its own, and reads that."""
    raw, base = _raw_stream(t, name, schema_of)
    incremental.run_to_table(build(raw), f"{base}/out", f"{base}/checkpoint")
    return t.spark.read.parquet(f"{base}/out")


def _is_folder(t, name: str) -> bool:
    path = t.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{t.folder}/{name}.parquet")
    return path.getFileSystem(t.spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory()


@query("SELECT sha1(text) AS text_sha1, length(any_value(text))::INT AS n_chars FROM documents WHERE text <> '' GROUP BY sha1(text)")
def stream_first_arrivals(t):
    # every text once, by its hash, which does not depend on the files' order; the table spans under half a year
    return _stream(t, "documents", t.documents, lambda s: incremental.first_arrivals(s, late="180 days").select("text_sha1", F.length("text").alias("n_chars")))


@query("SELECT date_trunc('day', ingested_at AT TIME ZONE 'UTC') AS day, source, count(*) AS docs, sum(length(text))::BIGINT AS chars FROM documents WHERE ingested_at IS NOT NULL GROUP BY ALL")
def stream_daily_counts(t):
    raw, base = _raw_stream(t, "documents", t.documents)
    incremental.run_updates(incremental.arrivals_per_source(raw), f"{base}/out", f"{base}/checkpoint")
    found = incremental.latest(t.spark, f"{base}/out", ["window", "source"])
    return found.select(F.col("window.start").alias("day"), "source", "docs", "chars")
