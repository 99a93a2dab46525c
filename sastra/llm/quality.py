"""Problem 1: statistics per document that set prose apart from lists, tables, menus and junk.

1. Array passes over whole texts (no loop over characters) give statistics of each line and each document.
2. The lines that are written as sentences are (no item signs, long enough, closed by a final mark where the
   language has one) give one mergeable quantile sketch (KLL) per statistic and language. Lists and junk are
   hardly ever among these lines, so a source full of them doesn't move the sketches.
3. Each line's statistics turn into robust z-scores against its language's quartiles, as far as a line of its
   length can vary. A line in the tail of one of them (few common words, few letters, many symbols, separators,
   digits or code characters, short or endless stretches between blanks) is no running text; nor is one with an
   item's sign, dot leaders, or a key and a value.
4. A document is junk where more than half of its filled characters stand in such lines or in repeated stretches.
5. The documents' own statistics get sketches per language, z-scores and a tail flag, too.

Cases: null, empty and blank texts have zero counts and null shares and are not flagged; texts under 25 code
points are not flagged; a language with under `MIN_GROUP` sentence lines (or documents) is judged by its
script's quantiles, then by those of all; where there are none at all only the signs of items count; very long
texts count whole; repeated rows are rows.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sastra.functions.text import valid
from sastra.llm import textops
from sastra.llm.lookalike import shapes
from sastra.plans.stage import stage

MIN_CHARS, MIN_GROUP = 25, 30

BLANK, LETTER, DIGIT, SYMBOL, IGNORE = 0, 1, 2, 3, 4


@lru_cache(1)
def char_table() -> np.ndarray:
    """BLANK, LETTER (with marks), DIGIT, SYMBOL or IGNORE for each code point."""
    every = "".join(map(chr, range(0xD800))) + "\0" * 0x800 + "".join(map(chr, range(0xE000, 0x110000)))
    table = np.full(0x110000, SYMBOL, np.uint8)
    for pattern, value in ((r"[\p{L}\p{M}]+", LETTER), (r"\p{N}+", DIGIT), (r"[\s\p{Z}]+", BLANK), (r"[\p{Cf}]+", IGNORE)):
        for m in regex.finditer(pattern, every):
            table[m.start() : m.end()] = value
    return table


@lru_cache(1)
def role_table() -> np.ndarray:
    """Bits of each code point: 1 ends a sentence, 2 closes, 4 separates items, 8 opens an item, 16 is code's."""
    table = np.zeros(0x110000, np.uint8)
    for chars, bit in ((".!?។៕៚。！？．…｡", 1), ("»”」』’\"')）]", 2), ("|\t·•»/,،、,，/>;｜＞；", 4), ("-–—*•►▪‣◦·✓✅+－＊", 8), ("{}();=#<>_\\｛｝（）；＝＃＜＞＿$%&@^~", 16)):
        for c in chars:
            table[ord(c)] |= bit
    return table


#: Scripts by range of code points; others are Latin and the like.
SCRIPTS = {"khmer": (0x1780, 0x1800), "thai": (0xE00, 0xE80), "han": (0x3400, 0xA000)}


@lru_cache(1)
def fold_table() -> np.ndarray:
    """Each code point without case, accents, width and look-alike letters of other scripts; 0 for what shows nothing."""
    table = np.arange(0x110000, dtype=np.uint32)
    looks = {c: same[0][0] for c, same in shapes().items()}
    for o in (*range(0x2000), *range(0xFF00, 0xFFEF)):
        c = unicodedata.normalize("NFKD", chr(o))[0]
        if c == " ":  # a mark that stands alone is no blank
            continue
        table[o] = ord(looks.get(c, c).lower()[0]) if not 0x780 <= o < 0x1E00 else o
    table[0x300:0x370] = 0
    table[char_table() == IGNORE] = 0
    table[9], table[0xA0], table[0x3000] = 9, 32, 32
    return table


def folded(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts folded, without what shows nothing, and their new offsets."""
    out = fold_table()[flat]
    keep = out > 0
    return out[keep], np.concatenate(([0], np.cumsum(keep)))[offsets]


def row_starts(offsets: np.ndarray, n: int) -> np.ndarray:
    """Which of n code points begin a text."""
    out = np.zeros(n, bool)
    out[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return out


class WordMarks:
    """Marks the code points that stand in known words, each word with bits of its own."""

    def __init__(self, words: dict[str, int]):
        #: Sorted hashes and bits by length, of words of scripts without spaces, which may stand anywhere; and of others.
        self.joined: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        by: dict[int, dict[int, int]] = {}
        spaced: dict[int, dict[int, int]] = {}
        for w, bits in words.items():
            codes = [int(x) for x in fold_table()[[ord(c) for c in w]] if x]
            if codes:
                group = by if any(a <= codes[0] < b for a, b in SCRIPTS.values()) else spaced
                known = group.setdefault(len(codes), {})
                h = self.hash(codes)
                known[h] = known.get(h, 0) | bits
        table = lambda d: {k: (np.array(sorted(v), np.uint64), np.array([v[h] for h in sorted(v)], np.uint32)) for k, v in d.items()}
        self.joined, self.spaced = table(by), table(spaced)

    @staticmethod
    def hash(codes) -> int:
        h = 0
        for c in codes:
            h = (h * 0x9E3779B97F4A7C15 + c + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    @staticmethod
    def _bits(values: np.ndarray, known: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """The bits of each hash, 0 where it is of no known word."""
        at = np.minimum(np.searchsorted(known[0], values), len(known[0]) - 1)
        return np.where(known[0][at] == values, known[1][at], 0)

    def marks(self, flat: np.ndarray, kind: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The bits of all words that each code point stands in (uint32), in one pass for all lists of words; no word crosses a text's end."""
        n = len(flat)
        first = row_starts(offsets, n)
        end = np.repeat(offsets[1:], np.diff(offsets))
        out = np.zeros(n, np.uint32)
        p = np.uint64(0x9E3779B97F4A7C15)
        plain = np.zeros(n, bool)
        for a, b in SCRIPTS.values():
            plain |= (flat >= a) & (flat < b)
        at = np.flatnonzero(plain & (kind == LETTER))
        h = np.zeros(len(at), np.uint64)
        for k in range(1, max(self.joined, default=0) + 1):
            inside = at + k <= end[at]
            at, h = at[inside], h[inside]
            h = h * p + flat[at + k - 1] + np.uint64(1)
            if k in self.joined:
                bits = self._bits(h, self.joined[k])
                hit = bits > 0
                for j in range(k):
                    out[at[hit] + j] |= bits[hit]
        # words of spaced scripts: whole runs of letters
        word = (kind == LETTER) & ~plain
        start = np.flatnonzero(word & (first | ~np.concatenate(([False], word[:-1]))))
        size = np.flatnonzero(word & ~np.concatenate((word[1:] & ~first[1:], [False]))) + 1 - start
        for k, known in self.spaced.items():
            at = start[size == k]
            h = np.zeros(len(at), np.uint64)
            for j in range(k):
                h = h * p + flat[at + j] + np.uint64(1)
            bits = self._bits(h, known)
            hit = bits > 0
            for j in range(k):
                out[at[hit] + j] |= bits[hit]
        return out


#: Line statistics: the direction of the tail (+ high, - low) and the least spread, so that equal values aren't overrated.
LINE = {"common": (-1, 0.02), "letter": (-1, 0.04), "symbol": (1, 0.02), "code": (1, 0.02), "separator": (1, 0.012), "digit": (1, 0.05), "phrase": (-1, 0.15)}
#: A line is in the tail from so many robust deviations on; a final mark takes one off, but for symbols' sake.
TAIL, MARKED = 2.8, ("common", "letter", "digit", "phrase")
#: Shares of lines shorter than this vary more, by the fourth root of the length.
FULL_LINE = 100
#: From how many filled characters on a line is a sample of sentences.
SAMPLE = 40
#: Scripts that are written without final marks.
UNMARKED = ("thai",)
#: A stretch of this length that occurs so often is repeated over and over.
STRETCH, TIMES = 20, 3
FIELDS = ["n_chars", "n_words", "n_lines", "mean_word", "symbol_ratio", "digit_ratio", "end_share", "common_share", "repeat_share", "junk_share"]
STATISTICS = FIELDS[3:]


def _sum(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[ends] - total[starts]


def line_features(flat: np.ndarray, offsets: np.ndarray, marks: np.ndarray) -> dict[str, np.ndarray]:
    """Counts per line of all texts, `marks` being the bits of common words; a line never crosses a text's end."""
    n = len(flat)
    kind = char_table()[flat]
    role = role_table()[flat]
    cut = np.flatnonzero((flat == 10) | (flat == 13) | (flat == 0x2028))
    bounds = np.unique(np.concatenate((offsets, cut + 1)))
    bounds = bounds[bounds <= n]
    a, b = bounds[:-1], bounds[1:]
    row = np.searchsorted(offsets, a, side="right") - 1
    seen = (kind != BLANK) & (kind != IGNORE)
    out = {"row": row, "start": a, "end": b, "filled": _sum(seen, a, b), "letters": _sum(kind == LETTER, a, b), "digits": _sum(kind == DIGIT, a, b)}
    out["symbols"] = _sum(kind == SYMBOL, a, b)
    out["separators"] = _sum(role & 4 > 0, a, b)
    begins = seen & (row_starts(offsets, n) | ~np.concatenate(([False], seen[:-1])))
    out["words"] = _sum(begins, a, b)
    out["code"] = _sum(role & 16 > 0, a, b)
    out["keyed"] = _sum((flat == 0x3A) | (flat == 0xFF1A), a, b) > 0
    dots = np.zeros(n, bool)
    if n > 3:
        stop = (flat == 46) | (flat == 0xFF0E)
        dots = stop.copy()
        dots[:-3] &= stop[1:-2] & stop[2:-1] & stop[3:]
        dots[-3:] = False
    out["leaders"] = _sum(dots, a, b)
    out["common"] = _sum(marks > 0, a, b)
    # the last character of a line that is neither blank nor closing, and the first that isn't blank
    where = np.where(seen & (role & 2 == 0), np.arange(n), -1)
    first = np.where(seen, np.arange(n), n)
    if len(a):
        last = np.maximum.reduceat(where, a) if n else where
        begin = np.minimum.reduceat(first, a) if n else first
        last = np.where(last >= a, last, -1)
        out["ends"] = (last >= 0) & (role[last] & 1 > 0)
        begin = np.where(begin < b, begin, 0)
        nxt = np.minimum(begin + 1, max(n - 1, 0))
        out["bullet"] = ((role[begin] & 8 > 0) | (flat[begin] == ord("o"))) & (kind[nxt] == BLANK) if n else np.zeros(len(a), bool)
        for d in (1, 2, 3):  # an item's number
            dot, after = np.minimum(begin + d, max(n - 1, 0)), np.minimum(begin + d + 1, max(n - 1, 0))
            out["bullet"] |= (kind[begin] == DIGIT) & ((flat[dot] == 46) | (flat[dot] == 41)) & (kind[after] == BLANK) & ~out["ends"]
    else:
        out["ends"] = out["bullet"] = np.zeros(0, bool)
    return out


def repeated(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which code points start a stretch that its text holds `TIMES` times or more."""
    out = np.zeros(len(flat), bool)
    m = len(flat) - STRETCH + 1
    if m < TIMES:
        return out
    # doubling: hashes of 4, 16 and 20 code points from shorter ones
    p = np.uint64(0x9E3779B97F4A7C15)
    h4 = flat[: len(flat) - 3].astype(np.uint64)
    for j in range(1, 4):
        h4 = h4 * p + flat[j : len(flat) - 3 + j]
    h = h4[:m].copy()
    for j in range(4, STRETCH, 4):
        h = textops.mix64(h) * p + h4[j : m + j]
    rows = textops.rows_of(offsets)[:m]
    at = np.flatnonzero(np.arange(m) + STRETCH <= offsets[rows + 1])
    key = (textops.mix64(h[at]) >> np.uint64(12)) | (rows[at].astype(np.uint64) << np.uint64(52))
    order = np.argsort(key)
    key = key[order]
    edge = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    size = np.diff(np.append(edge, len(key)))
    out[at[order[np.repeat(size >= TIMES, size)]]] = True
    return out


_LINES = "array<struct<group:int,filled:int,cover:int,item:boolean,ends:boolean,sample:boolean," + ",".join(f"{x}:float" for x in LINE) + ">>"


class Languages:
    """The groups of lines and documents: the scripts without spaces, then the languages of the others, then none of them."""

    def __init__(self, words: list[tuple[str, str | None]]):
        plain = lambda w: any(a <= ord(w[0]) < b for a, b in SCRIPTS.values())
        self.spaced = sorted({lang for w, lang in words if w and lang and not plain(w)})[:30]
        bits: dict[str, int] = {}
        for w, lang in words:
            if w:
                bits[w] = bits.get(w, 0) | 1 | (2 << self.spaced.index(lang) if lang in self.spaced and not plain(w) else 0)
        self.words = bits
        self.names = [*SCRIPTS, *self.spaced, "other"]
        #: The script of each group: all languages with spaces have one.
        self.scripts = [*SCRIPTS, *["spaced"] * (len(self.spaced) + 1)]


def document_statistics(docs: DataFrame, words: list[tuple[str, str | None]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang, counts, shares, lines) of each document; shares are null where there is nothing to share."""
    languages = Languages(words)

    def run(batches):
        known = WordMarks(languages.words)
        other = len(languages.names) - 1
        for batch in batches:
            texts = batch.column(1)
            for s, e in textops.chunks(texts):
                part = texts.slice(s, e - s)
                whole, places = textops.codepoints(part)
                flat, offsets = folded(whole, places)
                n = e - s
                a, b = offsets[:-1], offsets[1:]
                kind = char_table()[flat]
                marks = np.where(kind == LETTER, known.marks(flat, kind, offsets), 0)
                f = line_features(flat, offsets, marks)
                row = f["row"]
                per = lambda x: np.bincount(row, weights=x, minlength=n)[:n]  # noqa: B023, E731
                full = f["filled"] > 0
                filled, letters = per(f["filled"]), per(f["letters"])
                # the script of most letters, else the language with most common words
                line_group, group = np.full(len(row), -1), np.full(n, -1)
                for i, (lo, hi) in enumerate(SCRIPTS.values()):
                    count = _sum((flat >= lo) & (flat < hi) & (kind == LETTER), f["start"], f["end"])
                    line_group[2 * count > f["letters"]] = i
                    group[2 * per(count) > letters] = i
                best, most = np.full(n, other), np.zeros(n)
                for i in range(len(languages.spaced)):
                    count = _sum(marks & (2 << i) > 0, a, b)
                    best = np.where(count > most, len(SCRIPTS) + i, best)
                    most = np.maximum(most, count)
                group = np.where(group < 0, best, group)
                line_group = np.where(line_group < 0, best[row], line_group)
                # the code points that a repeated stretch covers
                again = repeated(flat, offsets)
                cover = np.convolve(again, np.ones(STRETCH, np.int8))[: len(flat)] > 0 if again.any() else again
                cover &= kind != BLANK
                n_words = per(f["words"])
                with np.errstate(divide="ignore", invalid="ignore"):
                    values = {
                        "mean_word": filled / n_words,
                        "symbol_ratio": per(f["symbols"]) / filled,
                        "digit_ratio": per(f["digits"]) / filled,
                        "end_share": per(f["ends"] & full) / per(full),
                        "common_share": per(f["common"]) / letters,
                        "repeat_share": _sum(cover, a, b) / filled,
                    }
                some, some_letters, phrases = np.maximum(f["filled"], 1), np.maximum(f["letters"], 1), np.maximum(f["words"], 1)
                phrase = np.log(some / phrases)
                item = f["bullet"] | (f["leaders"] > 0) & (f["digits"] > 0) | f["keyed"] & ~f["ends"] & (f["filled"] < 80)
                unmarked = np.isin(line_group, [i for i, x in enumerate(languages.names) if x in UNMARKED])
                lines = {
                    "group": line_group.astype(np.int32), "filled": f["filled"].astype(np.int32), "cover": _sum(cover, f["start"], f["end"]).astype(np.int32), "item": item, "ends": f["ends"],
                    "sample": (f["filled"] >= SAMPLE) & ~f["bullet"] & ~f["keyed"] & (f["ends"] | unmarked),
                    "common": f["common"] / some_letters, "letter": f["letters"] / some, "symbol": f["symbols"] / some, "code": f["code"] / some, "separator": f["separators"] / some, "digit": f["digits"] / some, "phrase": phrase,
                }
                arrays = [pa.array(v.astype(np.float32) if k in LINE else v) for k, v in lines.items()]
                listed = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(n + 1)), pa.int32()), pa.StructArray.from_arrays(arrays, list(lines)))
                counts = [np.diff(places), n_words.astype(np.int64), per(full).astype(np.int64)]
                columns = [batch.column(0).slice(s, n), pa.array(np.array(languages.names)[group], pa.string()), pa.array(np.array(languages.scripts)[group], pa.string()), *(pa.array(x, pa.int64()) for x in counts)]
                columns += [pa.array(v, pa.float64(), mask=~np.isfinite(v)) for v in values.values()]
                yield pa.RecordBatch.from_arrays([*columns, listed], ["id", "lang", "script", *FIELDS[:-1], "lines"])

    schema = "id bigint, lang string, script string, n_chars bigint, n_words bigint, n_lines bigint, " + ", ".join(f"{x} double" for x in STATISTICS[:-1]) + f", lines {_LINES}"
    return docs.select(F.col(id_col).cast("bigint").alias("id"), valid(text_col).alias("text")).mapInArrow(run, schema)


RANKS = (0.25, 0.5, 0.75)


def sketch_quantiles(rows: DataFrame, columns: list[str], k: int = 400) -> DataFrame:
    """(script, lang, n, column_25, column_50, column_75): quartiles from one KLL sketch per statistic and language.

    The sketches of a script (lang null) and of all (both null) are of the same aggregation.
    """
    sketches = rows.rollup("script", "lang").agg(F.count(F.lit(1)).alias("n"), *[F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(k)).alias(c) for c in columns])
    out = [F.when(F.col(c).isNotNull() & (F.kll_sketch_get_n_double(c) > 0), F.kll_sketch_get_quantile_double(F.col(c), F.lit(q))).alias(f"{c}_{round(q * 100)}") for c in columns for q in RANKS]
    return sketches.select("script", "lang", "n", *out)


def quartile_table(quantiles: DataFrame, languages: Languages, columns: list[str], least: int = MIN_GROUP) -> np.ndarray:
    """Quartiles by group, statistic and rank, NaN where there are none.

    A row per language and script comes to the driver, whatever the corpus. A language of under `least` rows has
    its script's values, a script of under that many those of all.
    """
    found = {(r.script, r.lang): r for r in quantiles.collect()}
    out = np.full((len(languages.names), len(columns), len(RANKS)), np.nan)
    for i, (lang, script) in enumerate(zip(languages.names, languages.scripts)):
        options = [found.get(key) for key in ((script, lang if lang != "other" else None), (script, None), (None, None))]
        row = next((r for r in options if r is not None and r.n >= least), found.get((None, None)))
        if row is not None:
            out[i] = [[np.nan if (v := row[f"{c}_{round(q * 100)}"]) is None else v for q in RANKS] for c in columns]
    return out


def robust_z(values: np.ndarray, quartiles: np.ndarray, floor: float) -> np.ndarray:
    """Robust z-scores against quartiles (rows: one set per value), 0 where there are none.

    The narrower side gives the spread: the other may hold a tail itself.
    """
    low, mid, high = quartiles.T
    side = np.maximum(np.minimum(high - mid, mid - low), floor)
    return np.nan_to_num((values - mid) / (side / 0.6745))


def tail_lines(lines: dict[str, np.ndarray], table: np.ndarray, plain: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Which lines are in the tail of one of their language's statistics; `plain`: lines of scripts without spaces."""
    group = lines["group"]
    worst = np.full(len(group), -np.inf)
    vary = np.maximum(FULL_LINE / np.maximum(lines["filled"], 1), 1) ** 0.25
    for i, (name, (sign, floor)) in enumerate(LINE.items()):
        z = sign * robust_z(lines[name].astype(np.float64), table[group, i], floor)
        if name == "phrase":
            # between blanks: items are shorter than phrases where words aren't parted, and junk is longer than words elsewhere
            z = np.where(plain, z * (words > 3), -z)
        else:
            z = z / vary
        worst = np.maximum(worst, z - (lines["ends"] if name in MARKED else 0))
    return worst > TAIL


def judged(docs: DataFrame, words: list[tuple[str, str | None]], id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """(id, lang, script, FIELDS, is_junk): the statistics with the share of text in tail lines; see the module's text, 2 to 4."""
    spark = docs.sparkSession
    languages = Languages(words)
    stats = stage(document_statistics(docs, words, id_col, text_col), "statistics")
    samples = stats.select(F.explode("lines").alias("l")).where("l.sample").select("l.*")
    named = [F.element_at(F.array(*[F.lit(x) for x in names]), F.col("group") + 1).alias(k) for k, names in (("lang", languages.names), ("script", languages.scripts))]
    quantiles = sketch_quantiles(samples.select(*named, *LINE), list(LINE))
    table = spark.sparkContext.broadcast(quartile_table(quantiles, languages, list(LINE)))
    names = ["id", "lang", "script", *FIELDS]

    def run(batches):
        for batch in batches:
            listed = batch.column(batch.num_columns - 1)
            flat = listed.flatten()
            lines = {f.name: flat.field(i).to_numpy(zero_copy_only=False) for i, f in enumerate(flat.type)}
            plain = lines["group"] < len(SCRIPTS)
            filled = lines["filled"]
            words = np.rint(filled / np.exp(lines["phrase"].astype(np.float64)))
            junk = lines["item"] | tail_lines(lines, table.value, plain, words)
            row = np.repeat(np.arange(len(batch)), np.diff(listed.offsets.to_numpy()))
            per = lambda x: np.bincount(row, weights=x, minlength=len(batch))  # noqa: B023, E731
            with np.errstate(divide="ignore", invalid="ignore"):
                share = per(np.where(junk, filled, lines["cover"])) / per(filled)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(batch.num_columns - 1)), pa.array(share, pa.float64(), mask=~np.isfinite(share))], names)

    schema = "id bigint, lang string, script string, n_chars bigint, n_words bigint, n_lines bigint, " + ", ".join(f"{x} double" for x in STATISTICS)
    out = stats.mapInArrow(run, schema)
    junk = F.coalesce((F.col("n_chars") >= MIN_CHARS) & (F.col("junk_share") > least), F.lit(False))
    return out.withColumn("is_junk", junk)


def flagged(docs: DataFrame, words: list[tuple[str, str | None]], id_col: str = "doc_id", text_col: str = "text", tail: float = 2.0) -> DataFrame:
    """All statistics with the robust z-score of each, `is_junk` and `in_tail`.

    A document is in the tail if it is junk and its share of such text is also `tail` robust deviations above its
    language's median, which nothing is where lists and tables are common.
    """
    languages = Languages(words)
    scored = stage(judged(docs, words, id_col, text_col), "judged")
    table = quartile_table(sketch_quantiles(scored.where(F.col("n_chars") >= MIN_CHARS), STATISTICS), languages, STATISTICS)
    spark = docs.sparkSession
    # a row per language
    rows = [(name, *(None if np.isnan(v) else float(v) for v in table[i].ravel())) for i, name in enumerate(languages.names)]
    columns = [f"__{c}_{round(q * 100)}" for c in STATISTICS for q in RANKS]
    groups = spark.createDataFrame(rows, "lang string, " + ", ".join(f"{c} double" for c in columns))
    joined = scored.join(F.broadcast(groups), "lang", "left")
    scores = []
    for c in STATISTICS:
        low, mid, high = (F.col(f"__{c}_{round(q * 100)}") for q in RANKS)
        side = F.greatest(F.least(high - mid, mid - low), F.lit(0.03))
        scores.append(((F.col(c) - mid) / (side / 0.6745)).alias(f"{c}_z"))
    in_tail = F.coalesce(F.col("is_junk") & (F.col("junk_share_z") >= tail), F.lit(False))
    return joined.select("id", "lang", *FIELDS, *scores, "is_junk").withColumn("in_tail", in_tail).withColumnRenamed("id", id_col)
