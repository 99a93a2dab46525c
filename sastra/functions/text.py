"""Text expressions. All run as built-in expressions; only NFC needs Python, for the rows that may need it.

Java's \\w, \\s and \\d differ from what corpora of combining scripts need, so classes are spelled out; and
loops over alternatives are possessive, since the regex engine recurses otherwise and overflows on long
runs of marks.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Characters of the script whose share is measured: the Khmer blocks.
KHMER = "ក-៿᧠-᧿"
#: All white space, as Unicode and the information separators have it.
BLANKS = "\t-\r\x1c-\x20\x85\xa0  -     　"

# Classes of Khmer characters by their place in a cluster.
BASE = "ក-ឳ"
COENG = "្"
ROBAT = "៌"
SHIFTERS = "៉៊"
VOWELS = "ា-ៅ"
ABOVE = "ំ-ៈ"
OTHER = "់៍-៑៓៝"
MARKS = f"{COENG}{ROBAT}{SHIFTERS}{VOWELS}{ABOVE}{OTHER}"

TERMINATORS = "។៕!?"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is evaluated once, however often the body refers to it."""
    return F.transform(F.array(value), body)[0]


def valid(c: str | Column) -> Column:
    """Bytes that are no UTF-8 as replacement characters, so that Python can read the text."""
    return F.make_valid_utf8(_c(c))


def _listed(ranges: str) -> str:
    """The characters of a class of ranges."""
    spread = re.sub("(.)-(.)", lambda m: "".join(map(chr, range(ord(m[1]), ord(m[2]) + 1))), ranges, flags=re.S)
    return "".join(dict.fromkeys(spread))


def strip(c: str | Column) -> Column:
    """Without white space at both ends; only these are looked at."""
    return F.trim(_c(c), F.lit(_listed(BLANKS)))


def _number_of(c: str | Column, kind: str) -> Column:
    """How many characters are of a class: the length without the runs of all others. (A count of matches makes an array of them all.)"""
    return F.length(F.regexp_replace(_c(c), f"[^{kind}]++", ""))


def script_ratio(c: str | Column, script: str = KHMER) -> Column:
    """Share of the script among letters (its digits, marks and signs count as letters); 0 without any."""
    counts = F.struct(_number_of(c, rf"\p{{L}}{script}").alias("letters"), _number_of(c, script).alias("own"))
    return let(counts, lambda n: F.when(n["letters"] == 0, F.lit(0.0)).otherwise(n["own"] / n["letters"]))


def contains_script(c: str | Column, script: str = KHMER) -> Column:
    return _c(c).rlike(f"[{script}]")


def symbol_ratio(c: str | Column, script: str = KHMER) -> Column:
    """Share of non-blank characters that are neither letters nor digits nor of the script; 1 without any."""
    counts = F.struct(F.length(F.regexp_replace(_c(c), f"[{BLANKS}]++", "")).alias("filled"), _number_of(c, rf"\p{{L}}\p{{N}}{script}").alias("words"))
    return let(counts, lambda n: F.when(n["filled"] == 0, F.lit(1.0)).otherwise((n["filled"] - n["words"]) / n["filled"]))


def filled_lines(c: str | Column) -> Column:
    """The lines that hold more than blanks, as stored."""
    return F.filter(F.split(_c(c), "\n"), lambda x: x.rlike(f"[^{BLANKS}]"))


def repetition_ratio(c: str | Column) -> Column:
    """Share of the commonest line among the filled lines; 0 for fewer than two.

    Equal lines are neighbours after a sort within the row, so one fold finds the longest run.
    """
    lines = filled_lines(c)
    start = F.struct(F.lit(None).cast("string").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(s: Column, x: Column) -> Column:
        run = F.when(x == s["last"], s["run"] + 1).otherwise(1)
        return F.struct(x.alias("last"), run.alias("run"), F.greatest(s["best"], run).alias("best"))

    most = F.aggregate(F.array_sort(lines), start, step, lambda s: s["best"])
    return F.when(F.size(lines) < 2, F.lit(0.0)).otherwise(most / F.size(lines))


def sentences(c: str | Column) -> Column:
    """Pieces after each terminator and at line ends, stripped, without empty ones."""
    return F.filter(F.transform(F.split(_c(c), f"(?<=[{TERMINATORS}])|\n+"), strip), lambda x: x != "")


def inner_paragraphs(c: str | Column) -> Column:
    """Pieces between blank lines, stripped, without empty ones."""
    return F.filter(F.transform(F.split(_c(c), f"\n[{BLANKS}]*\n"), strip), lambda x: x != "")


def paragraphs(c: str | Column) -> Column:
    """Pieces between blank lines, stripped; the whole text if that leaves none."""
    parts = inner_paragraphs(c)
    return F.when(F.size(parts) > 0, parts).otherwise(F.array(_c(c)))


@F.pandas_udf(StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


#: What NFC can change: marks that compose or change places, and characters with canonical singletons.
_MAY_CHANGE = (
    "[̀-ͯ̀́ʹ;·֑-߿ऀ-෿่-๋ຸ-໋ༀ-႟ᄀ-ᇿ፝-፟៝ᨗ-᳿᷀-᷿"
    "ά-῿  ⃐-⃿ΩKÅ〈〉⫝̸〪-゚꙯-꯿豈-﫿יִ-ﭏ︠-︯\U00010000-\U0001efff\U0002f800-\U0002fa1d]"
)


def nfc(c: str | Column) -> Column:
    """Canonical composition. Only texts that it may change reach Python; the others pass as nulls."""
    return F.coalesce(_nfc(F.when(_c(c).rlike(_MAY_CHANGE), _c(c))), _c(c))


_CLUSTER = f"{ROBAT}*+(?:{COENG}.)*+[{SHIFTERS}]*+[{VOWELS}]*+[{ABOVE}]*+[{OTHER}]*+(?:{COENG}\\z)?"
_IN_ORDER = f"(?s)^(?:[^{BASE}]++|[{BASE}]{_CLUSTER}(?![{MARKS}]))*+\\z"


def reorder_clusters(c: str | Column) -> Column:
    """Each Khmer cluster's marks in storage order: ROBAT, subscripts, shifters, vowels, signs, others.

    A subscript (COENG and the character after it) is one unit; units of one rank keep their order. Most texts are
    in order already, which one pass over them shows.
    """
    return let(_c(c), lambda t: F.when(t.rlike(_IN_ORDER), t).otherwise(_reordered(t)))


def _reordered(c: Column) -> Column:
    tokens = F.regexp_extract_all(c, F.lit(f"(?s)[{BASE}](?:{COENG}.|[{MARKS}])*+|[^{BASE}]++"), F.lit(0))

    def ranked(token: Column) -> Column:
        units = F.regexp_extract_all(token.substr(F.lit(2), F.length(token)), F.lit(f"(?s){COENG}.|."), F.lit(0))
        order = F.transform(
            units,
            lambda u, i: F.struct(
                F.when(F.length(u) > 1, 2).when(u == ROBAT, 1).when(u.rlike(f"[{SHIFTERS}]"), 3).when(u.rlike(f"[{VOWELS}]"), 4).when(u.rlike(f"[{ABOVE}]"), 5).otherwise(6).alias("rank"), i.alias("i"), u.alias("u")
            ),
        )
        return F.concat(token.substr(1, 1), F.array_join(F.transform(F.array_sort(order), lambda x: x["u"]), ""))

    fixed = F.transform(tokens, lambda t: F.when(t.rlike(f"(?s)^[{BASE}]") & ~t.rlike(f"(?s)^.{_CLUSTER}\\z"), ranked(t)).otherwise(t))
    return F.array_join(fixed, "")


def even_blanks(c: str | Column) -> Column:
    """Zero-width joiners and spaces out, no-break spaces plain, runs of blanks and of line ends short."""
    # whole-character replacements by bytes: most texts have none of them
    t = F.replace(_c(c), F.lit("\u00a0"), F.lit(" "))
    for joiner in "\u200b\u200c\u200d":
        t = F.replace(t, F.lit(joiner), F.lit(""))
    t = F.regexp_replace(t, "[ \t]{2,}+|\t", " ")
    # runs are one blank by now
    t = F.replace(F.replace(t, F.lit(" \n"), F.lit("\n")), F.lit("\n "), F.lit("\n"))
    return F.regexp_replace(t, "\n{3,}", "\n\n")


def normalize(c: str | Column) -> Column:
    """The canonical form: NFC, even blanks, cluster order, stripped. The steps' order matters.

    Composition comes before joiners go, so a letter and accent that a joiner parts compose on a second call only.
    """
    return strip(reorder_clusters(even_blanks(nfc(c))))


def strip_markup(c: str | Column) -> Column:
    """Tags, style declarations, entities and addresses as single blanks, in that order."""
    t = F.regexp_replace(_c(c), "<[^>]+>", " ")
    # possessive and only at the start of a word: a failure is then not tried again from inside the word
    t = F.regexp_replace(t, rf"(?<![\p{{L}}\p{{N}}_])[\p{{L}}\p{{N}}_][\p{{L}}\p{{N}}_-]*+[{BLANKS}]*+:[{BLANKS}]*[^;{{}}]++;", " ")
    t = F.regexp_replace(t, r"&(?:[a-zA-Z]+|#\p{Nd}+);", " ")
    return F.regexp_replace(t, f"https?://[^{BLANKS}]+", " ")


def clean_text(c: str | Column) -> Column:
    return normalize(strip_markup(c))


def char_shingles(c: str | Column, k: int = 5) -> Column:
    """The distinct k-grams of code points, line feeds as blanks; a text of up to k characters is its own.

    One regex pass with look-ahead, which also takes a character so that it never stops inside a surrogate
    pair; substring per position would scan the text for each.
    """
    t = F.replace(_c(c), F.lit("\n"), F.lit(" "))
    return F.when(F.length(t) <= k, F.array(t)).otherwise(F.array_distinct(F.regexp_extract_all(t, F.lit(f"(?s)(?=(.{{{k}}}))."), F.lit(1))))


def est_tokens(chars: Column) -> Column:
    """A third of the characters, one at least."""
    return F.greatest(F.lit(1), F.floor(chars / 3)).cast("bigint")


def url_host(c: str | Column) -> Column:
    return F.try_parse_url(_c(c), F.lit("HOST"))


def once(c: str | Column) -> Column:
    """The same value, as a generator of one row: later steps then refer to it.

    Without such a barrier the optimizer copies an expression into each place that uses it, and regular
    expressions within higher-order functions are then run once per copy.
    """
    return F.explode(F.array(_c(c)))


def uniform(seed: int, *keys: Column) -> Column:
    """A number in [0, 1) that depends on the keys only, not on partitions: for reproducible sampling."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in keys])), 1, 12), 16, 10).cast("double") / F.lit(float(16**12))
