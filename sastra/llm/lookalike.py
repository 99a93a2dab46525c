"""Problem 7: one consistent form of texts that look alike but are stored in other characters.

Per text: ignorable characters go, compatibility decomposition (full-width forms, ligatures, fraction
signs), marks of Khmer and Thai clusters in one order, runs of blanks and line breaks as one blank,
canonical composition. Tokens that hold Greek, Cyrillic or Armenian letters are then read as a lattice: each
letter may stand for any letter that looks like it, and Viterbi takes the path with the best character
bigram score, where paths pay for each change of script. The bigram counts come from all documents; their
number is bounded by the alphabets (`ALPHABET` squared), whatever the corpus.

Cases: null text has a null form; empty and blank texts have the empty form; texts under 25 code points
are in no pair; extra columns are passed over.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sastra.functions.text import valid
from sastra.llm import textops
from sastra.plans.stage import stage

MIN_CHARS = 25
#: Texts, or copies of one text, that meet others within one task.
BLOCK = 1000

# Characters that show nothing.
_IGNORABLE = re.compile("[­͏؜ᅟᅠ឴឵᠋-᠏​-‏‪-‮⁠-⁯ㅤ︀-️﻿ﾠ\U000e0000-\U000e0fff]+")

# Latin letters and the Greek, Cyrillic and Armenian letters of the same shape.
_SHAPES = """
A Α А
B Β В
C Ϲ С
E Ε Е
F Ϝ
G Ԍ
H Η Н
I Ι І Ӏ
J Ϳ Ј
K Κ К
M Μ М
N Ν
O Ο О Օ
P Ρ Р
Q Ԛ
S Ѕ Տ
T Τ Т
U Ս
V Ѵ
W Ԝ
X Χ Х
Y Υ Ү
Z Ζ
a а
c ϲ с
d ԁ
e е
g ց
h һ հ
i і
j ϳ ј
l ӏ
n ո
o ο о օ
p р
q ԛ զ
s ѕ
u ս
v ν ѵ
w ԝ
x х
y у
""".split("\n")

LATIN, GREEK, CYRILLIC, ARMENIAN = 0, 1, 2, 3
#: Code points of the four alphabets that the bigram table covers.
ALPHABET = 0x590


@lru_cache(1)
def shapes() -> dict[str, list[tuple[str, int]]]:
    """The letters, with their scripts, that each letter may stand for."""
    out: dict[str, list[tuple[str, int]]] = {}
    for line in _SHAPES:
        same = [(c, script_of(c)) for c in line.split()]
        out |= {c: same for c, _ in same}
    return out


def script_of(c: str) -> int:
    o = ord(c)
    return GREEK if 0x370 <= o < 0x400 else CYRILLIC if 0x400 <= o < 0x530 else ARMENIAN if 0x530 <= o < 0x590 else LATIN


_OTHER_SCRIPT = re.compile("[Ͱ-֏]")
_TOKEN = re.compile("[^\\W\\d_฀-๿ក-៿]+(?:[̀-ͯ]+[^\\W\\d_฀-๿ក-៿]*)*")

#: Log-score that a path pays where neighbouring letters are of two scripts.
SWITCH = -12.0


class Lattice:
    """Viterbi over the look-alikes of a token, scored by smoothed bigram counts."""

    def __init__(self, counts: np.ndarray):
        self.log = np.log(counts + 0.02)
        self.total = np.log(counts.sum(axis=1) + 0.02 * 60)
        self.known: dict[str, str] = {}

    def score(self, a: str, b: str) -> float:
        x, y = min(ord(a), ALPHABET - 1), min(ord(b), ALPHABET - 1)
        return self.log[x, y] - self.total[x] if x else self.log[0, y] - self.total[0]

    def best(self, token: str) -> str:
        found = self.known.get(token)
        if found is not None:
            return found
        table = shapes()
        paths: list[tuple[float, str, str, int]] = [(0.0, "", "\0", -1)]
        for c in token:
            if 0x300 <= ord(c) < 0x370:
                paths = [(s, t + c, last, script) for s, t, last, script in paths]
                continue
            step = []
            for option, script in table.get(c, [(c, script_of(c))]):
                step.append(max((s + self.score(last, option) + (SWITCH if before not in (-1, script) else 0.0), t + option, option, script) for s, t, last, before in paths))
            paths = step
        if len(self.known) > 200_000:
            self.known.clear()
        ends = [(s + self.score(last, "\0"), t) for s, t, last, _ in paths]
        out = self.known[token] = max(ends)[1]
        return out


# Khmer clusters: ranks of marks in storage order (fixed by the script's encoding).
_BASE = "ក-ឳ"
_MARK = "ា-៑៓៝"
_CLUSTER = re.compile(f"[{_BASE}](?:្[{_BASE}]|[{_MARK}្])+")
_UNIT = re.compile(f"្[{_BASE}]|.", re.S)
#: Cheap sign that some cluster needs work: a mark before one of lower rank, or two-part vowels.
_DISORDER = re.compile("[ា-ៈ់៍-៑៓៝][្៉៊៌ា-ៅ]|[ំ-ៈ់៍-៑][ា-ៈ]|[៉៊][្៌]|្[ដរ]")
_THAI = re.compile("[ัิ-ฺ็-๎]{2,}")


def _unit_rank(unit: str) -> tuple[int, str]:
    if unit[0] == "្":
        return (2 if unit[1:] != "រ" else 3, "")
    if unit == "៌":
        return (1, "")
    if unit in "៉៊":
        return (4, unit)
    if "ា" <= unit <= "ៅ":
        return (5, unit)
    if unit in "ំះៈ":
        return (6, unit)
    return (7, unit)


@lru_cache(200_000)
def _ordered(cluster: str) -> str:
    units = sorted(_UNIT.findall(cluster[1:]), key=_unit_rank)
    marks = "".join("្ត" if u == "្ដ" else u for u in units)
    marks = marks.replace("ាេ", "ោ").replace("េា", "ោ").replace("ីេ", "ើ").replace("េី", "ើ")
    return cluster[0] + marks


def plain_form(text: str) -> str:
    """The text without the lattice: ignorables, compatibility, cluster order, blanks, composition."""
    if _IGNORABLE.search(text):
        text = _IGNORABLE.sub("", text)
    if not text.isascii():
        if not unicodedata.is_normalized("NFKD", text):
            text = unicodedata.normalize("NFKD", text)
        if _DISORDER.search(text):
            text = _CLUSTER.sub(lambda m: _ordered(m.group()), text)
        if _THAI.search(text):
            text = _THAI.sub(lambda m: "".join(sorted(m.group())), text)
        text = text.replace("เเ", "แ")
    return " ".join(text.split())


def finish(text: str, lattice: Lattice | None) -> str:
    if lattice is not None and _OTHER_SCRIPT.search(text):
        text = _TOKEN.sub(lambda m: lattice.best(m.group()) if _OTHER_SCRIPT.search(m.group()) else m.group(), text)
    return text if text.isascii() else unicodedata.normalize("NFC", text)


@lru_cache(1)
def letters() -> np.ndarray:
    """Which code points below ALPHABET are letters."""
    return np.array([chr(i).isalpha() for i in range(ALPHABET)])


def letter_bigrams(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Counts of neighbouring letters (word ends as 0) of the four alphabets over all documents."""

    def run(batches):
        total = np.zeros(ALPHABET * ALPHABET, np.int64)
        for batch in batches:
            column = batch.column(0)
            for a, b in textops.chunks(column):
                flat, offsets = textops.codepoints(column.slice(a, b - a))
                if len(flat) < 2:
                    continue
                small = np.minimum(flat, ALPHABET - 1)
                code = np.where(letters()[small] & (flat < ALPHABET), flat, 0).astype(np.int64)
                pairs = code[:-1] * ALPHABET + code[1:]
                total += np.bincount(pairs[pairs > 0], minlength=ALPHABET * ALPHABET)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["pair", "n"])

    rows = docs.select(valid(text_col).alias("text")).mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    out = np.zeros(ALPHABET * ALPHABET, np.int64)
    for row in rows.toLocalIterator():
        out[row.pair] = row.n
    return out.reshape(ALPHABET, ALPHABET).astype(np.float64)


def one_form(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, text_key, form): stored length, hash of the stored text, and the consistent form."""
    counts = docs.sparkSession.sparkContext.broadcast(letter_bigrams(docs, text_col))

    def run(batches):
        lattice = Lattice(counts.value)
        for batch in batches:
            forms = [None if t is None else finish(plain_form(t), lattice) for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(forms, pa.string())], ["id", "n_chars", "text_key", "form"])

    source = docs.select(F.col(id_col).cast("bigint").alias("id"), F.length(text_col).alias("n_chars"), F.unhex(F.md5(text_col)).alias("text_key"), valid(text_col).alias("text"))
    return source.mapInArrow(run, "id bigint, n_chars int, text_key binary, form string")


def _every_pair(keyed: DataFrame) -> DataFrame:
    """(doc_id_a, doc_id_b) of all pairs of (id, text_key, key) with one key and two texts.

    Distinct texts are paired first, in blocks by text, and then the copies of both, in blocks by id: so
    equal copies never meet each other, and a hot form spreads over blocks.
    """
    texts = keyed.groupBy("key", "text_key").agg(F.count(F.lit(1)).alias("n"))
    forms = texts.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), blocks(n) - 1))
    several = stage(texts.join(forms, "key"), "texts").withColumn("own", F.pmod(F.xxhash64("text_key"), blocks("m")).cast("int"))
    a = several.select("key", F.col("text_key").alias("ka"), F.col("n").alias("na"), F.col("own").alias("i"), each("m").alias("j"))
    b = several.select("key", F.col("text_key").alias("kb"), F.col("n").alias("nb"), each("m").alias("i"), F.col("own").alias("j"))
    met = a.join(b, ["key", "i", "j"]).where("ka < kb").select("ka", "kb", "nb", each("na").alias("pa")).select("ka", "kb", "pa", each("nb").alias("pb"))
    copies = keyed.join(several.select("text_key", "n"), "text_key").groupBy("text_key", F.pmod(F.xxhash64("id"), blocks("n")).cast("int").alias("part")).agg(F.collect_list("id").alias("ids"))
    copies = stage(copies, "copies")
    every = met.join(copies.toDF("ka", "pa", "xs"), ["ka", "pa"]).join(copies.toDF("kb", "pb", "ys"), ["kb", "pb"])
    pairs = every.select(F.explode("xs").alias("x"), "ys").select("x", F.explode("ys").alias("y"))
    return pairs.select(F.least("x", "y").alias("doc_id_a"), F.greatest("x", "y").alias("doc_id_b"))


def same_to_the_eye(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id_a, doc_id_b): documents of one form whose stored texts differ, the smaller id first.

    All pairs, whatever the group's size; see `_every_pair`.
    """
    return _every_pair(stage(one_form(docs, id_col, text_col).where(F.col("n_chars") >= MIN_CHARS).select("id", "text_key", F.unhex(F.md5("form")).alias("key")), "keyed"))
