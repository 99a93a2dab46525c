"""Problem 5: sentence units of texts in any language and script.

Each line is cut by a semi-Markov dynamic programme. Its possible ends are the runs of marks (with the
closing quotes behind them) and the end of the line; a path is a sequence of whole spans, and a span's
score joins its closing word and mark, the opening word of what follows, the balance of its quotations, and
its length. So whether a closed quotation ends a unit depends on where that unit began.

The scores of words and lengths come from a `Model`, counted over the whole corpus without marked sentences:
lines give certain openings, closings and lengths, the words within lines and before small letters give the
contrary; regularised log-odds of the two are the scores. Its tables have a fixed size. What remains is fixed:
which marks there are, abbreviations, and the weights of the parts.

Marks are compared after one-to-one folding of full-width forms, and characters that show nothing are
looked through, so neither changes a boundary. Positions are 1-based code points of the stored text. The
word before a mark counts by its last 48 characters.

The best path is exact however many possible ends a span holds: a span's score depends on where it begins
only by the class of its length and by its quotation, so one beginning for each class is enough.

Cases: null, empty and blank texts have no units; very long lines are cut with all their marks; repeated
rows give repeated units; without a corpus the model is neutral.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import deque
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sastra.functions.text import valid

#: A span's length class is the number of doublings; weights of the length's and the words' log-odds.
CLASSES, LENGTH_WEIGHT = 18, 0.25
#: Possible ends of a line up to which each start is tried for each end.
FEW = 12
#: Cells of the tables of words, and the counts that each log-odds is drawn to nothing by.
CELLS, PRIOR = 1 << 17, 2.0

_NOTHING = "­​-‏‪-‮⁠-⁤﻿"
_LINE = re.compile("[^\n\r\x85  ]+")
_OPEN, _CLOSE = "“«「『‘‹", "”»」』’›"
# The marks that end sentences whatever follows, of scripts without capitals, and the others.
_FINAL = "។៕៚。।॥؟۔։።፧။"
_END = f".!?…{_FINAL}"
_MARKS = re.compile(f"[{_END}]+(?:[{_NOTHING}]*[{_END}])*")
_CLOSERS = re.compile(f"(?:[{_NOTHING}]*[”»」』’›\"'）)\\]])+(?:[{_NOTHING}]*[{_END}])*")
_SPACED_CLOSER = re.compile(f"[    {_NOTHING}]+[»”\"]")

# What is written before a dot that ends nothing: titles and other words before a name or number, and the rest.
_ABBREVIATIONS = frozenset(
    "dr mr mrs ms prof st no nos vol fig p pp art env approx ca cf vs v ed eds rev gen col sgt capt lt gov sen rep hon corp dept est tel ext ave blvd rd "
    "jan feb mar apr jun jul aug sep sept oct nov dec mm mme mlle mgr m me chap tél av bd ex tp ts ths gs pgs bs th sra dra ud uds ดร นาย นพ พญ รศ ผศ ศ".split()
)
# Abbreviations that may also stand last in a sentence, and titles behind or before a name.
_MAY_END = frozenset("a.m p.m etc inc ltd co corp".split())
_BOTH_SIDES = frozenset("jr sr".split())
# Words that open sentences when they have a capital, counted as openings before any text is read.
_OPENERS = "The It He She They This That These Those We You There But However Il Elle Ils Elles Nous Vous Les Ella Ellos".split()
# What goes on with a sentence after a closed quotation.
_FOLLOWING = re.compile("[,;:，、；：)\\]–—-]")

_FOLD = {0xFF01 + i: 0x21 + i for i in range(94)} | {0xFF61: 0x3002, 0x00A0: 0x20, 0x202F: 0x20, 0x2007: 0x20, 0x3000: 0x20}


@lru_cache(1)
def _nothing() -> re.Pattern:
    return re.compile(f"[{_NOTHING}]+")


def _quotes(line: str) -> dict[int, int]:
    """Where each closed quotation of the line closes, by where it opens."""
    out: dict[int, int] = {}
    stack: list[tuple[str, int]] = []
    straight = -1
    for m in re.finditer(f"[{_OPEN}{_CLOSE}\"]", line):
        c, i = m.group(), m.start()
        if c == '"':
            if straight < 0:
                straight = i
            else:
                out[straight] = i
                straight = -1
        elif c in _OPEN:
            stack.append((c, i))
        elif c == "’" and not any(o == "‘" for o, _ in stack):
            continue  # an apostrophe
        else:
            want = _OPEN[_CLOSE.index(c)]
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == want:
                    out[stack[k][1]] = i
                    del stack[k:]
                    break
    return out


def _kind(c: str) -> str:
    if not c:
        return ""
    if c.isdigit():
        return "9"
    if c.isupper():
        return "A"
    if c.islower():
        return "a"
    return "L" if c.isalpha() else c


_WORD = re.compile("[A-Za-zÀ-ɏͰ-ϿЀ-ԯḀ-ỿ]+")


def _cell(word: str) -> int:
    return zlib.crc32(word.encode()) & (CELLS - 1)


class Counts:
    """Counts of one task: words that open lines, capital words within them, words before the dot of a line's end, words
    before a dot and a small letter; and the lengths of whole sentences by class."""

    def __init__(self):
        self.words = np.zeros((4, CELLS), np.int64)
        self.lengths = np.zeros(CLASSES, np.int64)

    def add(self, text: str) -> None:
        cells: list[list[int]] = [[], [], [], []]
        for m in _LINE.finditer(text):
            line = m.group().strip()
            inner = _MARKS.search(line)
            if inner and len(line) - inner.end() <= 1:
                self.lengths[length_class(len(line))] += 1
            first = True
            for w in _WORD.finditer(line):
                word, end = w.group(), w.end()
                if word[0].isupper():
                    if first:
                        cells[0].append(_cell(word))
                    elif line[w.start() - 1] == " " and line[w.start() - 2].isalpha():
                        cells[1].append(_cell(word))
                first = False
                if line[end : end + 1] == ".":
                    if end + 1 == len(line):
                        cells[2].append(_cell(word.lower()))
                    elif line[end + 1] == " " and line[end + 2 : end + 3].islower():
                        cells[3].append(_cell(word.lower()))
        for i, found in enumerate(cells):
            if found:
                np.add.at(self.words[i], found, 1)


def length_class(length: int) -> int:
    return min(CLASSES - 1, max(length, 1).bit_length() - 1)


class Model:
    """Regularised log-odds of opening words, closing words and length classes."""

    def __init__(self, words: np.ndarray, lengths: np.ndarray):
        words = words.astype(np.float64)
        words[0, [_cell(w) for w in _OPENERS]] += 10 * PRIOR
        odds = lambda yes, no: np.log((yes + PRIOR) / (no + PRIOR))
        self.opening, self.closing = odds(words[0], words[1]), odds(words[2], words[3])
        chance = np.log((lengths + 1.0) / (lengths.sum() + CLASSES))
        usual = chance.max()
        self.length = (np.clip(chance - usual, -8, 0) * LENGTH_WEIGHT).tolist() if lengths.sum() else [0.0] * CLASSES

    @staticmethod
    def neutral() -> Model:
        return Model(np.zeros((4, CELLS)), np.zeros(CLASSES))

    def opens(self, word: str) -> float:
        return float(self.opening[_cell(word)]) if word and word[0].isupper() else 0.0

    def closes(self, word: str) -> float:
        return float(self.closing[_cell(word)]) if word else 0.0


def fit(docs: DataFrame, text_col: str = "text") -> Model:
    """The model of all texts: tables of fixed size from each task, added up on the cluster in parts."""
    size = 4 * CELLS // PARTS

    def count(batches):
        counts = Counts()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.add(text)
        parts = [zlib.compress(x.astype(np.int64).tobytes(), 1) for x in (*counts.words.reshape(PARTS, size), counts.lengths)]
        yield pa.RecordBatch.from_arrays([pa.array(range(PARTS + 1), pa.int32()), pa.array(parts, pa.binary())], ["part", "counts"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(zlib.decompress(x), np.int64) for x in pdf["counts"])
        return pd.DataFrame({"part": pdf["part"].iloc[:1], "counts": [zlib.compress(total.tobytes(), 1)]})

    rows = docs.select(valid(text_col).alias("text")).where("text is not null").mapInArrow(count, "part int, counts binary").withColumn("lane", F.floor(F.spark_partition_id() / 32))
    sums = rows.groupBy("part", "lane").applyInPandas(add, "part int, counts binary").groupBy("part").applyInPandas(add, "part int, counts binary")
    found = {r.part: np.frombuffer(zlib.decompress(r.counts), np.int64) for r in sums.toLocalIterator()}
    if not found:
        return Model.neutral()
    return Model(np.concatenate([found[i] for i in range(PARTS)]).reshape(4, CELLS), found[PARTS])


def _closing(before: str, marks: str, after: str, follow: str, spaced: bool, model: Model, opening: str) -> float:
    """Log-odds that a sentence ends at a run of marks, from its marks, the word before and what follows."""
    kind = _kind(follow)
    if any(c in _FINAL for c in marks):
        # the sign "and so on" is written between two of these marks
        if "។" in marks and (before.endswith("។ល") or (after.startswith("ល។") and marks == "។")):
            return -20.0
        return 8.0
    if marks == ".":
        if not spaced and kind not in ("", *"“«「『\""):
            return -20.0 if kind in "9aALក" or follow in "/@_-" else -8.0
        word = re.search(r"[^\s\"“”«»()（）「」]*$", before).group()
        last = word.rsplit(".", 1)[-1]
        low = word.lower()
        parts = [x for x in word.split(".") if x]
        dotted = "." in word and all(len(x) <= 2 and not x.isnumeric() and x.isalnum() for x in parts) and any(x[0].isalpha() for x in parts)
        # a word that opens sentences and isn't found within them
        opens = kind == "A" and model.opens(opening) > OPENS
        if not word:
            return -8.0 if kind == "9" else -1.0
        if low in _BOTH_SIDES:
            return 5.0 if opens else -8.0
        if low in _MAY_END:
            return 5.0 if kind in ("A", "L", *"“«「『\"") else -8.0
        if dotted:
            return 5.0 if opens and word[0].isascii() else -12.0
        if low in _ABBREVIATIONS or last.lower() in _ABBREVIATIONS and "." in word:
            return -10.0
        if len(last) == 1 and last.isalpha():
            return 2.0 if kind == "" or opens and last.isascii() else -8.0
        if not last.isascii() and re.fullmatch("[ក-៿]{1,2}|[฀-๿]{1,2}", last):
            return -6.0
        if kind == "a":
            return -6.0
        if kind == "9":
            return 1.5
        # a word that is seen before dots within sentences only is an abbreviation
        return 6.0 + 3.0 * min(0.0, model.closes(last.lower()) + 1.0)
    if marks.strip(".…") == "":
        # an ellipsis ends a sentence where a capital follows
        return 3.0 if kind in ("A", *"“«「『\"") else -6.0
    return -6.0 if kind == "a" else 7.0


#: From which log-odds on a word opens sentences.
OPENS = 2.0
#: Parts in which the tables of words are added up.
PARTS = 16


def line_ends(line: str, model: Model | None = None) -> list[int]:
    """The ends (exclusive offsets) of the units of one line that isn't blank."""
    model = model or _neutral()
    line = line.translate(_FOLD)
    right = len(line)
    blank = lambda c: c.isspace() or _nothing().match(c)
    while right and blank(line[right - 1]):
        right -= 1
    left = 0
    while left < right and blank(line[left]):
        left += 1
    if left >= right:
        return []
    # end, log-odds, the place of the opening quote that closes there or -1, what follows
    ends: list[tuple[int, float, int, str]] = []
    pairs = None
    for m in _MARKS.finditer(line, left, right):
        if pairs is None:
            pairs = _quotes(line)
            opened = {c: o for o, c in pairs.items()}
        end = m.end()
        closer = _CLOSERS.match(line, end)
        if closer is None and (s := _SPACED_CLOSER.match(line, end)) and s.end() - 1 in opened:
            closer = s
        quote = -1
        if closer:
            end = closer.end()
            for i in range(closer.start(), end):
                if i in opened:
                    quote = opened[i]
            if quote < 0 and not any(c in closer.group() for c in ")）]'") and '"' in closer.group():
                end = m.end()  # a straight quote that opens
        end = min(end, right)
        at = end
        while at < right and blank(line[at]):
            at += 1
        if at >= right:
            break
        follow = line[at]
        marks = _nothing().sub("", m.group())
        score = _score(line, m.start(), m.end(), marks, follow, at, any(c.isspace() for c in line[end:at]), model)
        if quote >= 0 and _FOLLOWING.match(follow):
            score = min(score, 0.0) - 12.0
        if any(o < end <= c for o, c in pairs.items()):
            score -= 20.0
        ends.append((end, score, quote, _kind(follow)))
    if not ends:
        return [right]
    # best[i]: score of the best path whose last span ends at end i; the line's end is the last.
    starts = [left]
    for end, *_ in ends:
        at = end
        while at < right and blank(line[at]):
            at += 1
        starts.append(at)
    n = len(ends) + 1
    best, back = [0.0] + [-math.inf] * n, [0] * (n + 1)
    begun: dict[int, list[int]] = {}
    for j, at in enumerate(starts):
        begun.setdefault(at, []).append(j)
    # Ends and starts only grow, so each start passes from one length class to the next, and the starts of a class
    # differ in their best score only: a queue with falling scores keeps the maximum of each class.
    classes: list[deque[int]] = [deque() for _ in range(CLASSES if n > FEW else 0)]
    passed = [0] * (CLASSES + 1)  # how many starts have come to each class
    for k in range(1, n + 1):
        end, score, quote, kind = ends[k - 1] if k < n else (right, 0.0, -1, "")
        tried = range(k) if n <= FEW else _tried(classes, passed, best, starts, begun.get(quote, ()), end, k)
        for j in tried:
            s = best[j] + score + model.length[length_class(end - starts[j])]
            if k < n and quote >= 0 and quote != starts[j]:
                s -= 4.0 if kind == "A" else 16.0  # a quotation that opened in mid-sentence
            if s > best[k]:
                best[k], back[k] = s, j
    out, k = [right], back[n]
    while k:
        out.append(ends[k - 1][0])
        k = back[k]
    return out[::-1]


def _tried(classes: list[deque[int]], passed: list[int], best: list[float], starts: list[int], same: tuple | list, end: int, k: int) -> list[int]:
    """The starts that may be best for an end: one of each length class, and those where its quotation opens."""
    for c in range(CLASSES):
        queue, most = classes[c], k if c == 0 else passed[c - 1]
        while passed[c] < most and (c == 0 or end - starts[passed[c]] >= 1 << c):
            while queue and best[queue[-1]] < best[passed[c]]:
                queue.pop()
            queue.append(passed[c])
            passed[c] += 1
    tried = {j for j in same if j < k}
    for c in range(CLASSES):
        queue, gone = classes[c], passed[c + 1] if c + 1 < CLASSES else 0
        while queue and queue[0] < gone:
            queue.popleft()
        if queue:
            tried.add(queue[0])
    return sorted(tried)


def _clean(line: str, end: int) -> str:
    return _nothing().sub("", line[max(0, end - 48) : end])


def _score(line: str, start: int, end: int, marks: str, follow: str, at: int, spaced: bool, model: Model) -> float:
    opening = _WORD.match(line, at)
    return _closing(_clean(line, start), marks, _nothing().sub("", line[end : end + 8]), follow, spaced, model, opening.group() if opening else "")


@lru_cache(1)
def _neutral() -> Model:
    return Model.neutral()


def unit_ends(text: str | None, model: Model | None = None) -> list[int]:
    """1-based positions of the last characters of the text's units."""
    out: list[int] = []
    for m in _LINE.finditer(text or ""):
        out.extend(m.start() + e for e in line_ends(m.group(), model))
    return out


def sentence_ends(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Model | None = None) -> DataFrame:
    """(id, end_pos): one row per sentence unit of each text; the model of these texts unless another is given."""
    known = docs.sparkSession.sparkContext.broadcast(model or fit(docs, text_col))

    def run(batches):
        for batch in batches:
            found = [unit_ends(t, known.value) for t in batch.column(1).to_pylist()]
            ids = pa.array([i for i, ends in zip(batch.column(0).to_pylist(), found) for _ in ends], batch.column(0).type)
            yield pa.RecordBatch.from_arrays([ids, pa.array([e for ends in found for e in ends], pa.int32())], [id_col, "end_pos"])

    return docs.select(F.col(id_col).cast("bigint").alias(id_col), valid(text_col).alias("__text")).where("__text is not null").mapInArrow(run, f"{id_col} bigint, end_pos int")


def sentence_units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Model | None = None) -> DataFrame:
    """(id, n, unit): the units of each text in order, n from 1, without the blanks around them; `model` as in `sentence_ends`."""
    known = docs.sparkSession.sparkContext.broadcast(model or fit(docs, text_col))

    def run(batches):
        for batch in batches:
            ids, number, units = [], [], []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n = 0
                for m in _LINE.finditer(t):
                    a = 0
                    for e in line_ends(m.group(), known.value):
                        n += 1
                        ids.append(i)
                        number.append(n)
                        units.append(m.group()[a:e].strip())
                        a = e
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(number, pa.int32()), pa.array(units, pa.string())], [id_col, "n", "unit"])

    return docs.select(F.col(id_col).cast("bigint").alias(id_col), valid(text_col).alias("__text")).where("__text is not null").mapInArrow(run, f"{id_col} bigint, n int, unit string")
