"""Problem 10: reading level of each document, from an ordinal regression on hand grades.

Features over the whole text: lengths (sentences, words, text), lexical diversity (distinct words in scripts that part them, distinct 5-grams in
others, for the length), word rarity (share and rank of common words), connectives and clause-depth proxies
(subordinators, commas, brackets and compounds a sentence). The model is a proportional-odds regression
with ridge penalty; raters get penalised offsets of their own, which the estimate leaves out. It is fitted
on the driver on at most `MAX_GRADES` grades, the first ones by a hash of document and rater; scoring
runs over all documents.

Cases: null, empty and blank texts, and texts without letters, have null level; null grades, grades of
unknown documents and repeated grades are left out; without any grade the fit raises ValueError.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sastra.functions.text import valid
from sastra.llm import textops
from sastra.llm.quality import BLANK, DIGIT, LETTER, SCRIPTS, WordMarks, _sum, char_table, folded, role_table, row_starts
from sastra.plans.stage import stage

MAX_GRADES = 20_000
LEVELS = 5

# Words that join clauses, and words that open subordinate ones.
CONNECTIVES = "and but or so because if when while although however therefore then than និង ប៉ុន្តែ ហើយ ឬ ព្រោះ ដើម្បី ដូចជា តែ ក៏ et mais ou donc car quand si comme alors và nhưng hoặc vì nếu khi để แต่ และ หรือ เพราะ ถ้า ก็ 和 但是 因为 所以 如果 就 也".split()
SUBORDINATORS = "that which who whose where whom ដែល ពេល កាល បើ que qui dont où mà rằng ที่ ซึ่ง ว่า 把 被 让".split()

NAMES = ["sentence", "word", "long", "common", "rank", "connective", "subordinate", "comma", "bracket", "diversity", "length", "digits", "compound"]


#: Bits of the words: common ones by rank (below 8, below 20, others), connectives, subordinators.
RANKS, CONNECTIVE, SUBORDINATOR = ((1, 8), (2, 20), (4, 1 << 30)), 8, 16


def known_words(words: list[tuple[str, int]]) -> WordMarks:
    bits: dict[str, int] = {}
    for w, rank in words:
        bits[w] = bits.get(w, 0) | next((b for b, most in RANKS if rank < most), RANKS[-1][0])
    for w in CONNECTIVES:
        bits[w] = bits.get(w, 0) | CONNECTIVE
    for w in SUBORDINATORS:
        bits[w] = bits.get(w, 0) | SUBORDINATOR
    return WordMarks(bits)


def raw_features(flat: np.ndarray, offsets: np.ndarray, grams_share: np.ndarray, known: WordMarks) -> tuple[np.ndarray, np.ndarray]:
    """The features of each folded text (rows) and its number of letters."""
    n = len(flat)
    a, b = offsets[:-1], offsets[1:]
    kind, role = char_table()[flat], role_table()[flat]
    letter = kind == LETTER
    letters = _sum(letter, a, b).astype(float)
    some = np.maximum(letters, 1)
    inside = kind != BLANK
    first = row_starts(offsets, n)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:]
    words = np.maximum(_sum(begins, a, b), 1)
    mark = (role & 1 > 0) | (flat == 10)
    stop = mark.copy()
    stop[1:] &= ~mark[:-1] | first[1:]
    sentences = np.maximum(_sum(stop, a, b), 1).astype(float)
    ends = np.flatnonzero(letter & ~np.concatenate((letter[1:] & ~first[1:], [False]))) if n else np.zeros(0, np.int64)
    starts = np.flatnonzero(letter & (first | ~np.concatenate(([False], letter[:-1])))) if n else np.zeros(0, np.int64)
    long = np.zeros(n, bool)
    long[starts[(ends - starts + 1) >= 9]] = True
    run = np.zeros(n, bool)
    run[starts] = True
    marks = known.marks(flat, kind, offsets)
    covered = marks & 7 > 0
    weight = np.zeros(len(a))
    for value, (bit, _) in enumerate(RANKS, 1):
        weight += value * _sum(marks & bit > 0, a, b)
    shared = np.maximum(_sum(covered, a, b), 1)
    joins, subs = marks & CONNECTIVE > 0, marks & SUBORDINATOR > 0
    comma = np.isin(flat, [44, 0xFF0C, 0x3001, 59, 0xFF1B, 0x17D6])
    bracket = np.isin(flat, [40, 0xFF08, 0xAB, 0x201C, 0x300C, 34])
    hyphen = flat == 45
    out = np.stack(
        [
            np.log1p(letters / sentences),
            np.log1p(letters / words),
            _sum(long, a, b) / np.maximum(_sum(run, a, b), 1),
            _sum(covered & letter, a, b) / some,
            weight / shared,
            _sum(joins, a, b) / some,
            _sum(subs, a, b) / some,
            np.log1p(_sum(comma, a, b) / sentences),
            np.log1p(_sum(bracket, a, b) / sentences),
            grams_share,
            np.log1p(letters),
            _sum(kind == DIGIT, a, b) / some,
            _sum(hyphen, a, b) / words,
        ],
        axis=1,
    )
    return out, letters


def word_diversity(flat: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Distinct runs of letters to the root of twice their number: a share that doesn't fall with the length of the text."""
    n = len(offsets) - 1
    letter = kind == LETTER
    edge = np.ones(len(flat), bool)
    edge[1:] = ~letter[:-1]
    edge |= row_starts(offsets, len(flat))
    start = np.flatnonzero(letter & edge)
    if not len(start):
        return np.zeros(n)
    run = np.cumsum(letter & edge) - 1
    place = np.arange(len(flat)) - start[np.maximum(run, 0)]
    cells = np.where(letter, textops.mix64(flat.astype(np.uint64) | (place.astype(np.uint64) << np.uint64(21))), np.uint64(0))
    words = np.add.reduceat(cells, start)
    row = np.searchsorted(offsets, start, side="right") - 1
    order = np.lexsort((words, row))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (words[order][1:] != words[order][:-1]) | (row[order][1:] != row[order][:-1])
    distinct, number = np.bincount(row[order][fresh], minlength=n), np.bincount(row, minlength=n)
    return distinct / np.sqrt(2.0 * np.maximum(number, 1))


def scripts_of(flat: np.ndarray, offsets: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """0 for Latin and others, 1, 2, ... by the order of SCRIPTS."""
    row = textops.rows_of(offsets)
    out = np.zeros(len(letters), np.int64)
    for i, (lo, hi) in enumerate(SCRIPTS.values(), 1):
        out[np.bincount(row[(flat >= lo) & (flat < hi)], minlength=len(letters)) > letters / 2] = i
    return out


def feature_rows(docs: DataFrame, words: list[tuple[str, int]], id_col: str = "doc_id", text_col: str = "text", score=None) -> DataFrame:
    """(id, script, x) of each text with letters, or, with `score`, (id, level, expected) of every text."""

    def run(batches):
        known = known_words(words)
        for batch in batches:
            texts = batch.column(1)
            for s, e in textops.chunks(texts):
                whole, places = textops.codepoints(texts.slice(s, e - s))
                flat, offsets = folded(whole, places)
                _, starts = textops.grams(flat, offsets)
                kind = char_table()[flat]
                script = scripts_of(flat, offsets, _sum(kind == LETTER, offsets[:-1], offsets[1:]))
                share = np.where(script == 0, word_diversity(flat, offsets, kind), np.diff(starts) / np.maximum(np.diff(offsets) - textops.GRAM + 1, 1))
                x, letters = raw_features(flat, offsets, share, known)
                ids, some = batch.column(0).slice(s, e - s), letters > 0
                if score is None:
                    keep = pa.array(some)
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32()), pa.array(x.ravel()))
                    yield pa.RecordBatch.from_arrays([ids, pa.array(script, pa.int32()), lists], ["id", "script", "x"]).filter(keep)
                else:
                    chances = score.chances(x, script)
                    yield pa.RecordBatch.from_arrays([ids, pa.array(chances.argmax(1) + 1, pa.int32(), mask=~some), pa.array(chances @ np.arange(1, LEVELS + 1), pa.float64(), mask=~some)], ["id", "level", "expected"])

    schema = "id bigint, script int, x array<double>" if score is None else "id bigint, level int, expected double"
    return docs.select(F.col(id_col).cast("bigint").alias("id"), valid(text_col).alias("text")).mapInArrow(run, schema)


@dataclass
class OrdinalModel:
    """Proportional odds: P(level <= k) = sigmoid(cut_k - z w)."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cuts: np.ndarray

    @staticmethod
    def design(z: np.ndarray, script: np.ndarray) -> np.ndarray:
        """The standard features, and a copy for each script, so that scripts can differ."""
        groups = len(SCRIPTS) + 1
        one = np.concatenate([np.ones((len(z), 1)), z], axis=1)
        own = np.zeros((len(z), groups, one.shape[1]))
        own[np.arange(len(z)), script] = one
        return np.concatenate([z, own.reshape(len(z), -1)], axis=1)

    def chances(self, x: np.ndarray, script: np.ndarray) -> np.ndarray:
        score = self.design((x - self.mean) / self.scale, script) @ self.weights
        below = 1 / (1 + np.exp(-np.clip(self.cuts[None, :] - score[:, None], -30, 30)))
        return np.diff(below, axis=1, prepend=0.0, append=1.0)


def fit_ordinal(x: np.ndarray, script: np.ndarray, grade: np.ndarray, rater: np.ndarray, ridge: float = 3.0, steps: int = 400) -> OrdinalModel:
    """Penalised maximum likelihood by gradient steps with momentum (Adam); deterministic."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    base = OrdinalModel.design((x - mean) / scale, script)
    names, who = np.unique(rater, return_inverse=True)
    one_hot = np.eye(len(names))[who]
    d = np.concatenate([base, one_hot], axis=1)
    y = grade.astype(int) - 1
    share = np.clip(np.cumsum(np.bincount(y, minlength=LEVELS)) / len(y), 0.005, 0.995)[:-1]
    cuts = np.log(share / (1 - share))
    theta = np.concatenate([np.zeros(d.shape[1]), [cuts[0]], np.log(np.maximum(np.diff(cuts), 0.05))])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    penalty = np.concatenate([np.full(d.shape[1], ridge), np.zeros(LEVELS - 1)])
    k = d.shape[1]
    for step in range(1, steps + 1):
        c = theta[k] + np.concatenate([[0.0], np.cumsum(np.exp(theta[k + 1 :]))])
        s = d @ theta[:k]
        wide = np.concatenate([[-1e3], c, [1e3]])
        hi, lo = wide[y + 1] - s, wide[y] - s
        f = lambda t: 1 / (1 + np.exp(-np.clip(t, -35, 35)))
        fh, fl = f(hi), f(lo)
        p = np.maximum(fh - fl, 1e-9)
        gh, gl = fh * (1 - fh) / p, fl * (1 - fl) / p
        grad = np.concatenate([-(d.T @ (-(gh - gl))), np.zeros(LEVELS - 1)])
        gc = np.zeros(LEVELS - 1)
        for j in range(LEVELS - 1):
            gc[j] = -(gh[y == j].sum() - gl[y == j + 1].sum())
        grad[k] = gc.sum()
        e = np.exp(theta[k + 1 :])
        for j in range(LEVELS - 2):
            grad[k + 1 + j] = e[j] * gc[j + 1 :].sum()
        grad += penalty * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta = theta - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    c = theta[k] + np.concatenate([[0.0], np.cumsum(np.exp(theta[k + 1 :]))])
    return OrdinalModel(mean, scale, theta[: base.shape[1]], c)


def graded_features(docs: DataFrame, grades: DataFrame, words: list[tuple[str, int]]) -> DataFrame:
    """(id, rater, grade, script, x): the features of graded documents, at most `MAX_GRADES` rows."""
    known = grades.where(F.col("grade").between(1, LEVELS) & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("bigint").alias("id"), F.coalesce("rater", F.lit("")).alias("rater"), "grade").distinct()
    # staged, so that the planner knows how small the grades are when they meet the documents
    bounded = stage(known.orderBy(F.xxhash64("id", "rater"), "id", "rater", "grade").limit(MAX_GRADES), "grades")
    ids = bounded.select(F.col("id").alias("doc_id")).distinct()
    rows = feature_rows(docs.join(ids, "doc_id", "left_semi"), words)
    return bounded.join(rows, "id")


def graded(docs: DataFrame, grades: DataFrame, words: list[tuple[str, int]]) -> tuple[np.ndarray, ...]:
    """Documents, features, scripts, grades and raters of at most `MAX_GRADES` grades, in a fixed order."""
    rows = graded_features(docs, grades, words).orderBy("id", "rater", "grade").collect()
    if not rows:
        raise ValueError("no graded document")
    return tuple(np.array([r[c] for r in rows]) for c in ("id", "x", "script", "grade", "rater"))


def train(docs: DataFrame, grades: DataFrame, words: list[tuple[str, int]]) -> OrdinalModel:
    return fit_ordinal(*graded(docs, grades, words)[1:])


def fold_of(ids: np.ndarray, folds: int) -> np.ndarray:
    """The fold of each document, by a hash of its id: all grades of a document are in one fold."""
    return (textops.mix64(ids.astype(np.uint64)) % np.uint64(folds)).astype(int)


def cross_validated(docs: DataFrame, grades: DataFrame, words: list[tuple[str, int]], folds: int = 5) -> DataFrame:
    """(fold, grades, mean_error, within_one, correlation) on documents that the model of the fold hasn't seen, and fold null for all.

    mean_error: mean difference of the expected from the given grade; within_one: share of grades at most one level
    from the likeliest. Folds without grades, or without others to fit on, are left out.
    """
    ids, x, script, grade, rater = graded(docs, grades, words)
    fold = fold_of(ids, folds)
    level, expected = np.zeros(len(ids)), np.full(len(ids), np.nan)
    for f in range(folds):
        held = fold == f
        if held.any() and not held.all():
            chances = fit_ordinal(x[~held], script[~held], grade[~held], rater[~held]).chances(x[held], script[held])
            level[held], expected[held] = chances.argmax(1) + 1, chances @ np.arange(1, LEVELS + 1)
    rows = []
    for f in (*range(folds), None):
        some = ~np.isnan(expected) & ((fold == f) | (f is None))
        if some.any():
            varied = some.sum() > 1 and grade[some].std() > 0 and expected[some].std() > 0
            rows.append((f, int(some.sum()), float(np.abs(expected[some] - grade[some]).mean()), float((np.abs(level[some] - grade[some]) <= 1).mean()), float(np.corrcoef(expected[some], grade[some])[0, 1]) if varied else None))
    return docs.sparkSession.createDataFrame(rows, "fold int, grades int, mean_error double, within_one double, correlation double")


def reading_levels(docs: DataFrame, grades: DataFrame, words: list[tuple[str, int]], id_col: str = "doc_id") -> DataFrame:
    """(id, level, expected): the likeliest grade of 1 to 5 and the expected grade of every document."""
    return feature_rows(docs, words, id_col, score=train(docs, grades, words)).withColumnRenamed("id", id_col)
