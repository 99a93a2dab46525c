"""The operators of the training-data problems against brute force and fixed cases."""

import math
import random
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
import regex

from sastra.llm import lines, lookalike, mixing, neardup, overlap, quality, reading, sentences, textops, tokens
from sastra.llm.pretokenize import pieces_of
from sastra.llm.vocab import PrefixEncoder, TrieCounter, read_ranks

PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RANKS = f"{tokens.TOKENIZERS}/byte_bpe_50k.tiktoken"


def frame(spark, texts, more=""):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")


def edited(rng, text, n):
    for _ in range(n):
        i = rng.randrange(len(text))
        text = text[:i] + rng.choice("abcdefghij ") + text[i + rng.randint(0, 1) :]
    return text


def jaccard(a, b):
    g = lambda t: {t[i : i + 5] for i in range(len(t) - 4)}
    a, b = g(a.replace("\n", " ")), g(b.replace("\n", " "))
    return len(a & b) / max(1, len(a | b))


# Shared ------------------------------------------------------------------------------------------


def test_codepoints_and_grams():
    texts = ["abcdefg", None, "", "abcabcabc", "កខគ😀ឃង" * 3, "abcd"]
    flat, offsets = textops.codepoints(pa.array(texts).slice(0))
    assert [textops.as_text(flat[a:b]) for a, b in zip(offsets[:-1], offsets[1:])] == [t or "" for t in texts]
    flat2, offsets2 = textops.codepoints(pa.array(["skip", *texts]).slice(1))
    assert (flat == flat2).all() and (offsets == offsets2).all()
    _, starts = textops.grams(flat, offsets)
    assert np.diff(starts).tolist() == [len({(t or "")[i : i + 5] for i in range(len(t or "") - 4)}) for t in texts]
    sizes = [e - s for s, e in textops.chunks(pa.array(["x" * 50] * 10), 100)]
    assert sum(sizes) == 10 and max(sizes) == 2


# Tokens ------------------------------------------------------------------------------------------


def test_pieces_equal_the_pattern():
    rng = random.Random(6)
    whole = regex.compile(PATTERN)
    for _ in range(8000):
        text = "".join(rng.choice("ab's rtvelmd  \n\t1២ក្ា.,! 　é😀") for _ in range(rng.randint(0, 12)))
        assert pieces_of(text) == whole.findall(text)


@pytest.fixture(scope="module")
def ranks():
    with open(RANKS, "rb") as f:
        return read_ranks(f.read())


def test_encoder_equals_plain_merges_and_library(ranks, spark):
    import tiktoken

    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdeioxyz្កខ ាé0123!?") for _ in range(rng.randint(0, 18))) for _ in range(400)]
    words += ["", None, "hello hello", "<|endoftext|>", "a" * 300, "x" * 9000 + " y", " \n \n", "ប្រទេសកម្ពុជា" * 40]
    got = {r.doc_id: r.ids for r in tokens.encode_corpus(frame(spark, words)).collect()}
    assert got == {i: library.encode_ordinary(w or "") for i, w in enumerate(words)}
    counts = {r.doc_id: r.n_tokens for r in tokens.token_counts(frame(spark, words), exact=True).collect()}
    assert counts == {i: len(x) for i, x in got.items()}


def test_encoder_appends_and_reencodes(ranks):
    encoder = PrefixEncoder(ranks)
    last = encoder.extend(b"internation", [])
    assert encoder.unwind(encoder.extend(b"internationalise", list(last))) == encoder.encode(b"internationalise")
    assert encoder.unwind(encoder.reencode(b"internation", last, b"internal")) == encoder.encode(b"internal")


def test_trie_counts_longest_matches(ranks):
    small = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"abc": 257, b"bcd": 258, b"cdcd": 259}
    counter = TrieCounter(small)

    def naive(piece):
        n = 0
        while piece:
            piece = piece[max(k for k in range(1, 6) if piece[:k] in small) :]
            n += 1
        return n

    rng = random.Random(8)
    for _ in range(2000):
        piece = bytes(rng.choice(b"abcde") for _ in range(rng.randint(0, 12)))
        assert counter.count(piece) == naive(piece)


def test_counts_keep_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b", 5, "x")], "id bigint, text string, n_tokens bigint, c0 string")
    assert tokens.token_counts(df).first().asDict() == {"id": 1, "text": "a b", "c0": "x", "n_tokens": 2}
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert tokens.encode_corpus(empty).count() == 0


def test_budget_adds_up(spark):
    rows = [("s", "KM", "https://A.example/x", "CC0 ", "a b c"), ("s", None, None, None, None), (None, "khm", "bad url", "cc0", "")]
    df = spark.createDataFrame(rows, "source string, lang string, url string, license string, text string")
    got = [r.asDict() for r in tokens.token_budget(df).collect()]
    for name in ("source", "lang", "domain", "source+license", "lang+license", "domain+license"):
        assert sum(r["tokens"] for r in got if r["slice"] == name) == 3 and sum(r["docs"] for r in got if r["slice"] == name) == 3
    assert {(r["lang"], r["docs"]) for r in got if r["slice"] == "lang"} == {("km", 2), (None, 1)}


# Near duplicates -----------------------------------------------------------------------------------


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(9)
    texts = []
    for size in (25, 27, 30, 40, 80, 200, 600, 1500):
        base = "".join(rng.choice("abcdefghij ") for _ in range(size))
        texts += [base, base, base.replace(" ", "\n"), *(edited(rng, base, n) for n in (1, 2, max(1, size // 60), max(1, size // 40), size // 20)), base + base[:10]]
    texts += [None, "", "short", "x" * 24, "x" * 30, "x" * 40]
    want = {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if texts[i] and texts[j] and min(len(texts[i]), len(texts[j])) >= 25 and jaccard(texts[i], texts[j]) >= 0.8}
    found = neardup.NearDuplicates(frame(spark, texts))
    assert {tuple(r) for r in found.pairs().collect()} == want
    groups = {r.id: r for r in found.groups().collect()}
    assert set(groups) == {i for i, t in enumerate(texts) if t and len(t) >= 25}
    assert groups[1].class_id == 0 and groups[2].copies == 3
    for a, b in want:
        assert groups[a].group_id == groups[b].group_id
    assert neardup.NearDuplicates(frame(spark, texts).limit(0)).pairs().count() == 0


def test_bitmap_never_overstates_the_difference():
    rng = np.random.default_rng(10)
    for _ in range(300):
        a = rng.integers(0, 1 << 52, rng.integers(1, 400), dtype=np.uint64)
        b = np.concatenate([a[: rng.integers(0, len(a) + 1)], rng.integers(0, 1 << 52, rng.integers(0, 900), dtype=np.uint64)])
        exact = len(np.setxor1d(a, b))
        assert neardup.least_difference(neardup.parity_bitmap(np.unique(a)), neardup.parity_bitmap(np.unique(b))) <= exact


# Overlaps ------------------------------------------------------------------------------------------


def test_overlap_equals_brute_force(spark):
    rng = random.Random(11)
    rows = []
    for i in range(40):
        base = "".join(rng.choice("abcdefghijklm ") for _ in range(rng.choice([30, 60, 300])))
        rows += [("train", base), ("val", edited(rng, base, rng.randint(0, 1 + len(base) // 25))), ("test", f"<|ref|>{base[:20]}<|/ref|><|det|>[[1, 2]]<|/det|>\n<|ref|>{base[20:]}​<|/ref|>")]
    rows += [("train", rows[0][1])] * 3 + [("val", None), (None, rows[0][1]), ("val", ""), ("train", "tiny"), ("test", "tiny")]
    df = spark.createDataFrame([(i, s, "synthetic", a, "extra") for i, (s, a) in enumerate(rows)], "row_id bigint, split string, source string, answer string, term string")

    def plain(a):
        found = regex.findall(r"(?s)<\|ref\|>(.*?)<\|/ref\|>", a)
        return " ".join(regex.sub("[​-‍﻿]", "", " ".join(found) if found else a).split())

    texts = {i: (s, plain(a)) for i, (s, a) in enumerate(rows) if s and a and len(plain(a)) >= 25}
    want = {(min(i, j), max(i, j)) for i, (s, x) in texts.items() for j, (t, y) in texts.items() if s == "train" and t != "train" and jaccard(x, y) >= 0.8}
    found = overlap.SplitOverlap(df)
    assert {tuple(r) for r in found.pairs().collect()} == want
    # terms parted into blocks of a few evaluation texts
    sides = [r for r in texts.items() if r[1][0] == "train"], [r for r in texts.items() if r[1][0] != "train"]
    left, right = (spark.createDataFrame([(i, t) for i, (_, t) in side], "id bigint, text string") for side in sides)
    table = spark.sparkContext.broadcast(overlap.count_table(right))
    by = [{tuple(r) for r in overlap.cosine_candidates(left, right, table, 8 / 9, None, block).collect()} for block in (1000, 1)]
    assert by[0] == by[1] and {(min(p), max(p)) for p in by[0]} >= want
    report = {r.split: r for r in found.report().collect()}
    assert report["val"].rows == sum(s == "val" for s, _ in texts.values())
    assert overlap.SplitOverlap(df.where("split = 'val'")).pairs().count() == 0


def test_overlap_of_classes_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(overlap.classes.pairs_across, "__defaults__", (2,))
    base = "many rows read the same to the eye"
    df = spark.createDataFrame([(i, s, "x", base) for i, s in enumerate(["train"] * 7 + ["val"] * 5)], "row_id bigint, split string, source string, answer string")
    assert sorted(tuple(r) for r in overlap.SplitOverlap(df).pairs().collect()) == [(i, j) for i in range(7) for j in range(7, 12)]


def test_weighted_cosine_equals_brute_force(spark):
    rng = random.Random(21)
    rows = []
    for _ in range(30):
        base = "".join(rng.choice("abcdefg ") for _ in range(rng.choice([40, 200])))
        rows += [("train", base), ("val", edited(rng, base, rng.randint(0, 1 + len(base) // 12)))]
    df = spark.createDataFrame([(i, s, "x", a) for i, (s, a) in enumerate(rows)], "row_id bigint, split string, source string, answer string")
    texts = [" ".join(a.split()) for _, a in rows]
    sets = [textops.grams(*textops.codepoints(pa.array([t])))[0] for t in texts]
    counts = {}
    for (s, _), h in zip(rows, sets):
        for c in (h & np.uint64((1 << 22) - 1)).tolist() if s == "val" else ():
            counts[c] = counts.get(c, 0) + 1
    evals = sum(s == "val" for s, _ in rows)

    def weight(h):
        c = counts.get(int(h) & ((1 << 22) - 1), 0)
        return math.log1p(evals / max(2 ** (round(8 * math.log2(c + 1)) / 8) - 1, 0.5))

    vectors = [{int(h): weight(h) for h in hs} for hs in sets]
    norm = lambda v: math.sqrt(sum(w * w for w in v.values()))
    cos = lambda x, y: sum(w * w for h, w in x.items() if h in y) / norm(x) / norm(y)
    want = {}
    for j, (s, _) in enumerate(rows):
        scores = [(cos(vectors[i], vectors[j]), -i) for i, (t, _) in enumerate(rows) if t == "train"] if s != "train" else [(0, 0)]
        best = max((round(c, 9), i) for c, i in scores)
        if best[0] >= 0.7:
            want[j] = (-best[1], round(best[0], 6))
    got = {r.row_id: (r.partner, round(r.cosine, 6)) for r in overlap.weighted_overlap(df, cosine=0.7).collect()}
    assert got == want and 10 < len(want)


# Lines ---------------------------------------------------------------------------------------------


def test_lines_and_sequences(spark):
    docs = [("s", f"Home page\t{i}\nunique {chr(97 + i)} line\n(c) Site\nAll{chr(0xA0)} rights 20{i}\r\n123\n") for i in range(6)]
    docs += [("s", None), ("s", ""), ("s", "Home page 7\nx y"), ("t", "Home page 1\nz"), (None, "Home page 1")]
    df = spark.createDataFrame([(i, s, t, "k") for i, (s, t) in enumerate(docs)], "doc_id bigint, source string, text string, line_key string")
    found = lines.RepeatedLines(df)
    assert {(r.source, r.line_key, r.docs) for r in found.frequent_lines().collect()} == {("s", "Home page 0", 7), ("s", "(c) Site", 6), ("s", "All rights 0", 6)}
    sequences = {(tuple(r["lines"]), r.docs) for r in found.sequences().collect()}
    assert (("(c) Site", "All rights 0"), 6) in sequences and len(sequences) == 4
    pairs = {r.doc_id: r.text for r in found.cleaned(min_length=2).collect()}
    assert pairs[0] == "Home page\t0\nunique a line\n123\n" and pairs[8] == "Home page 7\nx y" and pairs[6] is None
    clean = {r.doc_id: r.text for r in found.cleaned().collect()}
    assert clean[0] == "unique a line\n123\n" and clean[6] is None and clean[9] == "Home page 1\nz" and clean[10] == "Home page 1"


# Sentences -----------------------------------------------------------------------------------------

CASES = {
    "Dr. Smith paid $3.50 at 5 a.m. near U.N. Plaza. He left!": ["Dr. Smith paid $3.50 at 5 a.m. near U.N. Plaza.", "He left!"],
    "We met at 7 p.m. Then we ate.": ["We met at 7 p.m.", "Then we ate."],
    'He said "stop now?" and left. See www.a.example today.': ['He said "stop now?" and left.', "See www.a.example today."],
    "ទិញ ។ល។ ផ្ទះ។ «ចង់ទៅ។» ល្អ “អី!” និង គោ។": ["ទិញ ។ល។ ផ្ទះ។", "«ចង់ទៅ។»", "ល្អ “អី!” និង គោ។"],
    "ឆ្នាំ១៩២១ គ.ស. និង ល.រ. ៥ ក.ជ.ប. គោ... មក។": ["ឆ្នាំ១៩២១ គ.ស. និង ល.រ. ៥ ក.ជ.ប. គោ... មក។"],
    "你好。他说“走！”就走了。真的？！": ["你好。", "他说“走！”就走了。", "真的？！"],
    "one\n\n  two \n": ["one", "two"],
    "The end... Next one. A word... goes on.": ["The end...", "Next one.", "A word... goes on."],
    "": [],
}


@pytest.mark.parametrize("text", CASES)
def test_sentences(text):
    ends = [0, *sentences.unit_ends(text)]
    assert [text[a:b].strip() for a, b in zip(ends, ends[1:])] == CASES[text]


def test_sentence_frames(spark):
    df = frame(spark, ["A. B​.\n", None, "  \n", "x" * 5000 + ". Y"])
    got = sorted(tuple(r) for r in sentences.sentence_ends(df).collect())
    assert got[-2:] == [(3, 5001), (3, 5003)] and not any(i in (1, 2) for i, _ in got)
    assert [r.unit for r in sentences.sentence_units(df).where("doc_id = 3").orderBy("n").collect()] == ["x" * 5000 + ".", "Y"]


# Look-alikes ---------------------------------------------------------------------------------------


def test_same_to_the_eye(spark):
    rng = random.Random(12)
    base = "The common people in the paddy road read ភ្នំពេញ ទាំងអស់ the old letters"
    variants = [
        base, base.replace("o", "о").replace("e", "е"), base.replace(" ", " "), "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else c for c in base),
        "﻿" + base.replace("pa", "p​a") + " \n", base.replace("ទាំង", "ទំាង"), base.replace(" ", "\r\n", 2),
    ]
    others = [base.replace("road", "rode"), base.replace(" ", "", 1), base.upper(), "short", "short ", None, "", " "]
    others += [" ".join(rng.choice("the common people paddy road read letters old".split()) for _ in range(12)) for _ in range(40)]
    got = {tuple(r) for r in lookalike.same_to_the_eye(frame(spark, variants + others)).collect()}
    n = len(variants)
    assert got == {(i, j) for i in range(n) for j in range(i + 1, n)}


def test_forms():
    f = lookalike.plain_form
    assert f("ﬁne­ ½") == "fine 1⁄2"
    assert unicodedata.normalize("NFC", f("é é")) == "é é"
    assert f("បងើ្ក") == f("បង្កើ") and f("កេា") == f("កោ")
    once = f("កំា น้ํา")
    assert f(once) == once


def test_lattice_keeps_real_cyrillic():
    counts = np.zeros((lookalike.ALPHABET, lookalike.ALPHABET))
    for word in ["москва"] * 50 + ["common", "cat", "moon"] * 50:
        for a, b in zip("\0" + word, word + "\0"):
            counts[ord(a), ord(b)] += 1
    lattice = lookalike.Lattice(counts)
    assert lattice.best("соmmon") == "common" and lattice.best("cօmmօո") == "common"
    assert lattice.best("москвa") == "москва"


# Statistics ----------------------------------------------------------------------------------------


def test_junk_and_prose(spark):
    words = [(w, "en") for w in "the of and to in a is that it for".split()] + [(w, "km") for w in "និង នៃ ដែល ជា នៅ ក្នុង".split()]
    prose = ["The people of the town went to the market in the morning, and it is said that they bought rice. " * 1 + f"Nobody knew why it was number {i} of the list." for i in range(60)]
    junk = ["\n".join(f"- item {chr(97 + i)}" for i in range(20)), "\n".join(f"| {i} | {i * 7} | {i * 9} |" for i in range(20)), "aaaa" * 40, "\n".join(["The same line is in the text."] * 12), "\n".join(f"#x{i} {{ margin: {i}px; color: red; }}" for i in range(12))]
    df = frame(spark, prose + junk + [None, "", "   ", "tiny"])
    got = {r.doc_id: r for r in quality.flagged(df, words).collect()}
    assert {i for i, r in got.items() if r.is_junk} == set(range(60, 65))
    assert got[65].n_chars == 0 and got[65].junk_share is None and len(got) == 69
    assert quality.flagged(df.limit(0), words).count() == 0


# Mixing --------------------------------------------------------------------------------------------


def test_route_meets_quotas_with_least_repeats():
    patterns = {("a",): 100, ("b",): 1000, ("a", "b"): 50}
    total, flows = mixing.route(patterns, {"a": 0.5, "b": 0.5}, {"a": 3, "b": 1})
    got = {s: sum(t for (p, u, x), t in flows.items() if x == s) for s in "ab"}
    assert got["a"] == got["b"] == total // 2 == 450
    assert max(u for (p, u, x) in flows if x == "b") == 1
    small, flows = mixing.route(patterns, {"a": 0.5, "b": 0.5}, {"a": 3, "b": 1}, total=200)
    assert small == 200 and max(u for _, u, _ in flows) == 1  # no repeats while there are enough
    assert mixing.route({}, {"a": 1.0}, {"a": 1}) == (0, {})
    # as much as there is: the small source is repeated to its cap and falls short
    total, flows = mixing.route(patterns, {"a": 0.5, "b": 0.5}, {"a": 3, "b": 1}, strict=False)
    got = {s: sum(t for (p, u, x), t in flows.items() if x == s) for s in "ab"}
    assert total == 1150 and got == {"a": 450, "b": 575} and max(u for _, u, x in flows if x == "a") == 3


def test_mixture(spark):
    rng = random.Random(13)
    docs = [(i, "big" if i % 4 else "small", " ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(rng.randint(20, 60)))) for i in range(400)]
    docs += [(900, "other", "alpha"), (901, "big", None), (902, None, "beta"), (903, "small", docs[0][2]), (904, "big", docs[0][2])]
    df = spark.createDataFrame(docs, "doc_id bigint, source string, text string")
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.5, 2), ("none", 0.1, 3)], "source string, target_share double, max_repeats int")
    chosen = mixing.mixture(df, targets).collect()
    assert all(r.repeats <= (1 if r.source == "big" else 2) for r in chosen) and {r.source for r in chosen} == {"big", "small"}
    shares = {r.source: r for r in mixing.mixture_shares(df, targets).collect()}
    assert abs(shares["big"].actual_share - 0.5) < 0.02 and shares["none"].tokens == 0
    assert sorted(map(tuple, chosen)) == sorted(map(tuple, mixing.mixture(df, targets).collect()))
    full = {r.source: r for r in mixing.mixture_shares(df, targets, strict=False).collect()}
    assert full["small"].most_repeats == 2 and full["small"].shortfall < 0.02 and full["none"].shortfall == 0.1


def test_mixture_with_few_patterns(spark, monkeypatch):
    records = spark.createDataFrame([("a", "x", 1, 10, "x"), ("b", "x", 2, 99, "x\ny"), ("b", "y", 3, 99, "x\ny"), ("c", "y", 4, 5, "y")], "cls string, source string, doc_id bigint, n_tokens bigint, pattern string")
    got = {(r.cls, r.source): r.pattern for r in mixing.bounded_patterns(records, 1).collect()}
    assert got == {("a", "x"): "x", ("b", "x"): "x\ny", ("b", "y"): "x\ny", ("c", "y"): "y"}
    more = records.union(spark.createDataFrame([("d", "x", 5, 7, "x\nz"), ("d", "z", 6, 7, "x\nz")], records.schema))
    got = {(r.cls, r.source): r.pattern for r in mixing.bounded_patterns(more, 1).collect()}
    assert got["d", "x"] == got["d", "z"] == "z" and got["b", "x"] == "x\ny" and len(got) == 6


def test_segments_are_repaired(spark):
    line = spark.createDataFrame([("p", c, n) for c, n in (("a", 50), ("b", 30), ("c", 21), ("d", 7))], "pattern string, cls string, n_tokens bigint")
    hit = spark.createDataFrame([("p", 1, "s", "a", 50), ("p", 2, "s", "a", 50), ("p", 2, "s", "d", 7)], "pattern string, use int, source string, cls string, n_tokens bigint")
    cuts = spark.createDataFrame([("p", 1, "s", 0, 70), ("p", 2, "s", 0, 51), ("p", 1, "t", 70, 108)], "pattern string, use int, source string, low bigint, high bigint")
    got = {(r.use, r.source, r.cls) for r in mixing.repaired(line, hit.select("pattern", "use", "source", "cls", "n_tokens"), cuts).collect()}
    assert got == {(1, "s", "a"), (1, "s", "c"), (1, "t", "b"), (2, "s", "a")}


# Reading level -------------------------------------------------------------------------------------


def test_reading_levels(spark):
    rng = random.Random(14)

    def text(level):
        return " ".join(" ".join(rng.choice(["dog", "cat", "run", "constitutional" if level > 3 else "sun"]) for _ in range(4 * level)) + "." for _ in range(12))

    docs = [(i, text(1 + i % 5)) for i in range(200)] + [(900, None), (901, ""), (902, "123 !")]
    grades = [(i, f"r{i % 3}", 1 + i % 5) for i in range(0, 200, 2)] + [(0, "r0", 1), (2, "r1", None), (5000, "r1", 3), (None, "r1", 3)]
    d, g = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(grades, "doc_id bigint, rater string, grade int")
    got = {r.doc_id: r for r in reading.reading_levels(d, g, [("the", 1), ("and", 2)]).collect()}
    held = [abs(got[i].expected - (1 + i % 5)) for i in range(1, 200, 2)]
    assert sum(held) / len(held) < 0.5 and got[900].level is None and got[902].expected is None
    with pytest.raises(ValueError):
        reading.reading_levels(d, g.limit(0), [("the", 1)])
    assert not math.isnan(got[0].expected)
    folds = reading.cross_validated(d, g, [("the", 1), ("and", 2)], 4).collect()
    assert folds[-1].fold is None and folds[-1].grades == sum(r.grades for r in folds[:-1]) == 100 and folds[-1].within_one > 0.9 and folds[-1].correlation > 0.8
    # all grades of a document are in one fold
    assert len(set(reading.fold_of(np.array([7, 7, 7]), 4))) == 1


def test_word_diversity():
    from sastra.llm.quality import char_table

    texts = ["a b a b", "ab ba", "x", "", "12 !"]
    flat, offsets = textops.codepoints(pa.array(texts))
    got = reading.word_diversity(flat, offsets, char_table()[flat])
    assert np.allclose(got, [2 / math.sqrt(8), 2 / math.sqrt(4), 1 / math.sqrt(2), 0, 0])
