"""Cases that bounds once cut short."""

import random
from collections import Counter
from itertools import combinations

from sastra.llm import lines, lookalike, neardup, quality, queries, sentences


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def eye_pairs(spark, texts):
    got = [tuple(r) for r in lookalike.same_to_the_eye(frame(spark, texts)).collect()]
    assert len(got) == len(set(got))
    return set(got)


def differing(texts):
    return {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if texts[i] != texts[j]}


def test_every_pair_of_a_large_form(spark):
    # more documents than the former bound of 2,000: many copies of one text and few of others
    base = "many documents read the same to the eye"
    texts = [base] * 2500 + [base + " " * k for k in (1, 2, 3)] + [base + "\n"] * 2
    assert eye_pairs(spark, texts) == differing(texts)


def test_every_pair_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(lookalike, "BLOCK", 3)
    base = "many documents read the same to the eye"
    texts = [base + " " * (i % 11) for i in range(60)] + [base] * 20
    assert eye_pairs(spark, texts) == differing(texts)


def test_junk_where_junk_is_common(spark):
    # half of a script group are lists, so its median share of them is high; each is judged by itself
    prose = [f"The people of the town went to the market in the morning, and it is said that they bought rice number {i}." for i in range(30)]
    lists = ["\n".join(f"- item {chr(97 + k)} {i}" for k in range(20)) for i in range(40)]
    got = quality.flagged(frame(spark, prose + lists), [(w, "en") for w in "the of to in and it is that".split()]).collect()
    assert {r.doc_id for r in got if r.is_junk} == set(range(30, 70))
    assert not any(r.in_tail for r in got)


def test_long_runs_of_marks_end_nothing(spark):
    for n in (10, 63, 64, 65, 300):
        text = "See version " + ".".join(["1"] * n) + " and it runs. Then " + " ".join(["3.14,"] * n) + " came. Last one"
        ends = sentences.unit_ends(text)
        assert ends == [text.index(" Then"), text.index(" Last"), len(text)]


def test_sequences_with_lines_between(spark, tmp_path):
    docs = [f"Head\nbody {chr(97 + i)}\nHead\nMore\n" + "x\n" * (i % 2) + f"text {chr(98 + i)}\nFoot" for i in range(6)]
    want = Counter()
    for text in docs:
        keys = [k for k in text.split("\n") if k in ("Head", "More", "Foot", "x")]
        want.update({c for n in range(1, len(keys) + 1) for c in combinations(keys, n)})
    want = {k: n for k, n in want.items() if n >= 4}
    spark.createDataFrame([("s", t) for t in docs], "source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.p4_sequences(spark, str(tmp_path)).collect()
    assert {tuple(r.lines): r.docs for r in got} == want and len(got) == len(want)
    assert ("Head", "Head", "More", "Foot") in want
    near = lines.RepeatedLines(spark.read.parquet(f"{tmp_path}/documents.parquet")).sequences().collect()
    assert {tuple(r.lines) for r in near} == {("Head",), ("More",), ("Foot",), ("Head", "More")}


def alike(texts):
    grams = [{t[i : i + 5] for i in range(len(t) - 4)} for t in texts]
    return {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if len(grams[i] & grams[j]) >= 0.8 * len(grams[i] | grams[j]) - 1e-9}


def test_hot_tiles_and_classes_lose_no_pair(spark, monkeypatch):
    # a family of edited copies, with exact copies among them, in tiles and classes far above the bounds
    rng = random.Random(3)
    base = "".join(rng.choice("abcdefghijkl ") for _ in range(400))
    texts = [base] * 9
    for _ in range(60):
        t = base
        for _ in range(rng.randint(1, 12)):
            i = rng.randrange(len(t))
            t = t[:i] + rng.choice("mnopq") * rng.randint(0, 6) + t[i + rng.randint(0, 3) :]
        texts += [t] * rng.randint(1, 3)
    want = alike(texts)
    for hot, block in ((400, 1000), (5, 4), (0, 2)):
        monkeypatch.setattr(neardup, "HOT", hot)
        monkeypatch.setattr(neardup, "BLOCK", block)
        got = [tuple(r) for r in neardup.NearDuplicates(frame(spark, texts)).pairs().collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_sketches_decide_what_is_junk(spark):
    # the same line of few common words is in the tail where its language's sentences are rich in them, and isn't where they are poor
    words = [(w, "en") for w in "the of to in and it is that".split()]
    line = "Garden stones keep warm through winter and dark wooden benches remain quietly outside"
    rich = [f"The people of the town went to the market in the morning and it is said that the rice of farm {chr(97 + i)} is in." for i in range(26)] * 2
    poor = [f"People from town {chr(97 + i)} walked over fields toward markets, and farmers sold ripe rice there every single morning." for i in range(26)] * 2
    for prose, want in ((rich, True), (poor, False)):
        got = {r.id: r.is_junk for r in quality.judged(frame(spark, [*prose, line]), words).collect()}
        assert got[len(prose)] == want and not any(got[i] for i in range(len(prose)))


def cut(text, model=None):
    ends = sentences.unit_ends(text, model)
    return [text[a:b].strip() for a, b in zip([0, *ends], ends)]


def test_marks_of_more_scripts_and_plain_cases():
    for units in (
        ["He paid $5.50.", "It was ok."], ["Vitamin C.", "It is good."], ["He lives in the U.S.", "The weather is fine."], ["El Sr. Pérez vino.", "Bien."],
        ["यह अच्छा है।", "वह गया।"], ["هل جئت؟", "نعم."], ["Ես եկա։", "Նա գնաց։"], ["ሰላም።", "ደህና ነኝ።"], ["We met J. Smith at 5 p.m. near U.N. Plaza.", "He left."],
    ):
        assert cut(" ".join(units)) == units
    assert len(cut("costs 3.14 and " * 1000)) == 1


def test_counted_words_decide():
    # a capital word that opens lines ends what stands before it; one found within lines doesn't
    opens = ["Garden work is hard.\nGarden days are long."] * 9 + ["we saw Marlow there.\nthen Marlow left."] * 9
    counts = sentences.Counts()
    for text in opens:
        counts.add(text)
    model = sentences.Model(counts.words, counts.lengths)
    assert cut("It came from the U.S. Garden work is hard.", model) == ["It came from the U.S.", "Garden work is hard."]
    assert cut("It came from the U.S. Marlow left.", model) == ["It came from the U.S. Marlow left."]
    # a word that stands before dots within sentences only
    counts = sentences.Counts()
    for _ in range(40):
        counts.add("the vlk. of it is far and the vlk. is near.")
    assert cut("they saw vlk. Marlow there.", sentences.Model(counts.words, counts.lengths)) == ["they saw vlk. Marlow there."]
    assert cut("they saw vlk. Marlow there.") == ["they saw vlk.", "Marlow there."]


def test_best_path_equals_all_paths(monkeypatch):
    # the queues by length class against a search of all paths, with scores that lengths and quotations move
    rng = random.Random(5)
    monkeypatch.setattr(sentences, "_score", lambda *a: 0.0)
    for round_ in range(60):
        monkeypatch.setattr(sentences, "FEW", 12 if round_ % 2 else 0)
        lengths = [-3.0 * rng.random() for _ in range(sentences.CLASSES)]
        model = sentences.Model.neutral()
        model.length = lengths
        line = "".join(rng.choice(["ab", "cde ", " ", "f. ", "g! ", "hijk lmno pqrs"]) for _ in range(14)) + "x"
        marks = [m.end() for m in sentences._MARKS.finditer(line) if line[m.end() :].strip()]
        left, right = len(line) - len(line.lstrip()), len(line)

        def total(ends):
            at, out = left, 0.0
            for e in ends:
                out += lengths[sentences.length_class(e - at)]
                at = e + len(line[e:]) - len(line[e:].lstrip()) if e < right else right
            return out

        best = max(total([*c, right]) for n in range(len(marks) + 1) for c in combinations(marks, n))
        assert abs(total(sentences.line_ends(line, model)) - best) < 1e-9


def test_words_end_with_their_text(spark):
    # texts in one batch, whose ends and beginnings would make other words together
    words = [("the", "en"), ("then", "en"), ("និង", "km")]
    texts = ["and the", "n so", "x និ", "ង y", "", "the"]
    got = [(r.n_words, r.n_lines, round(r.common_share * 7, 3) if r.common_share else r.common_share) for r in quality.document_statistics(frame(spark, texts).coalesce(1), words).orderBy("id").collect()]
    assert got == [(2, 1, 3.5), (2, 1, 0.0), (2, 1, 0.0), (2, 1, 0.0), (0, 0, None), (1, 1, 7.0)]
