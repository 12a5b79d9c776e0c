import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from gridtally.llm import quality
from gridtally.llm.words import Scan

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(text):
    text = text or ""
    words = WORD.findall(text)
    lines = text.split("\n")
    dup = sum(bool(WORD.search(x)) and x in lines[:i] for i, x in enumerate(lines))
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return (len(words), sum(map(len, words)), symbols, dup, len(covered))


TEXTS = [
    None, "", " \n\t", "a", "é" * 30, "a b c d e f g h " * 3, "x\n\nx\n \nx", "a\x0bb\x1cc d",
    "one two three four five six seven eight nine ten " * 4 + "#*$", "| a | b |\n" * 5, "\n", "z\n" * 40,
]


def run(spark, texts, model=None):
    docs = spark.createDataFrame(
        [(i, t, True) for i, t in enumerate(texts)], "doc_id long, text string, kept boolean"
    )
    return {r.doc_id: r for r in quality.assess(docs, model or quality.fit([])).collect()}


def test_counts_equal_brute_force(spark):
    rows = run(spark, TEXTS)
    for i, text in enumerate(TEXTS):
        r = rows[i]
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == by_hand(text), text
        assert r.base_failed == (got[0] < 20 or 100 * got[4] > 30 * got[0])
        assert not (r.base_failed and r.kept)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab |#\n\té\x0b", max_size=60), min_size=1, max_size=5))
def test_scan_equals_brute_force(texts):
    scan = Scan([t.encode() for t in texts])
    assert scan.per_doc(scan.word_doc).tolist() == [len(WORD.findall(t)) for t in texts]
    assert len(scan.line_end) == sum(len(t.split("\n")) for t in texts)


def test_viterbi_equals_enumeration():
    rng = np.random.default_rng(3)
    step = rng.normal(size=(2, 2))
    doc = np.array([0, 0, 0, 0, 2, 3, 3, 3])
    score = rng.normal(size=(8, 2))
    got = quality.viterbi(score, doc, step)
    for d in (0, 2, 3):
        at = np.flatnonzero(doc == d)

        def value(labels):
            return sum(score[i, y] for i, y in zip(at, labels)) + sum(
                step[a, b] for a, b in zip(labels, labels[1:])
            )

        every = [[(n >> k) & 1 for k in range(len(at))] for n in range(2 ** len(at))]
        assert value(got[at]) == max(map(value, every))


def test_field_tells_content_from_boilerplate(spark):
    good = "the cat sat on the mat and looked at all the birds in the tree. "
    lines = [f"{good}number {i} is here now as well." for i in range(4)]
    bad = ["home | about | shop | help | cart | login | terms | more | less | top | end | x" + str(i) for i in range(4)]
    docs = spark.createDataFrame(
        [(i, "\n".join(f"{x} {i}" for x in (lines if i % 2 else bad))) for i in range(60)], "doc_id long, text string"
    )
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(40)] + [(None, 1), (41, None)], "doc_id long, quality int"
    )
    model = quality.train(docs, labels)
    content = {r.doc_id: 2 * r.content_words >= r.n_words for r in quality.assess(docs, model).collect()}
    assert content == {i: bool(i % 2) for i in range(60)}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.assess(docs, quality.train(docs, labels)).count() == 0
