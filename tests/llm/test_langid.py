import math
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridtally.llm import langid, queries

SF = "/root/testdata/sf0.01"
ENGLISH = ["the cat and the dog were with the others", "this thing is what they wanted"]
GERMAN = ["der hund und die katze waren mit den anderen", "das ist eine schöne straße über dem fluß"]
WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def corpus(spark):
    rows = [(i, t, lang, 0) for i, (t, lang) in enumerate([(t, "en") for t in ENGLISH * 9] + [(t, "de") for t in GERMAN * 9])]
    rows += [(900, "the und der and", None, 0), (901, None, "fr", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")


def words_of(text):
    return [w.translate(LOWER) for w in WORD.findall(text or "")]


def grams_of(word):
    """N-grams by length, of the word with a border on each side; a border alone is none."""
    framed = f" {word} "
    return [[g for i in range(len(framed) - n + 1) if (g := framed[i : i + n]) != " "] for n in range(1, 6)]


class ByHand:
    def __init__(self, rows):
        counts = {True: Counter(), False: Counter()}
        for text, lang in rows:
            if lang is None:
                continue
            for w in words_of(text):
                counts[True][lang, w] += 1
                for grams in grams_of(w):
                    counts[False].update((lang, g) for g in grams)
        self.langs = sorted({lang for lang, _ in counts[True]})
        self.tables = {}
        for is_word, counter in counts.items():
            total = Counter()
            for (_, key), n in counter.items():
                total[key] += n
            whole = {x: sum(n for (lang, _), n in counter.items() if lang == x) + 0.5 * len(total) for x in self.langs}
            self.tables[is_word] = {
                key: [math.log((counter[x, key] + 0.5) / whole[x]) for x in self.langs]
                for key, n in total.items()
                if n >= 3 or not is_word
            }

    def of_word(self, w):
        if w in self.tables[True]:
            return self.tables[True][w]
        for grams in reversed(grams_of(w)):
            known = [self.tables[False][g] for g in grams if g in self.tables[False]]
            if known:
                return [sum(x) / len(known) for x in zip(*known)]
        return [0.0] * len(self.langs)

    def of_text(self, text):
        words = words_of(text)
        if not self.langs or not any(c.isalpha() for w in words for c in w):
            return "und", 0.0
        mean = [sum(x) / len(words) for x in zip(*map(self.of_word, words))]
        sure = [math.exp((m - max(mean)) * min(len(words), 10)) for m in mean]
        return self.langs[mean.index(max(mean))], max(sure) / sum(sure)


def random_rows(n, seed):
    rng = random.Random(seed)
    letters = {"en": "abcdefgh", "de": "defghijkäß", "fr": "ghijklmé", None: "abc"}
    rows = []
    for _ in range(n):
        lang = rng.choice(["en", "de", "fr", "fr", None])
        words = ["".join(rng.choices(letters[lang], k=rng.randint(1, 7))) for _ in range(rng.randint(0, 25))]
        rows.append((rng.choice([" ", ", ", "1-", "\n"]).join(w.title() if rng.random() < 0.2 else w for w in words), lang))
    return rows + [(None, "fr"), ("", "de"), ("— “” 5", "en")]


@pytest.mark.parametrize("head", [64 << 20, 0, 4000, 40_000])
def test_query_equals_brute_force(spark, monkeypatch, head):
    """With the whole model in the head, with none of it, and with some of it."""
    monkeypatch.setattr(langid, "HEAD_BYTES", head)
    rows = random_rows(150, 1)
    train = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    model = langid.learn(train, F.lit(True))
    assert model.whole == (head == 64 << 20)
    assert (8 + 4 * len(model.langs)) * (len(model.words[0]) + len(model.grams[0])) <= head
    known = ByHand(rows)
    asked = [t for t, _ in random_rows(120, 2)] + ["zzzz qqq", "a", "ŋ ŋŋ", "12", "Abc" * 3000]
    docs = spark.createDataFrame([(i % 100, t, 7, "x") for i, t in enumerate(asked)], "doc_id long, text string, total int, cold string")
    got = sorted((r.doc_id, r.lang_pred, round(r.score, 5)) for r in langid.predict(docs, model).collect())
    want = sorted((i % 100, lang, round(score, 5)) for i, t in enumerate(asked) for lang, score in [known.of_text(t)])
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert all(abs(g[2] - w[2]) < 1e-3 for g, w in zip(got, want))
    kept = langid.keep(docs, model, 0.5)
    assert kept.columns == docs.columns
    sure = [(i % 100, t, 7, "x") for i, t in enumerate(asked) if known.of_text(t)[0] != "und" and known.of_text(t)[1] >= 0.5]
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(sure, key=repr)
    assert langid.predict(docs.limit(0), model).count() == 0


def test_head_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(langid, "HEAD_BYTES", 5000)
    model = langid.learn(spark.createDataFrame(random_rows(300, 3), "text string, lang string"), F.lit(True))
    rows = len(model.words[0]) + len(model.grams[0])
    assert 0 < rows * (8 + 4 * len(model.langs)) <= 5000
    totals = sorted((r.total for r in model.table.collect()), reverse=True)
    assert rows < len(totals)


def test_known_words_then_ngrams(spark):
    docs = corpus(spark)
    model = langid.learn(docs, F.lit(True))
    texts = [
        "the dog", "der hund", "THE DOG!", "othern catter", "flußstraße schönere", None, "", "12 + 3 !?", "— “” 5", "ŋ",
        "the " * 60_000 + "der", "the dog", "über",
    ]
    asked = spark.createDataFrame([(i, t, "xx") for i, t in enumerate(texts)], "doc_id long, text string, lang_pred string")
    found = {r.doc_id: r for r in langid.predict(asked, model).collect()}
    assert [found[i].lang_pred for i in (0, 1, 2, 3, 4, 10, 11, 12)] == ["en", "de", "en", "en", "de", "en", "en", "de"]
    for i in (5, 6, 7, 8):
        assert (found[i].lang_pred, found[i].score) == ("und", 0.0)
    assert found[9].lang_pred in ("en", "de", "fr")
    assert all(0 <= r.score <= 1 for r in found.values())


def test_nothing_learned(spark):
    model = langid.learn(corpus(spark), F.lit(False))
    found = langid.predict(corpus(spark), model).collect()
    assert {(r.lang_pred, r.score) for r in found} == {("und", 0.0)}


def test_counts_are_exact_however_many_words(spark):
    rng = random.Random(1)
    many = [" ".join("".join(rng.choices("abcdefghijklm", k=7)) for _ in range(3000)) for _ in range(40)]
    rows = [(t, "en") for t in many] + [("abba " * 3, "en"), ("no op pq qr rs st tu uv vw wx xy yz " * 5, "de")]
    model = langid.learn(spark.createDataFrame(rows, "text string, lang string"), F.lit(True))
    # None of these shares a word or a long n-gram with a text learned from.
    asked = ["nopqrst", "uvwxyzn", "pqrstuvw", "stuvwx", "rstuvwxyz"]
    docs = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string")
    assert {r.lang_pred for r in langid.predict(docs, model).collect()} == {"de"}
    counts = Counter(w for t, _ in rows for w in t.split())
    sizes = {r.is_word: r["count"] for r in model.table.groupBy("is_word").count().collect()}
    assert sizes[True] == sum(n >= langid.KNOWN_COUNT for n in counts.values())
    assert sizes[False] == len({g for w in counts for grams in grams_of(w) for g in grams})


def test_gram_counts_equal_brute_force():
    words, n = ["ab", "über", "x", "zz"], np.array([3, 1, 2, 5])
    keys, counts = langid.gram_counts([w.encode() for w in words], n)
    want = Counter()
    for w, c in zip(words, n.tolist()):
        for grams in grams_of(w):
            for g in grams:
                want[g] += c
    assert sorted(counts.tolist()) == sorted(want.values()) and len(keys) == len(set(keys.tolist()))


def counted(batch):
    found, words = Counter(), Counter()
    for out in langid.task_counts(iter([batch])):
        for lang, is_word, key, n in zip(*(c.to_pylist() for c in out.columns)):
            found[lang, is_word, key] += n
            words[lang] += n if is_word else 0
    return found, words


def text_batch(n_words):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=8)) for _ in range(n_words)]
    langs = ["en", "de"] * (n_words // 2000)
    texts = [" ".join(words[i * 1000 : (i + 1) * 1000]) for i in range(len(langs))]
    return pa.RecordBatch.from_arrays([pa.array(texts), pa.array(langs)], names=["text", "lang"])


def test_counts_do_not_depend_on_what_a_task_holds(monkeypatch):
    batch = text_batch(20_000)
    want, words = counted(batch)
    assert words == {"en": 10_000, "de": 10_000}
    for name, value in (("TEXT_BYTES", 10_000), ("HELD_BYTES", 50_000), ("HELD_GRAMS", 3000)):
        monkeypatch.setattr(langid, name, value)
    assert counted(batch)[0] == want
    assert sum(out.num_rows for out in langid.task_counts(iter([batch]))) > len(want)


def test_memory_of_a_task_that_counts():
    """Some 600,000 distinct words take 114 MB by this measure if all are held together."""
    batch = text_batch(600_000)
    tracemalloc.start()
    try:
        rows = sum(out.num_rows for out in langid.task_counts(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows > 500_000 and peak < 85 << 20


def test_held_out_accuracy_of_the_query(spark):
    found = queries.QUERIES["op5_language"](spark, SF).toPandas()
    known = found.merge(spark.read.parquet(f"{SF}/documents.parquet").toPandas()[["doc_id", "lang"]], on="doc_id")
    held = known[known.held_out]
    assert len(held) > 100 and (held.lang == held.lang_pred).mean() >= 0.97
