import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import connect, differences

from gridtally.llm import divergence, queries

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def by_hand(docs, least_docs=30, scale=10**9, prior=5, top=50):
    seen, count, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in docs:
        text, lang, source = text or "", lang or "", source or ""
        terms = [t.translate(LOWER) for t in TERM.findall(text)]
        seen[lang].update(set(terms))
        count[lang, source].update(terms)
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in seen[lang].items() if n >= least_docs)

        def shares(counter):
            whole = sum(counter[t] for t in kept) + prior * len(kept)
            return {t: 1 + scale * (counter[t] + prior) // whole for t in kept}

        usual = shares(sum((count[lang, s] for s in sources), Counter()))
        of = {s: shares(count[lang, s]) for s in sources}
        for s in sources:
            pairs = [(o, sum(abs(of[s][t] - of[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, of[s][t] - usual[t]) for t in kept if count[lang, s][t] and of[s][t] > usual[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                for rank, (item, value) in enumerate(found[: top if part == "term" else None], 1):
                    out.append((lang, s, part, item, value, rank))
    return sorted(out)


def random_docs(n, seed, sources=9):
    rng = random.Random(seed)
    words = ["The", "the", "été", "x-ray", "a1b", "ÄÖ", "naïve", "😀", "don't", "[z]", *(f"w{chr(97 + i)}{chr(97 + j)}" for i in range(9) for j in range(9))]
    docs = []
    for _ in range(n):
        s = rng.randrange(sources)
        text = " ".join(rng.choices(words[s:], k=rng.randint(0, 40)))
        docs.append((text, rng.choice(["en", "en", "fr", None]), f"s{s}"))
    return docs + [(None, "de", "only"), ("few words", "de", None), (None, None, None), ("", "", "s1")]


def rows(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def frame(spark, docs):
    clashing = [(*d, 1, 2, "z") for d in docs]
    return spark.createDataFrame(clashing, "text string, lang string, source string, n int, a int, term string")


@pytest.mark.parametrize("groups,words", [(64, 4096), (3, 8), (1, 5)])
def test_any_cube_gives_the_plain_result(spark, monkeypatch, groups, words):
    monkeypatch.setattr(divergence, "GROUPS", groups)
    monkeypatch.setattr(divergence, "WORDS", words)
    docs = random_docs(300, 4)
    assert rows(divergence.audit(frame(spark, docs), least_docs=5, top=7)) == by_hand(docs, least_docs=5, top=7)


def test_repeats_empty_tables_and_groups_without_terms(spark):
    docs = random_docs(20, 5, sources=3) * 3
    assert rows(divergence.audit(frame(spark, docs), least_docs=4)) == by_hand(docs, least_docs=4)
    none = [("12 3", "en", "a"), (None, "en", "b"), ("", "en", None)]
    got = rows(divergence.audit(frame(spark, none)))
    assert got == by_hand(none) and len(got) == 6 and {r[4] for r in got} == {0}
    assert divergence.audit(frame(spark, docs).limit(0)).count() == 0


def test_long_texts_are_counted_in_pieces():
    text = ("Alpha beta-Gamma été12 " * 500 + "x" * 300).encode()
    whole = divergence._counted([text], np.array([3]), len(text))
    parts = divergence._counted([text], np.array([3]), 64)

    def plain(found):
        terms, group, term, n, docs = found
        return sorted(zip(terms.take(divergence.pa.array(term)).to_pylist(), group.tolist(), n.tolist(), docs.tolist()))

    assert plain(whole) == plain(parts)
    assert ("x" * 300, 3, 1, 1) in plain(parts) and ("été", 3, 500, 1) in plain(parts)


def test_shares_stay_exact_beyond_64_bits():
    counts = [0, 7, 10**13 + 1, 9_300_000_000]
    total, words = sum(counts) + 11, 4
    want = [1 + 10**9 * (c + 5) // (total + 5 * words) for c in counts]
    assert divergence.shares(np.array(counts), total, words, 10**9, 5).tolist() == want
    assert divergence.shares(np.array([1, 2]), 3, 2, 10**9, 5).tolist() == [1 + 10**9 * 6 // 13, 1 + 10**9 * 7 // 13]


def test_query_equals_sql(spark):
    df = queries.QUERIES["op13_divergence"](spark, SF)
    assert differences(connect(SF), df, queries.ORACLES["op13_divergence"]) is None
