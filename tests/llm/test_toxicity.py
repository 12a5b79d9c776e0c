import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridtally.llm import queries, toxicity
from gridtally.llm.tables import fold

SF = "/root/testdata/sf0.01"


def maximal(score):
    """Maximal segments by their definition: best subsequence, then what is left and right of it."""
    best, at = 0.0, None
    for i in range(len(score)):
        total = 0.0
        for j in range(i, len(score)):
            total += score[j]
            if total > best + 1e-9:
                best, at = total, (i, j + 1)
    if at is None:
        return []
    left, right = maximal(score[: at[0]]), maximal(score[at[1] :])
    return left + [at] + [(a + at[1], b + at[1]) for a, b in right]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([-3, -2, -1, 1, 2, 5, 0.5, -0.25]), max_size=14))
def test_segments_equal_their_definition(score):
    # Powers of two and small odd shifts make all sums distinct enough to have one answer.
    score = [s + 0.001 * (i % 3) + 1e-5 * i * i for i, s in enumerate(score)]
    found = toxicity.segments(np.array(score))
    assert [(a, b) for a, b, _ in found] == maximal(score)
    assert np.allclose([s for _, _, s in found], [sum(score[a:b]) for a, b, _ in found])


def test_extreme_values_of_gumbel_samples():
    rng = np.random.default_rng(1)
    n = rng.integers(50, 5000, 20_000)
    top = (np.log(n) + 0.7 + rng.gumbel(size=len(n))) / 1.4
    rate, log_k = toxicity.extreme_values(top, n)
    assert abs(rate - 1.4) < 0.05 and abs(log_k - 0.7) < 0.2


def made_up(spark, n=400):
    rng = random.Random(2)
    common = [f"{a}{b}" for a in "bcdfg" for b in ("ala", "elo", "imi", "oto")]
    rows = []
    for i in range(n):
        words = rng.choices(common, k=rng.randint(20, 200))
        if i % 4 == 0:
            at = rng.randrange(len(words))
            words[at:at] = [f"Vile{rng.choice('abcdef')}," for _ in range(6)]
        rows.append((i, " ".join(words), 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(n)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    return docs, labels


def test_toxic_passages_are_found(spark):
    docs, labels = made_up(spark)
    model = toxicity.learn(docs, labels, F.col("doc_id") % 2 == 0)
    scored = {r.doc_id: r for r in toxicity.assess(docs, model).collect()}
    assert all((r.score >= 0.5) == (i % 4 == 0) for i, r in scored.items())
    assert all(0 <= r.score <= 1 and (r.passages >= 1) == (i % 4 == 0) for i, r in scored.items())
    # An unseen form of the stem, in capitals, within a very long text.
    odd = spark.createDataFrame(
        [(1, None), (2, ""), (3, "bala " * 50_000), (4, "bala " * 300 + "VILEZQ vilezz Vilexa vilepo vilede " * 2), (4, "belo"), (None, "vilea")],
        "doc_id long, text string",
    )
    found = [(r.doc_id, r.score >= 0.5) for r in toxicity.assess(odd, model).collect()]
    assert sorted(found, key=repr)[:5] == [(1, False), (2, False), (3, False), (4, False), (4, True)]
    assert toxicity.assess(docs.limit(0), model).count() == 0


WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def keys_by_token(text):
    """For each token the token itself and its beginnings of so many bytes."""
    out = []
    for word in WORD.findall(text or ""):
        token = word.translate(LOWER).encode()
        out.append([(0, token)] + [(n, token[:n]) for n in toxicity.STEMS if len(token) > n])
    return out


def odds_by_hand(texts, labelled):
    """Log-odds of every key, from plain counts of all texts and of the labelled ones."""
    corpus, clean, toxic = Counter(), Counter(), Counter()
    for i, text in enumerate(texts):
        for keys in keys_by_token(text):
            corpus.update(keys)
            if i in labelled:
                (toxic if labelled[i] else clean).update(keys)
    places = 1 << toxicity.BITS
    whole = sum(corpus.values()) + 0.01 * places
    weight = toxicity.PRIOR_SHARE * sum(toxic.values())
    a_sum, b_sum = sum(toxic.values()) + weight, sum(clean.values()) + weight
    odds = {}
    for key, n in corpus.items():
        prior = weight * (n + 0.01) / whole
        a, b = toxic[key] + prior, clean[key] + prior
        value = math.log(a / (a_sum - a)) - math.log(b / (b_sum - b))
        left = abs(value) - toxicity.ERRORS * math.sqrt(1 / a + 1 / b)
        odds[key] = math.copysign(max(left, 0.0), value)
    return odds


def measures_by_hand(text, odds, rate, log_k):
    tokens = keys_by_token(text)
    score = [max((odds.get(k, 0.0) for k in keys), key=abs) - toxicity.DRIFT for keys in tokens]
    sums = [sum(score[a:b]) for a, b in maximal(score)]
    x = [rate * s - log_k - math.log(len(tokens)) for s in sums]
    found = [v for v in x if v > 0]
    return [1.0, max([-12.0, *x]), math.log1p(sum(found))], len(found)


def test_odds_and_scores_equal_brute_force(spark):
    docs, labels = made_up(spark, 120)
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    labelled = {i: i % 4 == 0 for i in range(120) if i % 3}
    model = toxicity.learn(docs, labels, F.col("doc_id") % 3 != 0)
    odds = odds_by_hand(texts, labelled)
    for text in texts[:20]:
        for token, keys in zip(WORD.findall(text), keys_by_token(text)):
            scan = toxicity.Scan([token.encode()], lower=True, letters=True)
            got = float(toxicity.token_scores(scan, model["odds"])[0]) + toxicity.DRIFT
            assert abs(got - max((odds[k] for k in keys), key=abs)) < 1e-3
    measures = [measures_by_hand(t, odds, model["rate"], model["log_k"]) for t in texts]
    scored = {r.doc_id: r for r in toxicity.assess(docs, model).collect()}
    for i, (x, n) in enumerate(measures):
        z = sum(a * b for a, b in zip(x, model["beta"]))
        assert abs(scored[i].score - 1 / (1 + math.exp(-z))) < 1e-3 and scored[i].passages == n
    # the weights are where the penalised likelihood of the labelled texts has no slope
    sizes = Counter(labelled.values())
    slope = [0.0] * 3
    for i, y in labelled.items():
        x, _ = measures[i]
        p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(x, model["beta"]))))
        slope = [s + (y - p) * v for s, v in zip(slope, x)]
    pull = [1e-6 * model["beta"][0], *model["beta"][1:]]
    assert sizes[True] and all(abs(s - q) < 0.05 for s, q in zip(slope, pull))


def test_without_labels(spark):
    docs, labels = made_up(spark, 20)
    model = toxicity.learn(docs, labels.limit(0), F.lit(True))
    assert {r.score for r in toxicity.assess(docs, model).collect()} == {0.0}


def test_held_out_labels_and_inputs_do_not_matter(spark):
    docs, labels = made_up(spark, 100)
    use = fold("doc_id", 5) != 0
    other = labels.withColumn("toxic", F.when(use, F.col("toxic")).otherwise(1 - F.col("toxic")))
    first = toxicity.assess(docs, toxicity.learn(docs, labels, use)).collect()
    assert sorted(first) == sorted(toxicity.assess(docs, toxicity.learn(docs, other, use)).collect())


def test_held_out_accuracy_of_the_query(spark):
    found = queries.QUERIES["op3_toxicity"](spark, SF).toPandas()
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in zip(found.doc_id, found.held_out))
    known = found.merge(spark.read.parquet(f"{SF}/labels.parquet").toPandas(), on="doc_id")
    held = known[known.held_out]
    assert (held.predicted == held.toxic).mean() >= 0.9
