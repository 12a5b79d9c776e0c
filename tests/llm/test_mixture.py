import hashlib
import re
from collections import defaultdict

import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from gridtally.llm import mixture, queries

SF = "/root/testdata/sf0.001"


def test_query_equals_sql(spark):
    df = queries.QUERIES["op2_mixture"](spark, SF)
    assert differences(connect(SF), df, queries.ORACLES["op2_mixture"]) is None


def by_hand(rows):
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    text = [f"{'' if d is None else d}:{t or ''}" for d, t, _ in rows]
    hashed = [int(hashlib.md5(t.encode()).hexdigest()[:15], 16) for t in text]
    names = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total = {s: sum(n for n, r in zip(size, rows) if r[2] == s) for s in names}
    target, full = {}, set()
    while True:
        rest = sum(total.values()) - sum(3 * total[s] for s in full)
        left = sum(weight[s] for s in names if s not in full)
        target = {s: 3 * total[s] if s in full else weight[s] * rest / left for s in names}
        over = {s for s in names if s not in full and target[s] >= 3 * total[s]}
        if not over:
            break
        full |= over
    out = []
    for (doc, _, s), n, h in zip(rows, size, hashed):
        repeats = int(target[s] // total[s]) if total[s] else 0
        budget = target[s] - repeats * total[s]
        cells = defaultdict(int)
        for r, k, g in zip(rows, size, hashed):
            if r[2] == s:
                cells[g] += k
        upto, edge, last = 0, 1 << 60, False
        for g in sorted(cells):
            if upto + cells[g] > budget:
                edge, last = g, upto + cells[g] - budget < budget - upto
                break
            upto += cells[g]
        out.append((doc, n, total[s], target[s], n * (repeats + (h < edge or (h == edge and last)))))
    return sorted(out, key=repr)


def test_edges_equal_brute_force(spark):
    rows = [(i, "w " * (i % 7 * 10), f"s{i % 5}") for i in range(60)]
    rows += [(100, None, "s1"), (101, "", None), (None, "a b", "s2"), (None, "a b", "s2"), (102, "x " * 20_000, "big")]
    rows += [(103, "q", "émpty"), (104, " ", "zero")] + [(7, "same words here", "s3")] * 5
    docs = spark.createDataFrame([(d, t, s, 1, 2) for d, t, s in rows], "doc_id long, text string, source string, size int, mix_repeats int")
    found = mixture.mix(docs)
    got = sorted((tuple(r) for r in found.collect()), key=repr)
    assert got == by_hand(rows)
    assert all(t <= 3 * n for _, n, _, _, t in got)
    applied = mixture.apply_mix(docs)
    assert applied.columns == docs.columns
    counts = {r.doc_id: r.n for r in applied.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert counts.get(102, 0) == next(t // n for d, n, _, _, t in got if d == 102)
    assert mixture.mix(docs.limit(0)).count() == 0 and mixture.apply_mix(docs.limit(0)).count() == 0


def test_smaller_mixes_are_nested(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sized, _ = mixture.plan(docs)
    budgets = sized.groupBy("source_key").agg(F.sum("size").alias("n"))
    rungs = budgets.select("source_key", F.explode(F.array(*(F.lit(x) for x in (1, 2, 3)))).alias("rung"), "n")
    rungs = rungs.select("source_key", "rung", (F.col("n") * F.col("rung") / 4).alias("budget"))
    found = mixture.thresholds(sized, rungs)
    below = sized.select(F.col("source_key").alias("of"), "hash", "size")
    sums = (
        found.join(below, (F.col("of") == F.col("source_key")) & (F.col("hash") < F.col("threshold")), "left")
        .groupBy("source_key", "rung")
        .agg(F.coalesce(F.sum("size"), F.lit(0)).alias("words"), F.max("threshold").alias("t"))
        .join(rungs, ["source_key", "rung"])
        .collect()
    )
    largest = sized.agg(F.max("size")).first()[0]
    assert len(sums) == 60
    assert all(abs(r.words - r.budget) <= largest / 2 + 1 for r in sums)
    by_source = defaultdict(list)
    for r in sorted(sums, key=lambda r: r.rung):
        by_source[r.source_key].append(r.t)
    assert all(ts == sorted(ts) for ts in by_source.values())


@pytest.mark.parametrize("text,n", [(None, 0), ("", 0), ("a\x0bb c d", 3), ("é\n\né", 2)])
def test_words(spark, text, n):
    assert spark.createDataFrame([(text,)], "t string").select(mixture.words(F.col("t"))).first()[0] == n
