import random
import re

import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from gridtally.llm import minhash, queries
from gridtally.llm.groups import components, join_keyed, keep_rows


SF = "/root/testdata/sf0.001"


def by_hand(rows):
    sets = []
    for _, text in rows:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        runs = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
        sets.append(runs or ({tuple(words)} if words else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        group = [rows[j][0] for j in range(len(rows)) if find(j) == find(i)]
        known = [d for d in group if d is not None]
        least = (min(known) if known else None) if sets[i] else doc
        out.append((doc, len(sets[i]), least, doc == least))
    return sorted(out, key=repr)


def result(spark, rows):
    docs = spark.createDataFrame([(d, t, True, 1) for d, t in rows], "doc_id long, text string, kept boolean, node int")
    found = minhash.near_duplicates(docs).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found), key=repr)


def edited(rng, words, share):
    return [w if rng.random() > share else f"x{rng.randrange(10 ** rng.choice([1, 9]))}" for w in words]


@pytest.fixture(scope="module")
def crowd():
    """One text with many edits of several strengths, and unlike texts that share a passage."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(500)}" for _ in range(150)]
    passage = [f"p{i}" for i in range(40)]
    rows = [(1000, " ".join(base))]
    rows += [(i, " ".join(edited(rng, base, rng.choice([0.0, 0.01, 0.02, 0.04, 0.08])))) for i in range(150)]
    rows += [
        (i, " ".join([f"q{rng.randrange(10**6)}" for _ in range(60)] + passage)) for i in range(200, 260)
    ]
    return rows


def test_groups_equal_brute_force(spark, crowd):
    assert result(spark, crowd) == by_hand(crowd)


def test_edges(spark):
    rows = [
        (5, None), (6, ""), (7, " \t"), (8, "a b"), (3, "A  B"), (9, "a c"), (None, "a b"), (10, "one two three four five six"),
        (11, "One two three four five six"), (11, "One two three four five six"), (11, "other text here"), (12, None),
        (13, "é " * 30_000), (2, "é " * 29_000),
    ]
    assert result(spark, rows) == by_hand(rows)
    assert result(spark, rows[:1]) == by_hand(rows[:1])
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(docs).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(200, 200), (301, 300)]
    found = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {
        **{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 150)}, 300: 300, 301: 300,
    }


def test_join_with_a_hot_key(spark):
    left = spark.createDataFrame([(1 if i % 3 else i, i) for i in range(90)], "k long, v long")
    right = left.groupBy("k").count()
    joined = join_keyed(left, right, "k", "count", 90)
    assert sorted(r.v for r in joined.collect()) == list(range(90))


def test_many_rows_without_an_id(spark):
    """Texts meet their classes by id and text, so missing and shared ids make no product."""
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(30)) for _ in range(120)]
    rows = [(None, t) for t in texts] + [(None, texts[0]), (7, texts[1] + " x"), (None, texts[2] + " y")]
    rows += [(5, f"{t} z") for t in texts[3:60]]
    assert result(spark, rows) == by_hand(rows)


def test_full_sets_read_one_text_for_each_class(spark):
    n = 4000
    docs = spark.range(n).select(
        F.lit(None).cast("long").alias("doc_id"), F.concat_ws(" ", *[F.hash("id", F.lit(i)) for i in range(6)]).alias("text")
    )
    signed = minhash.sign(docs).withColumn("node", F.monotonically_increasing_id())
    classes = signed.select("node", F.col("doc_id").alias("least_doc"), F.col("text_hash").alias("lead_hash"), "set_digest")
    joined = minhash._full_sets(docs, classes, "doc_id", "text")
    assert joined.count() == n
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "xxhash64" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_rows_are_kept_once(spark):
    docs = spark.createDataFrame(
        [(1, "a", 0), (1, "a", 1), (1, "b", 2), (None, "c", 3), (None, "c", 4), (2, None, 5), (3, "d", 6), (4, "e", 7)],
        "doc_id long, text string, kept_rows int",
    )
    named = docs.withColumn("text_hash", F.xxhash64("text"))
    several = keep_rows(docs, named.filter("doc_id is null or doc_id <> 4"))
    got = sorted(((r.doc_id, r.text) for r in several.filter("doc_id is not null").collect()), key=str)
    assert got == [(1, "a"), (1, "b"), (2, None), (3, "d")]
    assert [r.text for r in several.filter("doc_id is null").collect()] == ["c"]
    assert several.columns == docs.columns
    alone = keep_rows(docs, named.filter("doc_id in (2, 4)"))
    assert sorted(r.doc_id for r in alone.collect()) == [2, 4]


def test_query_equals_sql(spark):
    df = queries.QUERIES["op10_minhash"](spark, SF)
    assert differences(connect(SF), df, queries.ORACLES["op10_minhash"]) is None
