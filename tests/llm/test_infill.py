import hashlib
import random
import re

import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from gridtally.llm import infill, queries

SF = "/root/testdata/sf0.001"
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
ALPHABET = ["a", "b", " ", "  ", "\n", "\t", "é", "😀", "\x85", "　", "word", "<", "P>", "\x00", "<S", ">"]


def by_hand(doc_id, text, seed=42, rate=50, spm_rate=80):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    if h[3] % 100 < spm_rate:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def random_texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choices(ALPHABET, k=rng.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("block", [1, 2, 3, 7, 64, 1024])
def test_cuts_equal_a_list_of_units(block):
    for text in random_texts(150):
        units, data = UNIT.findall(text), text.encode()
        tree = infill.CutTree(data, block, piece=4 * block)
        assert tree.n == len(units)
        for k in range(len(units) + 1):
            head = "".join(units[:k])
            assert tree.cut(k) == (len(head.encode()), len(head)), (text, k)


@pytest.mark.parametrize("block", [1, 5, 1024])
def test_samples_equal_a_plain_version(block):
    for i, text in enumerate([None, "", " ", "\n\n", "x", "a <P> b", *random_texts(400)]):
        s = infill.sample(i, text, block=block)
        assert (s.n, s.form, s.prefix_chars, s.middle_chars, s.output) == by_hand(i, text)


def test_rows_and_their_way_back(spark):
    texts = [None, "", "  ", "two words ", "<M>", "long\ttext é " * 40_000, "two words ", *random_texts(300, 9)]
    rows = [(i if i != 3 else None, t, "x", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, output string, n int")
    made = infill.transform(docs).withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    assert len(made) == len(rows)
    want = {(i, *by_hand(i, t), t or "") for i, t, _, _ in rows}
    assert {tuple(r) for r in made} == want
    assert {r.form for r in made} == {"plain", "psm", "spm"}
    assert infill.transform(docs.limit(0)).count() == 0


def test_rates_and_seeds(spark):
    docs = spark.range(400).select(F.col("id").alias("k"), F.lit("some words to cut in parts").alias("body"))
    every = infill.transform(docs, "k", "body", seed=7, rate=100, spm_rate=0).collect()
    assert {r.form for r in every} == {"psm"}
    assert {(r.doc_id, r.output) for r in every} == {(i, by_hand(i, "some words to cut in parts", 7, 100, 0)[4]) for i in range(400)}
    assert {r.form for r in infill.transform(docs, "k", "body", rate=0).collect()} == {"plain"}


def test_query_equals_sql(spark):
    df = queries.QUERIES["op12_infill"](spark, SF)
    assert differences(connect(SF), df, queries.ORACLES["op12_infill"]) is None
