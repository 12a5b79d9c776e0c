"""Stored bitmaps, answers from partition names, comparison by digests."""

import random

import pytest
from pyspark.sql import functions as F

from gridtally.operators import bitmaps, quality
from gridtally.operators.reconcile import differing_buckets, reconcile, reconcile_changed
from gridtally.sinks import tables
from gridtally.sources.partitions import read_latest, stored_extent, stored_partitions


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


# --- bitmaps -----------------------------------------------------------------


def test_numbers_stay_and_are_dense(spark):
    first = spark.createDataFrame([(f"m{i}",) for i in range(500)] + [("m1",), (None,)], "serial string")
    known = bitmaps.assign_numbers(first, parts=8)
    one = dict(rows(known))
    assert len(one) == 500 == len(set(one.values()))
    more = spark.createDataFrame([(f"m{i}",) for i in range(300, 900)], "serial string")
    two = dict(rows(bitmaps.assign_numbers(more, known, parts=8)))
    assert {k: two[k] for k in one} == one
    assert len(two) == 900 == len(set(two.values()))
    assert max(two.values()) < 1.5 * 900
    again = dict(rows(bitmaps.assign_numbers(more.repartition(5), known.repartition(3), parts=8)))
    assert again == two
    assert bitmaps.assign_numbers(first.limit(0)).count() == 0


def test_merged_reports_equal_one_aggregate(spark):
    rng = random.Random(5)
    data = [
        (rng.choice(["d1", "d2", "d3", None]), f"m{rng.randrange(90)}" if i % 7 else None, rng.choice(["a", "b", None]), i % 3)
        for i in range(900)
    ]
    df = spark.createDataFrame(data, "day string, serial string, channel string, v int")
    distinct = {"meters": "serial", "channels": "channel"}
    flags = {"zeros": F.col("v") == 0}
    numbers, parts = {}, []
    for batch in (df.filter("v < 2"), df.filter("v >= 1"), df.limit(0)):
        for column in distinct.values():
            numbers[column] = bitmaps.assign_numbers(batch.select(column), numbers.get(column), parts=4)
        parts.append(bitmaps.partial_report(batch, numbers, ("day",), distinct, flags))
    stored = parts[0].unionByName(parts[1]).unionByName(parts[2])
    twice = df.filter("v < 2").unionByName(df.filter("v >= 1"))
    want = quality.quality_report(twice, ("day",), distinct, flags)
    got = bitmaps.merged_report(stored, ("day",), tuple(distinct))
    assert got.columns == want.columns and rows(got) == rows(want)
    whole = bitmaps.counted_bitmaps(stored.filter("measure = 'meters'").withColumn("all", F.lit(1)), ("all",), "n")
    assert rows(whole) == [(1, df.select("serial").distinct().filter("serial is not null").count())]


# --- partition names ---------------------------------------------------------

SCHEMA = "v int, tenant string, run string"


@pytest.fixture
def runs(spark, tmp_path):
    path = str(tmp_path / "runs")
    data = [(i, t, f"r{i % 4}") for i in range(20) for t in ("oh", "a/p=1")] + [(99, "oh", None), (98, None, "r9")]
    tables.append(spark.createDataFrame(data, SCHEMA), path, ["tenant", "run"])
    (tmp_path / "runs" / "tenant=oh" / "run=r7").mkdir()  # a folder without data
    return path, data


def test_partitions_are_known_by_their_names(spark, runs):
    path, data = runs
    want = sorted({(t, r) for _, t, r in data}, key=lambda p: [(v is not None, v or "") for v in p])
    assert stored_partitions(spark, path, ["tenant", "run"]) == want
    assert stored_partitions(spark, path, ["tenant"]) == [(None,), ("a/p=1",), ("oh",)]
    assert stored_extent(spark, path, ["tenant", "run"], {"tenant": "oh"}) == ("r0", "r3")
    assert stored_extent(spark, path, ["tenant", "run"]) == ("r0", "r9")
    assert stored_extent(spark, path, ["tenant", "run"], {"tenant": "none"}) == (None, None)
    assert stored_partitions(spark, path + "-none", ["tenant"]) == []


def test_the_latest_run_reads_one_partition(spark, runs):
    path, data = runs
    latest = read_latest(spark, path, SCHEMA, ["tenant", "run"], {"tenant": "oh"})
    assert rows(latest) == sorted([d for d in data if d[1:] == ("oh", "r3")], key=str)
    assert {f.split("/runs/")[1].rsplit("/", 1)[0] for f in latest.inputFiles()} == {"tenant=oh/run=r3"}
    every = read_latest(spark, path, SCHEMA, ["tenant", "run"])
    assert rows(every) == [(98, None, "r9")]
    assert read_latest(spark, path, SCHEMA, ["tenant", "run"], {"tenant": "none"}).count() == 0


# --- comparison by digests ---------------------------------------------------

TABLE = "day string, id int, a string, b string"


def test_changes_equal_the_full_comparison(spark):
    rng = random.Random(2)
    left = [(f"d{i % 5}", i, rng.choice(["x", None, ""]), str(i % 9)) for i in range(400)]
    right = [r for r in left if r[1] % 97] + [("d9", 1, "x", "y"), ("d1", 5000, None, None)]
    right[10] = (*right[10][:2], "new", right[10][3])
    right[11] = (*right[11][:2], right[11][3], right[11][2])  # columns exchanged
    left += [("d1", None, "x", "1"), (None, 7, None, None)]
    right += [("d1", None, "x", "1")]
    one, two = spark.createDataFrame(left, TABLE), spark.createDataFrame(right, TABLE).repartition(7)
    want = rows(reconcile(one, two, ["day", "id"], names=("dev", "prod"), only_differences=True))
    assert want
    for by, buckets in (([], 16), (["day"], 64), (["day"], 1)):
        got = reconcile_changed(one, two, ["day", "id"], by=by, buckets=buckets, names=("dev", "prod"))
        assert rows(got) == want
    with pytest.raises(ValueError):
        reconcile_changed(one, two, ["id"], by=["day"])
    assert reconcile_changed(one.limit(0), two.limit(0), ["day", "id"]).count() == 0


def test_equal_buckets_are_not_compared(spark):
    left = spark.range(5000).select(F.lit("d").alias("day"), F.col("id").cast("int"), F.lit("a").alias("a"), F.lit(None).cast("string").alias("b"))
    assert differing_buckets(left, left.repartition(9), ["day", "id"], ["a", "b"], ["day"], 512).count() == 0
    right = left.withColumn("a", F.when(F.col("id") == 77, "z").otherwise(F.col("a")))
    assert differing_buckets(left, right, ["day", "id"], ["a", "b"], ["day"], 512).count() == 1
    swapped = left.select("day", "id", F.col("b").alias("a"), F.col("a").alias("b"))
    # NULL and value exchanged between columns change every bucket
    assert differing_buckets(left, swapped, ["day", "id"], ["a", "b"], [], 8).count() == 8
