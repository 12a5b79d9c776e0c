"""Deliveries merged as a stream."""

import pytest
from pyspark.sql import functions as F

from gridtally.operators.dedup import dedup_latest
from gridtally.sinks import tables
from gridtally.sinks.streaming import merge_stream
from gridtally.sources.tables import read_parquet

SCHEMA = "id int, v int, user string, day string"
MERGE = {"schema": SCHEMA, "keys": ["day", "id"], "update_cols": ["v", "user"], "partition_by": ["day"]}


@pytest.fixture
def merge(spark):
    return {**MERGE, "on_update": {"user": F.lit("update")}, "on_insert": {"user": F.lit("insert")}}


def deliver(spark, folder, *data):
    spark.createDataFrame(list(data), SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))


def stored(spark, path):
    return sorted(tuple(r) for r in read_parquet(spark, str(path), SCHEMA).collect())


def newest(batch):
    return dedup_latest(batch, ["day", "id"], [F.desc("v")])


def run(spark, inbox, path, checkpoint, merge):
    rows = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(inbox))
    query = merge_stream(rows, str(path), "in-box", str(checkpoint), prepare=newest, **merge)
    query.awaitTermination()


def test_deliveries_are_merged_once(spark, tmp_path, merge):
    inbox, path = tmp_path / "inbox", tmp_path / "t"
    deliver(spark, inbox, (1, 1, "x", "a"), (1, 2, "x", "a"), (2, 5, "x", "b"))
    run(spark, inbox, path, tmp_path / "c", merge)
    assert stored(spark, path) == [(1, 2, "insert", "a"), (2, 5, "insert", "b")]
    deliver(spark, inbox, (1, 9, "x", "a"), (3, 3, "x", "a"))
    run(spark, inbox, path, tmp_path / "c", merge)
    want = [(1, 9, "update", "a"), (2, 5, "insert", "b"), (3, 3, "insert", "a")]
    assert stored(spark, path) == want
    run(spark, inbox, path, tmp_path / "c", merge)
    assert stored(spark, path) == want


def test_a_replayed_batch_changes_nothing(spark, tmp_path, merge):
    inbox, path, checkpoint = tmp_path / "inbox", tmp_path / "t", tmp_path / "c"
    deliver(spark, inbox, (1, 1, "x", "a"))
    run(spark, inbox, path, checkpoint, merge)
    # as after a failure between the merge and Spark's own note of it
    for note in (checkpoint / "commits").iterdir():
        note.unlink()
    run(spark, inbox, path, checkpoint, merge)
    assert stored(spark, path) == [(1, 1, "insert", "a")]


def test_a_batch_is_known_as_soon_as_its_swap_is_complete(spark, tmp_path, merge):
    path = tmp_path / "t"
    source = spark.createDataFrame([(1, 1, "x", "a")], SCHEMA)
    tables.write_merge(source, str(path), batch=("s", 0), **merge)
    late = spark.createDataFrame([(1, 7, "late", "a")], SCHEMA)
    late.write.partitionBy("day").parquet(f"{path}/_swap--abc-s-1")  # written, not swapped in
    assert tables.write_merge(source, str(path), batch=("s", 1), **merge) == []
    assert stored(spark, path) == [(1, 7, "late", "a")]
    assert tables.write_merge(source, str(path), batch=("s", 2), **merge) == ["a"]
    assert tables.write_merge(source, str(path), batch=("other", 0), **merge) == ["a"]
