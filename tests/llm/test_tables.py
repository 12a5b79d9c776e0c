import zlib

from pyspark.sql import functions as F

from gridtally.llm.tables import fold, sampled_labels


def test_samples_are_near_their_size(spark):
    labels = spark.range(20_000).select(F.col("id").alias("doc_id"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    hot = spark.range(9000).select(F.lit(5).cast("long").alias("doc_id"), F.lit(0).alias("y"))
    odd = spark.createDataFrame([(None, 1), (7, None), (8, 2)], "doc_id long, y int")
    sample, counts = sampled_labels(labels.union(hot).union(odd), "doc_id", "y", 3000, F.col("doc_id") >= 0)
    assert counts == {0: 18_000, 1: 2000}
    found = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    assert found[1] == 2000 and abs(found[0] - 3000) < 300
    assert sampled_labels(labels.limit(0), "doc_id", "y", 5)[0].count() == 0


def test_fold(spark):
    rows = spark.createDataFrame([(0,), (17,), (-3,), (None,)], "doc_id long").select("doc_id", fold("doc_id", 5).alias("f"))
    got = {r.doc_id: r.f for r in rows.collect()}
    assert got == {0: zlib.crc32(b"0") % 5, 17: zlib.crc32(b"17") % 5, -3: zlib.crc32(b"-3") % 5, None: None}
