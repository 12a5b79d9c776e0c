"""Connected components and joins with hot keys, as DataFrame jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.llm.tables import staged

#: A key with more than this share of all rows is hot; at most its inverse of keys are.
HOT_SHARE = 1 / 1000


def join_keyed(left: DataFrame, right: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """Inner join with ``right``, which has one row per key and its rows in ``left``.

    Keys with more than ``HOT_SHARE`` of the ``total`` rows are broadcast - fewer than
    1 / HOT_SHARE rows whatever the input - so that no key's rows meet in one task.
    """
    is_hot = F.col(weight) > max(total * HOT_SHARE, 1)
    hot, cold = right.filter(is_hot), right.filter(~is_hot)
    rest = left.join(F.broadcast(hot.select(key)), key, "left_anti")
    return left.join(F.broadcast(hot), key).unionByName(rest.join(cold, key))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _pointed(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger node ``a`` to the smaller node ``b``."""
    return (
        edges.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); a component is its least node.

    Turns of large-star and small-star: each node's larger neighbours, then its
    smaller ones, are tied to the least of them, until nothing changes. Every turn is
    written to the shared folder.
    """
    now = staged(_pointed(edges), "edges")
    mark = _mark(now)
    while True:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        # Written first, so that both sides of the join are shuffled and a hot node can be split.
        least = staged(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "least")
        large = both.filter(F.col("v") > F.col("u")).join(least, "u").select(
            F.col("v").alias("a"), F.col("m").alias("b")
        )
        large = staged(_pointed(large), "large")
        least = staged(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b"))
        )
        now = staged(_pointed(small), "small")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return (
        now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        .union(now.select("b", "b").distinct())
    )


def keep_rows(docs: DataFrame, kept: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``kept`` (doc_id, text_hash) names, repeated rows once.

    Rows are told apart by id and text; columns and their order stay. Texts are shuffled
    once: only names that stand for several rows are looked through for repeats.
    """
    mark = "kept_hash"
    while mark in docs.columns:
        mark += "_"
    names = kept.groupBy(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_text")).agg(
        F.count("*").alias("kept_rows")
    )
    names = staged(names, "kept-names")
    marked = docs.withColumn(mark, F.xxhash64(text_col))
    same = F.col(id_col).eqNullSafe(F.col("kept_id")) & (F.col(mark) == F.col("kept_text"))
    several = F.col("kept_rows") > 1
    once = marked.join(names.filter(~several), same, "left_semi")
    if names.filter(several).isEmpty():
        return once.select(docs.columns)
    again = marked.join(names.filter(several), same, "left_semi").dropDuplicates([id_col, mark])
    return once.union(again).select(docs.columns)
