"""Intermediate tables that freeze a result and cut its lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gridtally.session import shared_folder


def by_partition(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Rows grouped by table partition, for few, evenly sized files.

    A partition too large for one task is split over several.
    """
    return df.hint("rebalance", *[F.col(c) for c in partition_by])


def write_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace exactly the partitions that occur in ``df``."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def _laid_out(df: DataFrame, partition_by: list[str] | None, max_partitions: int | None) -> DataFrame:
    grouped = by_partition(df, partition_by) if partition_by else df
    return grouped if max_partitions is None else grouped.coalesce(max_partitions)


def _write(rows: DataFrame, like: DataFrame, path: str, partition_by: list[str] | None) -> DataFrame:
    rows.write.mode("overwrite").partitionBy(*(partition_by or [])).parquet(path)
    return like.sparkSession.read.schema(like.schema).parquet(path).select(*like.columns)


def stage(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    max_partitions: int | None = None,
) -> DataFrame:
    """Write ``df`` as Parquet and read it back with the same column types.

    Rows are grouped by table partition first, if there is any, so that a
    partition has few files; else they are written where they are.
    ``max_partitions`` bounds the number of write tasks.
    """
    return _write(_laid_out(df, partition_by, max_partitions), df, path, partition_by)


def stage_counted(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    max_partitions: int | None = None,
) -> tuple[DataFrame, int]:
    """``stage``, and how many rows were written, without a scan of its own.

    The rows are counted where they are written: behind every shuffle, in the tasks
    of the write, of which Spark counts one successful attempt each. A stage that is
    repeated after a lost executor therefore counts no row twice. Where Spark drops the
    counting from its plan, the written rows are counted.
    """
    seen = Observation()
    rows = _laid_out(df, partition_by, max_partitions).observe(seen, F.count(F.lit(1)).alias("rows"))
    staged = _write(rows, df, path, partition_by)
    n = seen.get.get("rows")
    return staged, staged.count() if n is None else int(n)


class Watched:
    """A frame whose rows that meet a condition are noticed while something else is computed from it.

    Counts before a shuffle may be too high, if Spark repeats a stage, but never miss a
    row, so a "no" is certain and a number is not given.
    """

    def __init__(self, df: DataFrame, condition: Column):
        self._seen = Observation()
        self.df = df.observe(self._seen, F.count_if(condition).alias("met"))

    def any(self) -> bool:
        """Whether a row met the condition; waits for the first action on the frame."""
        return self._seen.get.get("met", 1) > 0


def materialize(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def batch_metrics(df: DataFrame, rows: int | None = None) -> dict[str, int]:
    """Rows and partitions of a staged frame; the rows are counted unless they are known."""
    return {"rows": df.count() if rows is None else rows, "partitions": df.rdd.getNumPartitions()}
