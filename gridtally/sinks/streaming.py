"""Deliveries as a stream that is upserted batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from gridtally.session import drop_path, work_path
from gridtally.sinks.staging import stage
from gridtally.sinks.tables import write_merge


def merge_stream(
    rows: DataFrame,
    path: str,
    name: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    once: bool = True,
    **merge,
) -> StreamingQuery:
    """Start upserting a stream into a partitioned path; ``merge`` goes to ``write_merge``.

    ``prepare`` turns a batch into rows with one row for each key. Each batch is staged,
    since an upsert reads its source twice, and merged under its number: a batch that Spark hands over
    again after a failure changes nothing, not even the update stamps. With ``once`` the
    stream takes what is there and ends. ``name`` tells the streams of one table apart.
    """

    def merge_batch(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        work = work_path(spark, f"stream-{name}")
        try:
            source = stage(batch if prepare is None else prepare(batch), work)
            write_merge(source, path, batch=(name, number), **merge)
        finally:
            drop_path(spark, work)

    writer = rows.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
