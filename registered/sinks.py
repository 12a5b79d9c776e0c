"""Appends, upserts and retention on stored tables."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally import config
from gridtally.operators.merge import ACTION, retain_recent
from gridtally.session import work_path
from gridtally.sinks import tables
from gridtally.sinks.staging import materialize, stage
from gridtally.sinks.streaming import merge_stream
from gridtally.sources.partitions import read_latest, stored_extent
from gridtally.sources.tables import read_parquet
from registered import aggregates, frames, joins

RUN_TS = datetime(2024, 1, 21, 12, 0, 0, tzinfo=timezone.utc)


def retention(spark: SparkSession, sf: str) -> DataFrame:
    """Rows left after dropping one tenant's runs older than eight days."""
    return retain_recent(frames.consume(spark, sf), "oh", RUN_TS).select(*frames.CONSUME_SHOWN)


def incremental_publish(spark: SparkSession, sf: str) -> DataFrame:
    """A stored incremental table after retention and one more run."""
    path = work_path(spark, "incremental")
    rows = frames.consume(spark, sf).select(*frames.CONSUME_SHOWN)
    tables.append(rows, path, config.INCREMENTAL_PARTITIONS)
    tables.publish_incremental(rows, path, "oh", RUN_TS)
    return read_parquet(spark, path, rows.schema).select(*rows.columns)


def append_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Two appends to a partitioned path, columns matched by name."""
    path = work_path(spark, "append")
    orders = frames.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    done = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    tables.append(orders.filter(done), path, ["o_orderstatus"])
    tables.append(orders.filter(~done).select(*reversed(orders.columns)), path, ["o_orderstatus"])
    return read_parquet(spark, path, orders.schema).select(*orders.columns)


def write_merge(spark: SparkSession, sf: str) -> DataFrame:
    """A stored table after two deliveries were upserted into it."""
    path = work_path(spark, "consume")
    first, second = joins.deliveries(spark, sf)
    stamps = {
        "on_update": {"hdp_update_user": F.lit(config.UPDATE_USER)},
        "on_insert": {"hdp_update_user": F.lit(config.INSERT_USER)},
    }
    for number, delivery in enumerate([first, second]):
        source = stage(delivery, work_path(spark, f"delivery{number}"))
        tables.write_merge(
            source,
            path,
            schema=delivery.schema,
            keys=joins.MERGE_KEYS,
            update_cols=joins.MERGE_UPDATES,
            partition_by=["aep_usage_dt"],
            **stamps,
        )
    return read_parquet(spark, path, first.schema).select(*first.columns)


WRITE_MERGE_SQL = f"""
SELECT * EXCLUDE ({ACTION}) REPLACE (
         CASE WHEN {ACTION} = 'updated' THEN 'info-update' ELSE 'info-insert' END AS hdp_update_user)
FROM ({joins.MERGE_SQL})
"""


def stream_merge(spark: SparkSession, sf: str) -> DataFrame:
    """The same table after the two deliveries came as files of a stream."""
    inbox, path = work_path(spark, "inbox"), work_path(spark, "consume")
    notes = work_path(spark, "stream")
    for delivery in joins.deliveries(spark, sf):
        # what is there when the stream runs is one batch
        delivery.write.mode("append").parquet(inbox)
        files = spark.readStream.schema(delivery.schema).parquet(inbox)
        query = merge_stream(
            files,
            path,
            "deliveries",
            notes,
            schema=delivery.schema,
            keys=joins.MERGE_KEYS,
            update_cols=joins.MERGE_UPDATES,
            partition_by=["aep_usage_dt"],
            on_update={"hdp_update_user": F.lit(config.UPDATE_USER)},
            on_insert={"hdp_update_user": F.lit(config.INSERT_USER)},
        )
        query.awaitTermination()
    return read_parquet(spark, path, delivery.schema).select(*delivery.columns)


def stored_runs(spark: SparkSession, sf: str) -> tuple[DataFrame, str]:
    rows, path = frames.consume(spark, sf).select(*frames.CONSUME_SHOWN), work_path(spark, "runs")
    tables.append(rows, path, config.INCREMENTAL_PARTITIONS)
    return rows, path


def latest_run_stored(spark: SparkSession, sf: str) -> DataFrame:
    """The latest run of a tenant in a stored table, found by the names of its partitions."""
    rows, path = stored_runs(spark, sf)
    latest = read_latest(spark, path, rows.schema, config.INCREMENTAL_PARTITIONS, {"aep_opco": "oh"})
    return latest.select(*frames.CONSUME_SHOWN)


def run_extent_stored(spark: SparkSession, sf: str) -> DataFrame:
    """Oldest and latest run of a tenant, from the names of partitions."""
    _, path = stored_runs(spark, sf)
    ends = stored_extent(spark, path, config.INCREMENTAL_PARTITIONS, {"aep_opco": "oh"})
    return spark.createDataFrame([ends], "oldest_run_date string, latest_run_date string")


def materialized(spark: SparkSession, sf: str) -> DataFrame:
    """A reliable checkpoint of an aggregate."""
    sums = frames.table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("cnt"))
    return materialize(sums)


PUBLISH_SQL = f"""{frames.FROM_CONSUME}
SELECT {frames.SHOWN_SQL} FROM consume WHERE NOT (aep_opco = 'oh' AND run_date < '20240113_120000')
UNION ALL
SELECT * REPLACE ('20240121_120000' AS run_date) FROM (
  SELECT {frames.SHOWN_SQL} FROM consume WHERE aep_opco = 'oh')
"""

QUERIES = {
    "retention": (
        retention,
        f"""{frames.FROM_CONSUME} SELECT {frames.SHOWN_SQL} FROM consume
            WHERE NOT (aep_opco = 'oh' AND run_date < '20240113_120000')""",
    ),
    "incremental_publish": (incremental_publish, PUBLISH_SQL),
    "append_rows": (append_rows, "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders"),
    "write_merge": (write_merge, WRITE_MERGE_SQL),
    "stream_merge": (stream_merge, WRITE_MERGE_SQL),
    "latest_run_stored": (latest_run_stored, aggregates.QUERIES["latest_run"][1]),
    "run_extent_stored": (run_extent_stored, aggregates.QUERIES["run_extent"][1]),
    "materialize": (
        materialized, "SELECT l_suppkey, count(*) AS cnt FROM lineitem GROUP BY 1"
    ),
}
