"""Counts, distinct counts, extremes, sorts and limits on the consume-like events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally.functions import times
from gridtally.operators import quality
from gridtally.operators.dedup import dedup_removed, duplicate_counts
from gridtally.plans import acceptance
from registered import frames

DAY_KEY = ["serialnumber", "aep_channel_id", "aep_usage_dt"]


def consume(spark: SparkSession, sf: str) -> DataFrame:
    return frames.consume(spark, sf)


def count_total(spark: SparkSession, sf: str) -> DataFrame:
    return quality.row_count(consume(spark, sf))


def count_filtered(spark: SparkSession, sf: str) -> DataFrame:
    return quality.row_count(acceptance.tenant_rows(consume(spark, sf), "oh", ["2024-01-10"]))


def count_by_date(spark: SparkSession, sf: str) -> DataFrame:
    rows = acceptance.tenant_rows(consume(spark, sf), "oh")
    return acceptance.record_count_by_date(
        rows.withColumn("aep_usage_dt", F.col("aep_usage_dt").cast("string"))
    )


def count_by_tenant(spark: SparkSession, sf: str) -> DataFrame:
    return quality.count_by(consume(spark, sf), "aep_opco")


def count_by_user_stamp(spark: SparkSession, sf: str) -> DataFrame:
    return quality.count_by(consume(spark, sf), "hdp_update_user")


def unit_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return acceptance.unit_distribution(consume(spark, sf))


def bucket_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return acceptance.bucket_distribution(consume(spark, sf))


def duplicate_probe(spark: SparkSession, sf: str) -> DataFrame:
    rows = duplicate_counts(consume(spark, sf), [*DAY_KEY, "run_date"], least=2)
    return rows.withColumn("aep_usage_dt", F.col("aep_usage_dt").cast("string"))


def removed_by_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return dedup_removed(consume(spark, sf), DAY_KEY)


def distinct_meters(spark: SparkSession, sf: str) -> DataFrame:
    rows = acceptance.tenant_rows(consume(spark, sf), "oh")
    return quality.distinct_count(rows, "serialnumber", "distinct_meters")


def distinct_rows(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["aep_opco", "aep_channel_id", "aep_derived_uom", "aep_raw_uom"]
    return consume(spark, sf).select(*columns).distinct()


def partition_dates(spark: SparkSession, sf: str) -> DataFrame:
    return consume(spark, sf).select(F.col("aep_usage_dt").cast("string").alias("aep_usage_dt")).distinct()


def parse_comparison(spark: SparkSession, sf: str) -> DataFrame:
    """NULLs left by parsing an end time without and with its offset."""
    end = F.col("endtime")
    wall = F.substring(end, 1, 19)
    pattern = F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")
    return quality.null_counts(
        frames.readings(spark, sf),
        {
            "without_offset_null_count": F.try_to_timestamp(wall, pattern),
            "with_offset_null_count": times.epoch_of(end),
        },
    )


def run_extent(spark: SparkSession, sf: str) -> DataFrame:
    rows = acceptance.tenant_rows(consume(spark, sf), "oh")
    return quality.extent(rows, "run_date", "oldest_run_date", "latest_run_date")


def latest_run(spark: SparkSession, sf: str) -> DataFrame:
    rows = acceptance.tenant_rows(consume(spark, sf), "oh")
    return quality.latest_only(rows, "run_date").select(*frames.CONSUME_SHOWN)


def ordered_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = consume(spark, sf).select(*frames.CONSUME_SHOWN)
    return rows.orderBy(*acceptance.READING_ORDER, "event_id")


def top_meters(spark: SparkSession, sf: str) -> DataFrame:
    return quality.top_groups(consume(spark, sf), "serialnumber", 5)


def sample_ordered(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["serialnumber", "aep_channel_id", "endtimeperiod", "value"]
    return acceptance.sample_rows(consume(spark, sf), 150, columns)


def sql_view(spark: SparkSession, sf: str) -> DataFrame:
    """The latest run per SQL text on a registered view."""
    consume(spark, sf).createOrReplaceTempView("consume_rows")
    return spark.sql(
        """SELECT serialnumber, aep_channel_id, substr(endtimeperiod, 1, 10) AS day, value,
                  CASE WHEN value BETWEEN 10 AND 50 THEN 'PASS' ELSE 'FAIL' END AS value_check
           FROM consume_rows
           WHERE aep_opco = 'oh' AND hdp_insert_dttm >= TIMESTAMP_NTZ '2024-01-02 00:00:00'
             AND run_date = (SELECT max(run_date) FROM consume_rows WHERE aep_opco = 'oh')"""
    )


FROM = frames.FROM_CONSUME

QUERIES = {
    "count_total": (count_total, "SELECT count(*) AS total_records FROM events"),
    "count_filtered": (
        count_filtered,
        f"""{FROM} SELECT count(*) AS total_records FROM consume
            WHERE aep_opco = 'oh' AND aep_usage_dt = DATE '2024-01-10'""",
    ),
    "count_by_date": (
        count_by_date,
        f"""{FROM} SELECT CAST(aep_usage_dt AS VARCHAR) AS aep_usage_dt, count(*) AS record_count
            FROM consume WHERE aep_opco = 'oh' GROUP BY 1 ORDER BY 1""",
    ),
    "count_by_tenant": (
        count_by_tenant,
        f"{FROM} SELECT aep_opco, count(*) AS record_count FROM consume GROUP BY 1",
    ),
    "count_by_user_stamp": (
        count_by_user_stamp,
        f"{FROM} SELECT hdp_update_user, count(*) AS record_count FROM consume GROUP BY 1",
    ),
    "unit_distribution": (
        unit_distribution,
        f"""{FROM} SELECT aep_derived_uom, aep_raw_uom, count(*) AS cnt FROM consume
            GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2""",
    ),
    "bucket_distribution": (
        bucket_distribution,
        f"""{FROM} SELECT aep_meter_bucket, count(*) AS cnt FROM consume
            GROUP BY 1 ORDER BY 2 DESC, 1""",
    ),
    "duplicate_probe": (
        duplicate_probe,
        f"""{FROM} SELECT serialnumber, aep_channel_id, CAST(aep_usage_dt AS VARCHAR) AS aep_usage_dt,
            run_date, count(*) AS cnt FROM consume GROUP BY ALL HAVING count(*) > 1""",
    ),
    "dedup_removed": (
        removed_by_dedup,
        f"""{FROM}, k AS (SELECT count(*) AS copies FROM consume
                          GROUP BY serialnumber, aep_channel_id, aep_usage_dt)
            SELECT CAST(sum(copies) AS BIGINT) AS rows_before, count(*) AS rows_after,
                   CAST(sum(copies) AS BIGINT) - count(*) AS rows_removed FROM k""",
    ),
    "distinct_meters": (
        distinct_meters,
        f"""{FROM} SELECT count(DISTINCT serialnumber) AS distinct_meters FROM consume
            WHERE aep_opco = 'oh'""",
    ),
    "distinct_rows": (
        distinct_rows,
        f"""{FROM} SELECT DISTINCT aep_opco, aep_channel_id, aep_derived_uom, aep_raw_uom
            FROM consume""",
    ),
    "partition_dates": (
        partition_dates,
        "SELECT DISTINCT CAST(CAST(ts AS DATE) AS VARCHAR) AS aep_usage_dt FROM events",
    ),
    "parse_comparison": (
        parse_comparison,
        f"""WITH {frames.READINGS_SQL}
            SELECT count(*) AS total_rows, count(*) AS without_offset_null_count,
                   CAST(0 AS BIGINT) AS with_offset_null_count FROM readings""",
    ),
    "run_extent": (
        run_extent,
        f"""{FROM} SELECT min(run_date) AS oldest_run_date, max(run_date) AS latest_run_date
            FROM consume WHERE aep_opco = 'oh'""",
    ),
    "latest_run": (
        latest_run,
        f"""{FROM} SELECT {frames.SHOWN_SQL} FROM consume WHERE aep_opco = 'oh'
            AND run_date = (SELECT max(run_date) FROM consume WHERE aep_opco = 'oh')""",
    ),
    "sql_view": (
        sql_view,
        f"""{FROM} SELECT serialnumber, aep_channel_id, left(endtimeperiod, 10) AS day, value,
                   CASE WHEN value BETWEEN 10 AND 50 THEN 'PASS' ELSE 'FAIL' END AS value_check
            FROM consume WHERE aep_opco = 'oh' AND hdp_insert_dttm >= TIMESTAMP '2024-01-02'
              AND run_date = (SELECT max(run_date) FROM consume WHERE aep_opco = 'oh')""",
    ),
    "ordered_rows": (
        ordered_rows,
        f"""{FROM} SELECT {frames.SHOWN_SQL} FROM consume
            ORDER BY serialnumber, aep_channel_id, endtimeperiod, event_id""",
    ),
    "top_meters": (
        top_meters,
        f"""{FROM} SELECT serialnumber, count(*) AS cnt FROM consume
            GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""",
    ),
    "sample_ordered": (
        sample_ordered,
        f"""{FROM} SELECT serialnumber, aep_channel_id, endtimeperiod, value FROM consume
            ORDER BY serialnumber, aep_channel_id, endtimeperiod LIMIT 150""",
    ),
}
