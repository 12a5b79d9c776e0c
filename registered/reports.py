"""Quality, match-rate and activity reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally.operators import bitmaps, quality
from gridtally.plans import acceptance
from gridtally.session import work_path
from gridtally.sinks.staging import stage
from gridtally.sources.tables import read_parquet
from registered import frames

QUALITY_SELECT = """
count(*) AS total_records, count(DISTINCT serialnumber) AS unique_meters,
count(DISTINCT aep_channel_id) AS unique_channels,
count(*) FILTER (aep_premise_nb IS NULL) AS null_premise_count,
count(*) FILTER (aep_premise_nb IS NOT NULL) AS matched_premise_count,
count(*) FILTER (aep_derived_uom = 'UNK') AS unknown_uom_count,
count(*) FILTER (value IS NULL) AS null_value_count,
count(*) FILTER (scalarfloat IS NULL) AS null_scalarfloat_count,
count(*) FILTER (aep_city IS NULL) AS null_city_count,
count(*) FILTER (authority IS NULL) AS null_authority_count
"""


def batch_quality_report(spark: SparkSession, sf: str) -> DataFrame:
    """The whole batch on documents: flatten, enrich, standardise, deduplicate, report by date."""
    return quality.quality_report(frames.deduped(spark, sf))


def merged_quality_report(spark: SparkSession, sf: str) -> DataFrame:
    """The same report from partial reports of three batches, stored with their bitmaps."""
    rows = stage(frames.deduped(spark, sf), work_path(spark, "readings"))
    path, numbers = work_path(spark, "partials"), {}
    for third in range(3):
        batch = rows.filter(F.pmod(F.xxhash64("serialnumber", "endtimeperiod"), F.lit(3)) == third)
        for column in ("serialnumber", "aep_channel_id"):
            fresh = bitmaps.assign_numbers(batch.select(column), numbers.get(column))
            numbers[column] = stage(fresh, work_path(spark, f"numbers-{column}"))
        part = bitmaps.partial_report(batch, numbers)
        part.write.mode("append").parquet(path)
    return bitmaps.merged_report(read_parquet(spark, path, part.schema))


def event_quality_report(spark: SparkSession, sf: str) -> DataFrame:
    consume = frames.consume(spark, sf)
    flags = {
        "null_premise_count": F.col("aep_premise_nb").isNull(),
        "unknown_uom_count": F.col("aep_derived_uom") == "UNK",
    }
    by_tenant = quality.quality_report(consume, by=("aep_opco", "run_date"), flags=flags)
    return by_tenant


def match_rate(spark: SparkSession, sf: str) -> DataFrame:
    return quality.premise_match_rate(frames.staged(spark, sf))


def activity(spark: SparkSession, sf: str) -> DataFrame:
    return quality.activity(frames.consume(spark, sf), datetime(2024, 1, 10), datetime(2024, 1, 12))


def changed_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = acceptance.changed_rows(frames.consume(spark, sf), datetime(2024, 1, 25))
    return rows.select(*frames.CONSUME_SHOWN)


def audit_stamps(spark: SparkSession, sf: str) -> DataFrame:
    """Insert and update stamp of a run on every row, counted."""
    output = frames.output(spark, sf).withColumns(
        {
            "inserted": F.unix_seconds("hdp_insert_dttm"),
            "updated": F.unix_seconds("hdp_update_dttm"),
        }
    )
    return quality.count_by(output, "hdp_update_user", "inserted", "updated")


def device_detail(spark: SparkSession, sf: str) -> DataFrame:
    """The stored readings of two devices."""
    rows = acceptance.device_detail(frames.deduped(spark, sf), ["900000001", "900000003"])
    return frames.plain(rows)


QUERIES = {
    "device_detail": (
        device_detail,
        f"""{frames.TO_DEDUPED}
            SELECT {", ".join(acceptance.DETAIL_COLUMNS)}, endtimeperiod FROM output
            WHERE serialnumber IN ('900000001', '900000003')""",
    ),
    "batch_quality_report": (
        batch_quality_report,
        f"""{frames.TO_DEDUPED}
            SELECT aep_usage_dt, {QUALITY_SELECT} FROM output GROUP BY 1 ORDER BY 1""",
    ),
    "merged_quality_report": (
        merged_quality_report,
        f"""{frames.TO_DEDUPED}
            SELECT aep_usage_dt, {QUALITY_SELECT} FROM output GROUP BY 1 ORDER BY 1""",
    ),
    "event_quality_report": (
        event_quality_report,
        f"""{frames.FROM_CONSUME}
            SELECT aep_opco, run_date, count(*) AS total_records,
                   count(DISTINCT serialnumber) AS unique_meters,
                   count(DISTINCT aep_channel_id) AS unique_channels,
                   count(*) FILTER (aep_premise_nb IS NULL) AS null_premise_count,
                   count(*) FILTER (aep_derived_uom = 'UNK') AS unknown_uom_count
            FROM consume GROUP BY 1, 2 ORDER BY 1, 2""",
    ),
    "match_rate": (
        match_rate,
        f"""{frames.TO_STAGE}
            SELECT count(*) AS total_rows,
                   count(*) FILTER (aep_premise_nb IS NOT NULL) AS matched_premise_count,
                   count(*) FILTER (aep_premise_nb IS NULL) AS null_premise_count,
                   count(*) FILTER (bill_cnst IS NULL) AS null_bill_cnst_count,
                   count(*) FILTER (aep_city IS NULL) AS null_city_count,
                   count(*) FILTER (aep_meter_program IS NULL) AS null_meter_program_count
            FROM stage""",
    ),
    "activity": (
        activity,
        f"""{frames.FROM_CONSUME}
            SELECT hdp_update_user, count(*) AS record_count FROM consume
            WHERE (hdp_insert_dttm >= TIMESTAMP '2024-01-10' AND hdp_insert_dttm < TIMESTAMP '2024-01-12')
               OR (hdp_update_dttm >= TIMESTAMP '2024-01-10' AND hdp_update_dttm < TIMESTAMP '2024-01-12')
            GROUP BY 1""",
    ),
    "changed_rows": (
        changed_rows,
        f"""{frames.FROM_CONSUME}
            SELECT {frames.SHOWN_SQL} FROM consume
            WHERE hdp_insert_dttm >= TIMESTAMP '2024-01-25' OR hdp_update_dttm >= TIMESTAMP '2024-01-25'
            ORDER BY serialnumber, aep_channel_id, endtimeperiod""",
    ),
    "audit_stamps": (
        audit_stamps,
        f"""{frames.TO_OUTPUT}
            SELECT hdp_update_user, hdp_insert_dttm AS inserted, hdp_update_dttm AS updated,
                   count(*) AS record_count
            FROM output GROUP BY ALL""",
    ),
}
