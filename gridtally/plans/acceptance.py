"""The checks run after a batch, on the consume and the incremental table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.operators import quality

# Column lists of the checks.
SAMPLE_COLUMNS = (
    "serialnumber aep_opco aep_usage_dt endtimeperiod starttimeperiod value "
    "aep_derived_uom aep_raw_uom aep_channel_id aep_meter_bucket"
).split()

DETAIL_COLUMNS = (
    "serialnumber aep_usage_dt aep_derived_uom aep_channel_id "
    "aep_raw_value value aep_service_point aep_premise_nb"
).split()

READING_ORDER = ["serialnumber", "aep_channel_id", "endtimeperiod"]


def device_detail(table: DataFrame, serials: list[str], dates: list[str] | None = None) -> DataFrame:
    """The readings of the named devices, with the columns that an operator looks at."""
    rows = table.filter(F.col("serialnumber").isin(serials))
    if dates is not None:
        rows = rows.filter(F.col("aep_usage_dt").isin(dates))
    return rows.select(*DETAIL_COLUMNS, "endtimeperiod").orderBy(*READING_ORDER)


def tenant_rows(table: DataFrame, tenant: str, dates: list[str] | None = None) -> DataFrame:
    """One tenant's rows, of the given usage dates if any."""
    rows = table.filter(F.col("aep_opco") == tenant)
    return rows if dates is None else rows.filter(F.col("aep_usage_dt").isin(dates))


def record_count_by_date(consume: DataFrame) -> DataFrame:
    return quality.count_by(consume, "aep_usage_dt").orderBy("aep_usage_dt")


def unit_distribution(consume: DataFrame) -> DataFrame:
    by = ["aep_derived_uom", "aep_raw_uom"]
    return quality.count_by(consume, *by, name="cnt").orderBy(F.desc("cnt"), *by)


def bucket_distribution(consume: DataFrame) -> DataFrame:
    counted = quality.count_by(consume, "aep_meter_bucket", name="cnt")
    return counted.orderBy(F.desc("cnt"), "aep_meter_bucket")


def sample_rows(table: DataFrame, n: int = 10, columns: list[str] = SAMPLE_COLUMNS) -> DataFrame:
    """The first ``n`` readings by device, channel and time."""
    return table.orderBy(*READING_ORDER).limit(n).select(*columns)


def changed_rows(
    table: DataFrame, start: datetime, end: datetime | None = None, columns: list[str] | None = None
) -> DataFrame:
    """Rows inserted or updated in the window, in reading order."""
    stamped = table.filter(
        quality.any_stamp_in(["hdp_update_dttm", "hdp_insert_dttm"], start, end)
    )
    return stamped.orderBy(*READING_ORDER).select(*(columns or table.columns))


def acceptance_checks(
    consume: DataFrame, incremental: DataFrame, tenant: str, dates: list[str]
) -> dict[str, DataFrame]:
    """The ten checks by name, for one tenant and the usage dates of a batch."""
    fresh = tenant_rows(consume, tenant, dates)
    runs = tenant_rows(incremental, tenant)
    serial = F.col("serialnumber")
    return {
        "record_count_by_date": record_count_by_date(fresh),
        "total_records": quality.row_count(fresh),
        "incremental_records": quality.count_by(runs, "aep_opco"),
        "distinct_meters": quality.distinct_count(fresh, "serialnumber", "distinct_meters"),
        "sample": sample_rows(fresh),
        "null_serials": quality.row_count(fresh, serial.isNull(), "null_serial_count"),
        "insert_update_split": quality.count_by(fresh, "hdp_update_user"),
        "run_extent": quality.extent(runs, "run_date", "oldest_run_date", "latest_run_date"),
        "unit_distribution": unit_distribution(fresh),
        "bucket_distribution": bucket_distribution(fresh),
    }
