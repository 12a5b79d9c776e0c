"""Projections, filters and scalar expressions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally import config
from gridtally.functions import times, values
from gridtally.operators import quality
from gridtally.operators.flatten import explode_intervals, name_documents
from gridtally.plans import acceptance, views
from registered import frames


def renamed_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Documents under plain names with the batch label."""
    named = name_documents(frames.documents(spark, sf), times.batch_label(datetime(2026, 1, 15)))
    return named.select("metername", "utildeviceid", "macid", "part_date")


def nested_fields(spark: SparkSession, sf: str) -> DataFrame:
    intervals = explode_intervals(name_documents(frames.documents(spark, sf)))
    return intervals.select(
        F.trim("metername").alias("metername"),
        "intervallength",
        "blockstarttime",
        "int_blocksequencenumber",
        F.size("int_reading").alias("readings"),
    )


def stage_view(spark: SparkSession, sf: str) -> DataFrame:
    return frames.staged(spark, sf)


def standard_view(spark: SparkSession, sf: str) -> DataFrame:
    return frames.plain(views.standard_view(frames.staged(spark, sf), frames.TENANT, frames.RUN_TS))


def output_view(spark: SparkSession, sf: str) -> DataFrame:
    return frames.plain(frames.output(spark, sf))


def tenant_rows(spark: SparkSession, sf: str) -> DataFrame:
    return acceptance.tenant_rows(frames.consume(spark, sf), "oh").select(*frames.CONSUME_SHOWN)


def in_list_rows(spark: SparkSession, sf: str) -> DataFrame:
    dates = ["2024-01-10", "2024-01-11"]
    rows = acceptance.tenant_rows(frames.consume(spark, sf), "oh", dates)
    return rows.select(*frames.CONSUME_SHOWN)


def since_date(spark: SparkSession, sf: str) -> DataFrame:
    rows = frames.consume(spark, sf).filter(F.col("aep_usage_dt") >= "2024-01-20")
    return rows.select("event_id", "serialnumber")


def company_rows(spark: SparkSession, sf: str) -> DataFrame:
    codes = list(frames.TENANT.company_codes)
    dim = frames.validity(spark, sf).filter(F.col("co_cd_ownr").isin(codes))
    return dim.select("mfr_devc_ser_nbr", "prem_nb", "acct_turn_on_dt", "acct_turn_off_dt")


def date_floor(spark: SparkSession, sf: str) -> DataFrame:
    """Order dates at or after a date, given as ISO text with offset; bad text drops out."""
    text = F.when(F.col("o_orderstatus") == "P", "no date").otherwise(
        F.concat(times.iso_wall(F.col("o_orderdate")), F.lit("-05:00"))
    )
    kept = times.wall_date(text) >= F.lit("1998-03-01").cast("date")
    return frames.table(spark, sf, "orders").filter(kept).select("o_orderkey")


def safe_casts(spark: SparkSession, sf: str) -> DataFrame:
    """Text to number casts that give NULL on text that is no number."""
    part = frames.table(spark, sf, "part")
    digits = F.substring_index("p_brand", "#", -1)
    return part.select(
        "p_partkey",
        values.as_int(digits).alias("brand_no"),
        values.as_double(digits).alias("brand_value"),
        values.as_int(F.col("p_name")).alias("name_no"),
        F.col("p_partkey").cast("string").alias("key_text"),
    )


def null_probe(spark: SparkSession, sf: str) -> DataFrame:
    consume = frames.consume(spark, sf)
    return quality.row_count(consume, F.col("aep_premise_nb").isNull(), "null_premise_count")


def within_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """Closed intervals include both ends; a NULL bound includes nothing."""
    high = F.when(F.col("l_returnflag") != "N", F.lit(30.0))
    rows = frames.table(spark, sf, "lineitem").filter(F.col("l_quantity").between(10.0, high))
    return rows.select("l_orderkey", "l_linenumber", "l_quantity")


def range_or_filter(spark: SparkSession, sf: str) -> DataFrame:
    changed = quality.any_stamp_in(
        ["hdp_update_dttm", "hdp_insert_dttm"], datetime(2024, 1, 10), datetime(2024, 1, 11)
    )
    return frames.consume(spark, sf).filter(changed).select(*frames.CONSUME_SHOWN)


def point_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """One device and channel within one usage date."""
    day = frames.consume(spark, sf).filter(F.col("aep_usage_dt") == "2024-01-01")
    rows = quality.point_lookup(day, serialnumber="700000008", aep_channel_id="error")
    return rows.orderBy("event_id").limit(1).select("event_id", "serialnumber", "value")


def full_rows(spark: SparkSession, sf: str) -> DataFrame:
    return frames.table(spark, sf, "customer")


def text_functions(spark: SparkSession, sf: str) -> DataFrame:
    cust = frames.table(spark, sf, "customer")
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    some = F.when(F.col("c_acctbal") > 0, segment)
    return cust.select(
        "c_custkey",
        values.clean_unit(F.concat(F.lit("  "), segment, F.lit(" "))).alias("unit"),
        F.upper(F.lower(segment)).alias("upper_unit"),
        values.meter_bucket(F.concat(name, F.lit(" "))).alias("bucket"),
        values.authority(name).alias("authority"),
        F.concat(name, some).alias("null_concat"),
        values.joined_text([some, F.lit(None).cast("string"), name]).alias("joined"),
        values.or_unknown(some).alias("or_unknown"),
        values.register_name(F.lit("E-mtr_ivl_len-T"), F.col("c_nationkey").cast("string")).alias(
            "register"
        ),
    )


def time_functions(spark: SparkSession, sf: str) -> DataFrame:
    """ISO text with a ``Z`` or numeric offset, taken apart and put together again."""
    zone = F.when(F.col("event_type") == "click", "Z").otherwise("+05:30")
    wall = F.substring(times.iso_wall(F.col("ts")), 1, 19)
    text = F.concat(wall, zone)
    return frames.table(spark, sf, "events").select(
        "event_id",
        times.offset(text).alias("zone"),
        times.epoch_of(text).alias("epoch"),
        times.iso_wall(times.wall_time(text)).alias("wall"),
        times.iso_wall(times.minutes_before(times.wall_time(text), F.lit(1440))).alias("day_before"),
        F.date_format(times.wall_date(text), "yyyyMMdd").alias("day"),
        values.usage_date(text).alias("usage_date"),
    )


SHOWN = frames.SHOWN_SQL
STANDARD_SELECT = ", ".join(config.STANDARD_COLUMNS)
OUTPUT_SELECT = ", ".join(config.OUTPUT_COLUMNS)

QUERIES = {
    "renamed_labels": (
        renamed_labels,
        """SELECT ' 9' || lpad(CAST(l_suppkey AS VARCHAR), 8, '0') AS metername,
                  'u' || l_partkey AS utildeviceid, 'm' || l_orderkey AS macid,
                  '20260115_0000' AS part_date FROM lineitem""",
    ),
    "nested_fields": (
        nested_fields,
        f"""WITH {frames.READINGS_SQL}
            SELECT metername, intervallength, blockstarttime, int_blocksequencenumber, 4 AS readings
            FROM readings WHERE channel = '101'""",
    ),
    "stage_view": (stage_view, f"{frames.TO_STAGE} SELECT * FROM stage"),
    "standard_view": (
        standard_view, f"{frames.TO_STANDARD} SELECT {STANDARD_SELECT} FROM standard"
    ),
    "output_view": (output_view, f"{frames.TO_OUTPUT} SELECT {OUTPUT_SELECT} FROM output"),
    "tenant_filter": (
        tenant_rows, f"{frames.FROM_CONSUME} SELECT {SHOWN} FROM consume WHERE aep_opco = 'oh'"
    ),
    "in_list_rows": (
        in_list_rows,
        f"""{frames.FROM_CONSUME} SELECT {SHOWN} FROM consume WHERE aep_opco = 'oh'
            AND aep_usage_dt IN (DATE '2024-01-10', DATE '2024-01-11')""",
    ),
    "since_date": (
        since_date,
        f"""{frames.FROM_CONSUME} SELECT event_id, serialnumber FROM consume
            WHERE aep_usage_dt >= DATE '2024-01-20'""",
    ),
    "company_rows": (
        company_rows,
        f"""WITH {frames.VALIDITY_SQL}
            SELECT mfr_devc_ser_nbr, prem_nb, acct_turn_on_dt, acct_turn_off_dt FROM validity""",
    ),
    "date_floor": (
        date_floor,
        """SELECT o_orderkey FROM orders
           WHERE o_orderstatus <> 'P' AND o_orderdate >= DATE '1998-03-01'""",
    ),
    "safe_casts": (
        safe_casts,
        """SELECT p_partkey, TRY_CAST(split_part(p_brand, '#', 2) AS INTEGER) AS brand_no,
                  TRY_CAST(split_part(p_brand, '#', 2) AS DOUBLE) AS brand_value,
                  TRY_CAST(p_name AS INTEGER) AS name_no, CAST(p_partkey AS VARCHAR) AS key_text
           FROM part""",
    ),
    "null_probe": (
        null_probe,
        f"""{frames.FROM_CONSUME} SELECT count(*) AS null_premise_count FROM consume
            WHERE aep_premise_nb IS NULL""",
    ),
    "within_bounds": (
        within_bounds,
        """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
           WHERE l_quantity BETWEEN 10 AND CASE WHEN l_returnflag <> 'N' THEN 30 END""",
    ),
    "range_or_filter": (
        range_or_filter,
        f"""{frames.FROM_CONSUME} SELECT {SHOWN} FROM consume
            WHERE (hdp_update_dttm >= TIMESTAMP '2024-01-10' AND hdp_update_dttm < TIMESTAMP '2024-01-11')
               OR (hdp_insert_dttm >= TIMESTAMP '2024-01-10' AND hdp_insert_dttm < TIMESTAMP '2024-01-11')""",
    ),
    "point_lookup": (
        point_lookup,
        f"""{frames.FROM_CONSUME} SELECT event_id, serialnumber, value FROM consume
            WHERE aep_usage_dt = DATE '2024-01-01' AND serialnumber = '700000008'
              AND aep_channel_id = 'error' ORDER BY event_id LIMIT 1""",
    ),
    "full_rows": (full_rows, "SELECT * FROM customer"),
    "text_functions": (
        text_functions,
        """SELECT c_custkey, lower(c_mktsegment) AS unit, upper(c_mktsegment) AS upper_unit,
                  right(c_name, 2) AS bucket, left(c_name, 2) AS authority,
                  CASE WHEN c_acctbal > 0 THEN c_name || c_mktsegment END AS null_concat,
                  CASE WHEN c_acctbal > 0 THEN c_mktsegment ELSE '' END || c_name AS joined,
                  CASE WHEN c_acctbal > 0 THEN c_mktsegment ELSE 'UNK' END AS or_unknown,
                  'E-' || c_nationkey || '-T' AS register
           FROM customer""",
    ),
    "time_functions": (
        time_functions,
        """SELECT event_id, CASE WHEN event_type = 'click' THEN '+00:00' ELSE '+05:30' END AS zone,
                  CAST(epoch(date_trunc('second', ts)) AS BIGINT)
                    - CASE WHEN event_type = 'click' THEN 0 ELSE 19800 END AS epoch,
                  strftime(ts, '%Y-%m-%dT%H:%M:%S') AS wall,
                  strftime(ts - INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%S') AS day_before,
                  strftime(ts, '%Y%m%d') AS day, strftime(ts, '%Y-%m-%d') AS usage_date
           FROM events""",
    ),
}
