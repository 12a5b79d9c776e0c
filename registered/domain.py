"""Reading operators: flatten, time, scaling, keys, deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally.functions import values
from gridtally.operators.dedup import dedup_latest
from gridtally.operators.flatten import derive_interval_times
from registered import frames


def flatten_readings(spark: SparkSession, sf: str) -> DataFrame:
    return frames.readings(spark, sf).withColumns(
        {"metername": F.trim("metername"), "uom": values.clean_unit(F.col("uom"))}
    ).drop("rawvalue")


def interval_times(spark: SparkSession, sf: str) -> DataFrame:
    """Start, end, offset and epoch of an interval from its end text and length; offsets
    come in all forms, or not at all."""
    sent = F.element_at(
        F.array(*(F.lit(x) for x in ("-05:00", "Z", "-0500", "+05:30", "", "EST"))),
        (F.col("l_linenumber") % 6 + 1).cast("int"),
    )
    li = frames.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.concat(F.date_format(F.col("l_shipdate").cast("date"), "yyyy-MM-dd"), F.lit("T00:05:00"), sent).alias(
            "int_endtime"
        ),
        F.col("l_quantity").cast("int").cast("string").alias("intervallength"),
    )
    return derive_interval_times(li).drop("int_endtime", "intervallength")


def scale_value(spark: SparkSession, sf: str) -> DataFrame:
    li = frames.table(spark, sf, "lineitem")
    flag = F.when(F.col("l_returnflag") != "A", F.when(F.col("l_returnflag") == "R", "Y").otherwise("N"))
    multiplier = F.when(F.col("l_tax") > 0.01, F.col("l_tax"))
    scaled = values.scale_value(F.col("l_quantity"), flag, multiplier)
    return li.select("l_orderkey", "l_linenumber", "l_quantity", "l_tax", F.round(scaled, 6).alias("value"))


def compose_key(spark: SparkSession, sf: str) -> DataFrame:
    cust = frames.table(spark, sf, "customer")
    parts = [
        F.col("c_custkey").cast("string"),
        F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")),
        F.when(F.col("c_nationkey") != 7, F.col("c_nationkey").cast("string")),
    ]
    return cust.select("c_custkey", values.compose_key(parts).alias("aep_service_point"))


def derive_partitions(spark: SparkSession, sf: str) -> DataFrame:
    rows = frames.readings(spark, sf)
    return rows.select(
        F.trim("metername").alias("metername"),
        "macid",
        "channel",
        values.usage_date(F.col("starttime")).alias("aep_usage_dt"),
        values.meter_bucket(F.col("metername")).alias("aep_meter_bucket"),
    )


def dedup_readings(spark: SparkSession, sf: str) -> DataFrame:
    return frames.plain(frames.deduped(spark, sf))


def dedup_latest_event(spark: SparkSession, sf: str) -> DataFrame:
    """The latest event per user, type and day."""
    events = frames.table(spark, sf, "events").withColumn("day", F.col("ts").cast("date").cast("string"))
    latest = dedup_latest(events, ["user_id", "event_type", "day"], [F.desc("ts"), F.desc("event_id")])
    return latest.select("user_id", "event_type", "day", "event_id", "value")


QUERIES = {
    "flatten_readings": (flatten_readings, f"WITH {frames.READINGS_SQL} SELECT * FROM readings"),
    "interval_times": (
        interval_times,
        """SELECT l_orderkey, l_linenumber, o.text AS interval_epoch,
                  strftime(l_shipdate + INTERVAL 5 MINUTE - CAST(l_quantity AS INTEGER) * INTERVAL 1 MINUTE,
                           '%Y-%m-%dT%H:%M:%S') || o.text AS starttime,
                  strftime(l_shipdate, '%Y-%m-%dT00:05:00') || o.text AS endtime,
                  CAST(epoch(l_shipdate) AS BIGINT) + 300 - o.seconds AS unix_endtime
           FROM lineitem LEFT JOIN (VALUES (0, '-05:00', -18000), (1, '+00:00', 0), (2, '-05:00', -18000),
                                           (3, '+05:30', 19800)) AS o(place, text, seconds)
             ON l_linenumber % 6 = o.place""",
    ),
    "scale_value": (
        scale_value,
        """SELECT l_orderkey, l_linenumber, l_quantity, l_tax,
                  round(CASE WHEN l_returnflag = 'R' THEN l_quantity * CASE WHEN l_tax > 0.01 THEN l_tax END
                             ELSE l_quantity END, 6) AS value
           FROM lineitem""",
    ),
    "compose_key": (
        compose_key,
        """SELECT c_custkey, CASE WHEN c_acctbal > 0 AND c_nationkey <> 7
                  THEN c_custkey || '-' || c_mktsegment || '-' || c_nationkey END AS aep_service_point
           FROM customer""",
    ),
    "derive_partitions": (
        derive_partitions,
        f"""WITH {frames.READINGS_SQL}
            SELECT metername, macid, channel, left(starttime, 10) AS aep_usage_dt,
                   right(metername, 2) AS aep_meter_bucket FROM readings""",
    ),
    "dedup_readings": (dedup_readings, f"{frames.TO_DEDUPED} SELECT * FROM output"),
    "dedup_latest": (
        dedup_latest_event,
        """SELECT user_id, event_type, day, event_id, value FROM (
             SELECT *, strftime(ts, '%Y-%m-%d') AS day,
                    row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE)
                                       ORDER BY ts DESC, event_id DESC) AS rn
             FROM events) WHERE rn = 1""",
    ),
}
