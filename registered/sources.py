"""File selection and scans."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally import config
from gridtally.functions import times
from gridtally.operators import quality
from gridtally.operators.flatten import flatten_readings
from gridtally.session import work_path
from gridtally.sinks.staging import stage
from gridtally.sources.documents import read_documents
from gridtally.sources.files import (
    delivered_files,
    limit_files,
    marked_directories,
    refuse_hidden,
    select_batch_files,
)
from gridtally.sources.tables import read_extract, read_parquet, read_table, union_sources
from registered import frames

BASE = "store/raw"
ZONE = "America/New_York"
HOUR = timedelta(hours=1)


def listing(spark: SparkSession, sf: str) -> DataFrame:
    """A file listing with one file per event: a directory per user, a marker per signup."""
    kind, text = F.col("event_type"), F.col("event_id").cast("string")
    name = (
        F.when(kind == "signup", "/index.txt")
        .when(kind == "click", F.concat(F.lit("/part/f"), text, F.lit(".xml.gz")))
        .when(kind == "view", "/part/deep/index.txt")
        .when(kind == "error", F.concat(F.lit("/f"), text, F.lit(".log")))
        .otherwise(F.concat(F.lit("/f"), text, F.lit(".xml")))
    )
    return frames.table(spark, sf, "events").select(
        F.concat(F.lit(BASE + "/d"), F.col("user_id").cast("string"), name).alias("path"),
        F.floor("value").alias("length"),
        F.timestamp_seconds(times.zone_epoch(F.col("ts"), "UTC")).alias("modificationTime"),
    )


def batch_select(spark: SparkSession, sf: str) -> DataFrame:
    start = times.batch_bound("2024-01-10 00:00:00", ZONE)
    end = times.batch_bound("2024-01-10 06:00:00", ZONE)
    return select_batch_files(listing(spark, sf), BASE, start, end)


SELECT_SQL = f"""
WITH files AS (
  SELECT '{BASE}/d' || user_id AS dir, event_type, CAST(floor(value) AS BIGINT) AS length,
         date_trunc('second', ts) AS landed,
         CASE event_type WHEN 'click' THEN '/part/f' || event_id || '.xml.gz'
                         WHEN 'purchase' THEN '/f' || event_id || '.xml' END AS name
  FROM events
)
SELECT dir, dir || name AS path FROM files
WHERE event_type IN ('click', 'purchase') AND length > 0
  AND dir IN (SELECT dir FROM files WHERE event_type = 'signup'
              AND landed >= TIMESTAMP '2024-01-10 05:00:00'
              AND landed < TIMESTAMP '2024-01-10 11:00:00')
"""


def first_files(spark: SparkSession, sf: str) -> DataFrame:
    return limit_files(batch_select(spark, sf), 10)


def batch_window(spark: SparkSession, sf: str) -> DataFrame:
    """Files landed in a window given as New York wall-clock text."""
    start = times.batch_bound("2024-01-15 18:00:00", ZONE)
    end = times.batch_bound("2024-01-16 18:00:00", ZONE)
    landed = F.col("modificationTime")
    return quality.row_count(listing(spark, sf), (landed >= start) & (landed < end), "files")


def union_types(spark: SparkSession, sf: str) -> DataFrame:
    """One frame per event type and one for the rest, put back together by column name."""
    events = frames.table(spark, sf, "events").select("event_id", "event_type", "user_id", "value")
    kinds = ["click", "view", "purchase", "signup", "error"]
    parts = [events.filter(F.col("event_type") == k) for k in kinds]
    parts.append(events.filter(~F.coalesce(F.col("event_type").isin(kinds), F.lit(False))))
    return union_sources(parts[:2] + [p.select(*reversed(p.columns)) for p in parts[2:]])


def scan_columns(spark: SparkSession, sf: str) -> DataFrame:
    orders = read_parquet(spark, f"{sf}/orders.parquet")
    return orders.select("o_orderkey", "o_orderstatus", "o_totalprice")


def event_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Every event as one nested document with one reading."""
    end = times.iso_wall(F.date_trunc("MINUTE", F.col("ts")).cast("timestamp_ntz"))
    stamp = F.concat(end, F.lit("-05:00"))
    reading = F.struct(
        F.col("event_type").alias("_Channel"),
        F.lit("0").alias("_RawValue"),
        F.col("value").cast("string").alias("_Value"),
        F.lit(" kWh(rec) ").alias("_UOM"),
        F.lit(None).cast("string").alias("_BlockEndValue"),
    )
    interval = F.struct(
        stamp.alias("_EndTime"),
        F.col("event_id").cast("string").alias("_BlockSequenceNumber"),
        stamp.alias("_GatewayCollectedTime"),
        F.lit("1").alias("_IntervalSequenceNumber"),
        F.array(reading).alias("Reading"),
    )
    block = F.struct(
        F.lit("1").alias("_NumberIntervals"),
        stamp.alias("_EndTime"),
        stamp.alias("_StartTime"),
        F.lit("15").alias("_IntervalLength"),
        F.array(interval).alias("Interval"),
    )
    return frames.table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("_MeterName"),
        F.lit("u").alias("_UtilDeviceID"),
        F.lit("m").alias("_MacID"),
        F.array(block).alias("IntervalReadData"),
    )


def xml_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Events written as XML documents, scanned with the fixed schema and flattened."""
    path = work_path(spark, "xml")
    written = event_documents(spark, sf).write.format("xml")
    written.option("rootTag", "Root").option("rowTag", "MeterData").save(path)
    return _flat_events(read_documents(spark, [path], ext="part-"))


def _flat_events(docs: DataFrame) -> DataFrame:
    return flatten_readings(docs).select(
        F.col("metername"),
        F.col("int_blocksequencenumber").alias("sequence"),
        "starttime",
        "endtime",
        "unix_endtime",
        "channel",
        "value",
        F.trim("uom").alias("uom"),
    )


XML_SQL = """
SELECT CAST(user_id AS VARCHAR) AS metername, CAST(event_id AS VARCHAR) AS sequence,
       strftime(date_trunc('minute', ts) - INTERVAL 15 MINUTE, '%Y-%m-%dT%H:%M:%S-05:00') AS starttime,
       strftime(date_trunc('minute', ts), '%Y-%m-%dT%H:%M:%S-05:00') AS endtime,
       CAST(epoch(date_trunc('minute', ts)) AS BIGINT) + 18000 AS unix_endtime,
       event_type AS channel, CAST(value AS VARCHAR) AS value, 'kWh(rec)' AS uom
FROM events
"""


def delivered(spark: SparkSession, sf: str) -> str:
    """A store with a directory of XML files per event type and markers in two of them."""
    base = work_path(spark, "store")
    written = event_documents(spark, sf).withColumn(
        "kind", F.coalesce(F.col("IntervalReadData")[0].Interval[0].Reading[0]._Channel, F.lit("none"))
    )
    out = written.write.format("xml").option("rootTag", "Root").option("rowTag", "MeterData")
    out.partitionBy("kind").save(base)
    context = spark.sparkContext
    for name in MARKED:
        marker = context._jvm.org.apache.hadoop.fs.Path(f"{base}/kind={name}/{config.MARKER_FILE}")
        system = marker.getFileSystem(context._jsc.hadoopConfiguration())
        system.create(marker).close()
    return base


MARKED = ["click", "view"]


def live_selection(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of the directories whose marker landed within the last hour."""
    base, now = delivered(spark, sf), datetime.now(timezone.utc)
    directories = marked_directories(spark, base, now - HOUR, now + HOUR)
    refuse_hidden(spark, directories)
    return _flat_events(read_documents(spark, directories))


def empty_window(spark: SparkSession, sf: str) -> DataFrame:
    """Files selected by a window in which no marker landed."""
    base, now = delivered(spark, sf), datetime.now(timezone.utc)
    directories = marked_directories(spark, base, now - 3 * HOUR, now - 2 * HOUR)
    return quality.row_count(delivered_files(spark, base, directories), name="files")


def catalog_table(spark: SparkSession, sf: str) -> DataFrame:
    """A table of the session catalog, with its data in the shared folder."""
    path = work_path(spark, "catalog")
    name = "orders_" + path.rsplit("-", 1)[1]
    frames.table(spark, sf, "orders").write.option("path", path).saveAsTable(name)
    return read_table(spark, name).select("o_orderkey", "o_orderstatus", "o_totalprice")


def extract_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Consume rows written as a CSV extract and read back; empty fields are NULL."""
    path = work_path(spark, "extract")
    consume = frames.consume(spark, sf)
    cells = [
        (F.col(c).cast("string") if c in consume.columns else F.lit(None).cast("string")).alias(c)
        for c in config.EXTRACT_COLUMNS
    ]
    consume.select(*cells).write.option("header", True).csv(path)
    shown = "serialnumber aep_usage_dt aep_channel_id aep_raw_uom endtimeperiod aep_derived_uom"
    shown += " aep_premise_nb aep_meter_bucket hdp_update_user aep_city"
    return read_extract(spark, path).select(*shown.split())


def staged_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Readings staged by usage date and read back; the date column keeps its text type."""
    consume = frames.consume(spark, sf).select(
        *frames.CONSUME_SHOWN, F.col("aep_usage_dt").cast("string").alias("aep_usage_dt")
    )
    return stage(consume, work_path(spark, "staged"), partition_by=["aep_usage_dt"])


def staged_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Row count of the staged documents."""
    staged = stage(frames.documents(spark, sf), work_path(spark, "documents"))
    return quality.row_count(staged, name="documents")


QUERIES = {
    "batch_select": (batch_select, SELECT_SQL),
    "limit_files": (first_files, SELECT_SQL + " ORDER BY dir, path LIMIT 10"),
    "batch_window": (
        batch_window,
        """SELECT count(*) AS files FROM events
           WHERE date_trunc('second', ts) >= TIMESTAMP '2024-01-15 23:00:00'
             AND date_trunc('second', ts) < TIMESTAMP '2024-01-16 23:00:00'""",
    ),
    "union_sources": (union_types, "SELECT event_id, event_type, user_id, value FROM events"),
    "scan_columns": (scan_columns, "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders"),
    "xml_scan": (xml_scan, XML_SQL),
    "staged_scan": (
        staged_scan,
        f"""{frames.FROM_CONSUME}
            SELECT {frames.SHOWN_SQL}, CAST(aep_usage_dt AS VARCHAR) AS aep_usage_dt FROM consume""",
    ),
    "staged_metrics": (staged_metrics, "SELECT count(*) AS documents FROM lineitem"),
    "live_selection": (
        live_selection,
        XML_SQL + " WHERE event_type IN ('click', 'view')",
    ),
    "empty_window": (empty_window, "SELECT count(*) AS files FROM events WHERE false"),
    "catalog_table": (
        catalog_table, "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders"
    ),
    "extract_rows": (
        extract_rows,
        f"""{frames.FROM_CONSUME}
            SELECT serialnumber, CAST(aep_usage_dt AS VARCHAR) AS aep_usage_dt, aep_channel_id,
                   aep_raw_uom, endtimeperiod, aep_derived_uom, aep_premise_nb, aep_meter_bucket,
                   hdp_update_user, CAST(NULL AS VARCHAR) AS aep_city FROM consume""",
    ),
}
