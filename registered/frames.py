"""Interval data derived from the given tables, as Spark frames and as SQL.

* ``documents``: every lineitem row as one nested document with one interval
  and four channel readings. The supplier is the device.
* ``validity``: two validity rows per supplier.
* ``consume``: every event as one row of a consume-like table.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally import config
from gridtally.functions import times
from gridtally.operators.flatten import flatten_readings
from gridtally.plans import views
from gridtally.sources.tables import read_parquet, unit_map

TENANT = config.tenant("oh")
RUN_TS = datetime(2026, 1, 15, 12, 0, 0, tzinfo=timezone.utc)
LABEL = "20260115_0000"

# Ship dates are moved by this many days, so the date floor cuts through them.
SHIFT_DAYS = 6209


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return as_documents(table(spark, sf, "lineitem"))


def as_documents(lineitem: DataFrame) -> DataFrame:
    minutes = F.when(F.col("l_returnflag") == "N", 60).otherwise(15)
    zone = F.when(F.col("l_linestatus") == "O", "Z").otherwise("-05:00")
    shifted = F.timestamp_add("DAY", F.lit(SHIFT_DAYS), F.col("l_shipdate"))

    def iso(moment: Column) -> Column:
        return F.concat(times.iso_wall(moment), zone)

    # The collection time of half of the readings is sent with another offset.
    moment = F.timestamp_add("MINUTE", F.col("l_quantity").cast("int") % 3, F.col("end"))
    ahead = F.timestamp_add("HOUR", F.lit(1), moment)
    ahead_zone = F.when(F.col("l_linestatus") == "O", "+01:00").otherwise("-0400")

    li = (
        lineitem.withColumn("end", F.timestamp_add("MINUTE", F.col("l_linenumber") * 15, shifted))
        .withColumns(
            {
                "end_text": iso(F.col("end")),
                "start_text": iso(times.minutes_before(F.col("end"), minutes)),
                "collected": F.when(
                    F.col("l_partkey") % 2 == 1, F.concat(times.iso_wall(ahead), ahead_zone)
                ).otherwise(iso(moment)),
                "length": minutes.cast("string"),
                "sequence": (F.col("l_orderkey") % 15).cast("string"),
                "block_sequence": F.col("l_linenumber").cast("string"),
            }
        )
    )

    def reading(channel: str, amount: Column, unit: str) -> Column:
        return F.struct(
            F.lit(channel).alias("_Channel"),
            amount.cast("string").alias("_RawValue"),
            amount.cast("string").alias("_Value"),
            F.lit(unit).alias("_UOM"),
            F.lit(None).cast("string").alias("_BlockEndValue"),
        )

    taxed = F.when(F.col("l_tax") > 0, F.col("l_tax"))
    readings = F.array(
        reading("101", F.col("l_quantity"), " kWh(del) "),
        reading("102", F.col("l_extendedprice"), "kWh(rec)"),
        reading("103", F.col("l_discount"), "kVARh"),
        reading("109", taxed, "V"),
    )
    interval = F.struct(
        F.col("end_text").alias("_EndTime"),
        F.col("block_sequence").alias("_BlockSequenceNumber"),
        F.col("collected").alias("_GatewayCollectedTime"),
        F.col("sequence").alias("_IntervalSequenceNumber"),
        readings.alias("Reading"),
    )
    block = F.struct(
        F.lit("1").alias("_NumberIntervals"),
        F.col("end_text").alias("_EndTime"),
        F.col("start_text").alias("_StartTime"),
        F.col("length").alias("_IntervalLength"),
        F.array(interval).alias("Interval"),
    )
    return li.select(
        F.concat(F.lit(" "), (F.lit(900000000) + F.col("l_suppkey")).cast("string")).alias(
            "_MeterName"
        ),
        F.concat(F.lit("u"), F.col("l_partkey").cast("string")).alias("_UtilDeviceID"),
        F.concat(F.lit("m"), F.col("l_orderkey").cast("string")).alias("_MacID"),
        F.array(block).alias("IntervalReadData"),
    )


def units(spark: SparkSession) -> DataFrame:
    """A unit map of two tenants with one repeated row; channel 109 of ``oh`` is not mapped.

    A relation of literals, whose size Spark knows: the lookup is broadcast and readings are not
    shuffled by their few channels.
    """
    return spark.sql(
        """SELECT * FROM VALUES
            ('oh', '101', 'kwh', 'E-KWH-mtr_ivl_len-TOT', 'TOT', 'kwh(del)', 'Y'),
            ('oh', '101', 'kwh', 'E-KWH-mtr_ivl_len-TOT', 'TOT', 'kwh(del)', 'Y'),
            ('oh', '102', 'kwh', 'E-KWH-mtr_ivl_len-REC', 'REC', 'kwh(rec)', 'N'),
            ('oh', '103', 'kvarh', 'E-KVARH-mtr_ivl_len', 'VAR', 'kvarh', NULL),
            ('ap', '109', 'volt', 'E-V-mtr_ivl_len', 'VOL', 'v', 'Y')
        AS units(aep_opco, aep_channel_id, aep_derived_uom, name_register,
                 aep_srvc_qlty_idntfr, aep_raw_uom, value_mltplr_flg)"""
    )


def validity(spark: SparkSession, sf: str) -> DataFrame:
    sup = table(spark, sf, "supplier")
    key = F.col("s_suppkey")
    text = key.cast("string")
    owner = (
        F.when(F.col("s_nationkey") < 10, "07").when(F.col("s_nationkey") < 18, "10").otherwise("04")
    )
    closed = F.when(F.col("s_acctbal") > 5000, "2017-06-30").otherwise("9999-01-01")

    def period(inst: str, removal: str, on: str, off: Column, suffix: str) -> Column:
        return F.struct(
            F.lit(inst).alias("mtr_inst_ts"),
            F.lit(removal).alias("mtr_rmvl_ts"),
            F.lit(on).alias("acct_turn_on_dt"),
            off.alias("acct_turn_off_dt"),
            F.lit(suffix).alias("suffix"),
        )

    periods = F.array(
        period("2010-01-01 00:00:00", "2016-06-30 23:59:59", "2010-01-01", F.lit("2016-07-01"), "1"),
        period("2016-07-01 00:00:00", "9999-01-01", "2016-07-01", closed, "2"),
    )
    return sup.select("*", F.inline(periods)).select(
        owner.alias("co_cd_ownr"),
        F.concat(owner, F.lpad(text, 7, "0"), F.col("suffix")).alias("prem_nb"),
        F.when(F.col("s_acctbal") > 0, (F.col("s_nationkey") + 1).cast("string")).alias("bill_cnst"),
        F.lit("R").alias("acct_clas_cd"),
        F.lit("A").alias("acct_type_cd"),
        F.concat(F.lit("dev"), F.col("suffix")).alias("devc_cd"),
        F.when(F.col("s_nationkey") != 3, "AMI").alias("pgm_id_nm"),
        F.lit(None).cast("string").alias("tx_mand_data"),
        F.lit("D").alias("doe_nb"),
        text.alias("serv_deliv_id"),
        (F.lit(900000000) + key).cast("string").alias("mfr_devc_ser_nbr"),
        "mtr_inst_ts",
        "mtr_rmvl_ts",
        "acct_turn_on_dt",
        "acct_turn_off_dt",
        F.concat(F.lit("b"), text).alias("bill_acct_nb"),
        F.when(F.col("s_nationkey") != 5, F.concat(F.lit("mp"), text)).alias("mtr_pnt_nb"),
        F.concat(F.lit("tp"), text).alias("tarf_pnt_nb"),
        F.concat(F.lit("City"), F.col("s_nationkey").cast("string")).alias("serv_city_ad"),
        F.lpad(text, 9, "4").alias("serv_zip_ad"),
        F.lit("ZZ").alias("state_cd"),
    )


def readings(spark: SparkSession, sf: str) -> DataFrame:
    return flatten_readings(documents(spark, sf), LABEL)


def unit_readings(spark: SparkSession, sf: str) -> DataFrame:
    return views.enrich_units(readings(spark, sf), unit_map(units(spark), TENANT.code))


def validity_dim(spark: SparkSession, sf: str) -> DataFrame:
    return views.prepare_validity_dim(validity(spark, sf), TENANT.company_codes)


def deduped(spark: SparkSession, sf: str) -> DataFrame:
    """Output rows of the chosen readings."""
    chosen = views.dedup_readings(readings(spark, sf))
    units_of_tenant = unit_map(units(spark), TENANT.code)
    return views.readings_view(chosen, units_of_tenant, validity_dim(spark, sf), TENANT, RUN_TS)


def staged(spark: SparkSession, sf: str) -> DataFrame:
    enriched = views.enrich_premise(unit_readings(spark, sf), validity_dim(spark, sf))
    return views.stage_view(enriched, TENANT)


def output(spark: SparkSession, sf: str) -> DataFrame:
    return views.output_view(views.standard_view(staged(spark, sf), TENANT, RUN_TS))


def plain(df: DataFrame) -> DataFrame:
    """Floats as doubles and stamps as epoch seconds, which compare exactly across engines."""
    floats = {c: F.col(c).cast("double") for c, t in df.dtypes if t == "float"}
    stamps = {c: F.unix_seconds(c) for c, t in df.dtypes if t == "timestamp"}
    return df.withColumns(floats | stamps)


# The same frames in SQL. Each constant is a list of common table expressions.

READINGS_SQL = f"""
base AS (
  SELECT '9' || lpad(CAST(l_suppkey AS VARCHAR), 8, '0') AS metername,
         'u' || l_partkey AS utildeviceid, 'm' || l_orderkey AS macid,
         l_shipdate + INTERVAL {SHIFT_DAYS} DAY + l_linenumber * INTERVAL 15 MINUTE AS end_ts,
         CASE WHEN l_returnflag = 'N' THEN 60 ELSE 15 END AS minutes,
         CASE WHEN l_linestatus = 'O' THEN 'Z' ELSE '-05:00' END AS raw_zone,
         CASE WHEN l_linestatus = 'O' THEN '+00:00' ELSE '-05:00' END AS zone,
         CASE WHEN l_linestatus = 'O' THEN 0 ELSE 18000 END AS behind,
         l_linenumber, l_orderkey, l_partkey, l_quantity, l_extendedprice, l_discount, l_tax
  FROM lineitem
),
channels AS (
  SELECT *, '101' AS channel, l_quantity AS amount, 'kwh(del)' AS uom FROM base
  UNION ALL SELECT *, '102', l_extendedprice, 'kwh(rec)' FROM base
  UNION ALL SELECT *, '103', l_discount, 'kvarh' FROM base
  UNION ALL SELECT *, '109', l_tax, 'v' FROM base WHERE l_tax > 0
),
readings AS (
  SELECT metername, utildeviceid, macid,
         CAST(minutes AS VARCHAR) AS intervallength,
         strftime(end_ts - minutes * INTERVAL 1 MINUTE, '%Y-%m-%dT%H:%M:%S') || raw_zone AS blockstarttime,
         strftime(end_ts, '%Y-%m-%dT%H:%M:%S') || raw_zone AS blockendtime,
         '1' AS numberintervals,
         strftime(end_ts - minutes * INTERVAL 1 MINUTE, '%Y-%m-%dT%H:%M:%S') || zone AS starttime,
         strftime(end_ts, '%Y-%m-%dT%H:%M:%S') || zone AS endtime,
         zone AS interval_epoch,
         CAST(epoch(end_ts) AS BIGINT) + behind AS unix_endtime,
         strftime(end_ts + (CAST(l_quantity AS INTEGER) % 3) * INTERVAL 1 MINUTE
                  + (l_partkey % 2) * INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%S')
           || CASE WHEN l_partkey % 2 = 0 THEN raw_zone
                   WHEN raw_zone = 'Z' THEN '+01:00' ELSE '-0400' END AS int_gatewaycollectedtime,
         CAST(l_linenumber AS VARCHAR) AS int_blocksequencenumber,
         CAST(l_orderkey % 15 AS VARCHAR) AS int_intervalsequencenumber,
         channel, CAST(amount AS VARCHAR) AS value, uom,
         '{LABEL}' AS part_date
  FROM channels
  WHERE CAST(end_ts - minutes * INTERVAL 1 MINUTE AS DATE) >= DATE '2015-03-01'
)"""

# One reading per business key: instants and numbers are compared, not their text.
CHOSEN_SQL = READINGS_SQL.replace("\nreadings AS (", "\nevery_reading AS (") + """,
readings AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY left(starttime, 10), metername, channel, uom, endtime
      ORDER BY epoch(strptime(left(int_gatewaycollectedtime, 19), '%Y-%m-%dT%H:%M:%S'))
                 - CASE substr(int_gatewaycollectedtime, 20) WHEN 'Z' THEN 0 WHEN '+01:00' THEN 3600
                        WHEN '-0400' THEN -14400 WHEN '-05:00' THEN -18000 END DESC,
               CAST(int_blocksequencenumber AS BIGINT) DESC,
               CAST(int_intervalsequencenumber AS BIGINT) DESC, starttime DESC,
               CAST(value AS DOUBLE) DESC, blockendtime DESC, blockstarttime DESC,
               int_blocksequencenumber DESC, int_gatewaycollectedtime DESC,
               int_intervalsequencenumber DESC, intervallength DESC, macid DESC, utildeviceid DESC) AS rn
    FROM every_reading)
  WHERE rn = 1
)"""

UNITS_SQL = """
unit_map(key, uom_name, template, quality, flag) AS (
  VALUES ('101', 'kwh', 'E-KWH-mtr_ivl_len-TOT', 'TOT', 'Y'),
         ('102', 'kwh', 'E-KWH-mtr_ivl_len-REC', 'REC', 'N'),
         ('103', 'kvarh', 'E-KVARH-mtr_ivl_len', 'VAR', NULL)
),
unit_readings AS (
  SELECT r.*, coalesce(u.uom_name, 'UNK') AS aep_uom,
         coalesce(replace(u.template, 'mtr_ivl_len', r.intervallength), 'UNK') AS name_register,
         coalesce(u.quality, 'UNK') AS aep_sqi, u.flag AS value_mltplr_flg
  FROM readings r LEFT JOIN unit_map u ON r.channel = u.key
)"""

# New York wall-clock bounds as epoch seconds.
VALIDITY_SQL = """
periods(inst, removal, turn_on, turn_off, inst_s, removal_s, on_s, off_s, suffix) AS (
  VALUES ('2010-01-01 00:00:00', '2016-06-30 23:59:59', '2010-01-01', '2016-07-01',
          1262322000, 1467345599, 1262322000, 1467345600, '1'),
         ('2016-07-01 00:00:00', '9999-01-01', '2016-07-01', NULL,
          1467345600, 253370782800, 1467345600, NULL, '2')
),
owners AS (
  SELECT *, CAST(s_suppkey AS VARCHAR) AS key_text,
         CASE WHEN s_nationkey < 10 THEN '07' WHEN s_nationkey < 18 THEN '10' ELSE '04' END AS owner
  FROM supplier
),
validity AS (
  SELECT owner || lpad(key_text, 7, '0') || suffix AS prem_nb,
         CASE WHEN s_acctbal > 0 THEN CAST(s_nationkey + 1 AS VARCHAR) END AS bill_cnst,
         'R' AS acct_clas_cd, 'A' AS acct_type_cd, 'dev' || suffix AS devc_cd,
         CASE WHEN s_nationkey <> 3 THEN 'AMI' END AS pgm_id_nm,
         'D' || key_text AS sd,
         CAST(900000000 + s_suppkey AS VARCHAR) AS mfr_devc_ser_nbr,
         inst AS mtr_inst_ts, removal AS mtr_rmvl_ts, turn_on AS acct_turn_on_dt,
         coalesce(turn_off, CASE WHEN s_acctbal > 5000 THEN '2017-06-30' ELSE '9999-01-01' END)
           AS acct_turn_off_dt,
         'b' || key_text AS bill_acct_nb,
         CASE WHEN s_nationkey <> 5 THEN 'mp' || key_text END AS mtr_pnt_nb,
         'tp' || key_text AS tarf_pnt_nb,
         'City' || s_nationkey AS aep_city, lpad(key_text, 9, '4') AS aep_zip, 'ZZ' AS aep_state,
         CAST(NULL AS VARCHAR) AS cmsg_mtr_mult_nb,
         CAST(inst_s AS BIGINT) AS unix_mtr_inst_ts, CAST(removal_s AS BIGINT) AS unix_mtr_rmvl_ts,
         CAST(on_s AS BIGINT) AS unix_acct_turn_on_dt,
         CAST(coalesce(off_s, CASE WHEN s_acctbal > 5000 THEN 1498795200 ELSE 253370782800 END)
              AS BIGINT) AS unix_acct_turn_off_dt
  FROM owners, periods
  WHERE owner IN ('07', '10')
)"""

STAGE_SQL = """
stage AS (
  SELECT 'oh' AS aep_opco, metername AS serialnumber, utildeviceid, macid, intervallength,
         blockstarttime, blockendtime, numberintervals, starttime, endtime, interval_epoch,
         int_gatewaycollectedtime, int_blocksequencenumber, int_intervalsequencenumber, channel,
         value AS aep_raw_value, value, uom AS aep_raw_uom, upper(aep_uom) AS aep_derived_uom,
         name_register, aep_sqi AS aep_srvc_qlty_idntfr, prem_nb AS aep_premise_nb, bill_cnst,
         acct_clas_cd AS aep_acct_cls_cd, acct_type_cd AS aep_acct_type_cd,
         devc_cd AS aep_devicecode, pgm_id_nm AS aep_meter_program, sd AS aep_srvc_dlvry_id,
         mtr_pnt_nb AS aep_mtr_pnt_nb, tarf_pnt_nb AS aep_tarf_pnt_nb,
         cmsg_mtr_mult_nb AS aep_comp_mtr_mltplr, mtr_rmvl_ts AS aep_mtr_removal_ts,
         mtr_inst_ts AS aep_mtr_install_ts, aep_city, left(aep_zip, 5) AS aep_zip, aep_state,
         'info-insert' AS hdp_update_user, part_date, value_mltplr_flg,
         right(metername, 2) AS aep_meter_bucket, unix_endtime
  FROM unit_readings r
  LEFT JOIN validity v
    ON r.metername = v.mfr_devc_ser_nbr
   AND r.unix_endtime BETWEEN v.unix_mtr_inst_ts AND v.unix_mtr_rmvl_ts
   AND r.unix_endtime BETWEEN v.unix_acct_turn_on_dt AND v.unix_acct_turn_off_dt
)"""

STANDARD_SQL = """
standard AS (
  SELECT serialnumber, 'nonvee-hes' AS source, aep_devicecode, 'N' AS isvirtual_meter,
         interval_epoch AS timezoneoffset, aep_premise_nb,
         aep_premise_nb || '-' || aep_tarf_pnt_nb || '-' || aep_mtr_pnt_nb AS aep_service_point,
         aep_srvc_dlvry_id, name_register, 'N' AS isvirtual_register, aep_derived_uom, aep_raw_uom,
         aep_srvc_qlty_idntfr, channel AS aep_channel_id,
         CAST(intervallength AS INTEGER) * 60 AS aep_sec_per_intrvl,
         CAST(NULL AS VARCHAR) AS aep_meter_alias, aep_meter_program, 'interval' AS aep_usage_type,
         'US/Eastern' AS aep_timezone_cd, endtime AS endtimeperiod, starttime AS starttimeperiod,
         CASE WHEN value_mltplr_flg = 'Y' THEN CAST(value AS DOUBLE) * CAST(bill_cnst AS DOUBLE)
              ELSE CAST(value AS DOUBLE) END AS value,
         aep_raw_value, bill_cnst AS scalarfloat, aep_acct_cls_cd, aep_acct_type_cd,
         aep_mtr_pnt_nb, aep_tarf_pnt_nb, CAST(aep_comp_mtr_mltplr AS DOUBLE) AS aep_comp_mtr_mltplr,
         CAST(unix_endtime AS VARCHAR) AS aep_endtime_utc, aep_mtr_removal_ts, aep_mtr_install_ts,
         aep_city, aep_zip, aep_state,
         CAST(1768478400 AS BIGINT) AS hdp_insert_dttm, CAST(1768478400 AS BIGINT) AS hdp_update_dttm,
         hdp_update_user, left(aep_premise_nb, 2) AS authority, left(starttime, 10) AS aep_usage_dt,
         'new' AS data_type, aep_opco, aep_meter_bucket
  FROM stage
)"""

OUTPUT_SQL = """
output AS (
  SELECT * REPLACE (
           CAST(aep_sec_per_intrvl AS DOUBLE) AS aep_sec_per_intrvl,
           CAST(CAST(value AS FLOAT) AS DOUBLE) AS value,
           CAST(CAST(aep_raw_value AS FLOAT) AS DOUBLE) AS aep_raw_value,
           CAST(CAST(scalarfloat AS FLOAT) AS DOUBLE) AS scalarfloat),
         CAST(NULL AS VARCHAR) AS toutier, CAST(NULL AS VARCHAR) AS toutiername,
         CAST(NULL AS VARCHAR) AS aep_billable_ind, CAST(NULL AS VARCHAR) AS aep_data_quality_cd,
         CAST(NULL AS VARCHAR) AS aep_data_validation
  FROM standard
)"""

TO_UNITS = f"WITH {READINGS_SQL}, {UNITS_SQL}"
TO_STAGE = f"{TO_UNITS}, {VALIDITY_SQL}, {STAGE_SQL}"
TO_STANDARD = f"{TO_STAGE}, {STANDARD_SQL}"
TO_OUTPUT = f"{TO_STANDARD}, {OUTPUT_SQL}"
TO_DEDUPED = TO_OUTPUT.replace(READINGS_SQL, CHOSEN_SQL)


# --- A consume-like table from events ---------------------------------------


def consume(spark: SparkSession, sf: str) -> DataFrame:
    """Every event as a reading row; tenant, units and user stamp depend on the event type."""
    ts, kind = F.col("ts"), F.col("event_type")
    serial = F.concat(F.lit("7"), F.lpad(F.col("user_id").cast("string"), 8, "0"))
    return table(spark, sf, "events").select(
        F.col("event_id"),
        serial.alias("serialnumber"),
        F.when(kind == "signup", "ap").otherwise("oh").alias("aep_opco"),
        ts.cast("date").alias("aep_usage_dt"),
        kind.alias("aep_channel_id"),
        F.when(kind.isin("click", "view"), "KWH")
        .when(kind == "purchase", "KVARH")
        .otherwise(config.UNKNOWN)
        .alias("aep_derived_uom"),
        F.concat(F.lit("raw-"), kind).alias("aep_raw_uom"),
        F.substring(serial, -2, 2).alias("aep_meter_bucket"),
        F.substring(times.iso_wall(ts), 1, 19).alias("endtimeperiod"),
        F.col("value"),
        F.when(F.col("value") > 50, F.concat(F.lit("p"), serial)).alias("aep_premise_nb"),
        F.when(kind == "purchase", config.UPDATE_USER)
        .otherwise(config.INSERT_USER)
        .alias("hdp_update_user"),
        ts.alias("hdp_insert_dttm"),
        F.timestamp_add("DAY", F.lit(1), ts).alias("hdp_update_dttm"),
        F.concat(F.date_format(ts.cast("date"), "yyyyMMdd"), F.lit("_000000")).alias("run_date"),
    )


CONSUME_SQL = """
consume AS (
  SELECT event_id, '7' || lpad(CAST(user_id AS VARCHAR), 8, '0') AS serialnumber,
         CASE WHEN event_type = 'signup' THEN 'ap' ELSE 'oh' END AS aep_opco,
         CAST(ts AS DATE) AS aep_usage_dt, event_type AS aep_channel_id,
         CASE WHEN event_type IN ('click', 'view') THEN 'KWH'
              WHEN event_type = 'purchase' THEN 'KVARH' ELSE 'UNK' END AS aep_derived_uom,
         'raw-' || event_type AS aep_raw_uom,
         right(lpad(CAST(user_id AS VARCHAR), 8, '0'), 2) AS aep_meter_bucket,
         strftime(ts, '%Y-%m-%dT%H:%M:%S') AS endtimeperiod, value,
         CASE WHEN value > 50 THEN 'p7' || lpad(CAST(user_id AS VARCHAR), 8, '0') END AS aep_premise_nb,
         CASE WHEN event_type = 'purchase' THEN 'info-update' ELSE 'info-insert' END AS hdp_update_user,
         ts AS hdp_insert_dttm, ts + INTERVAL 1 DAY AS hdp_update_dttm,
         strftime(ts, '%Y%m%d') || '_000000' AS run_date
  FROM events
)"""
FROM_CONSUME = f"WITH {CONSUME_SQL}"

# Columns that compare across engines without time zone questions.
CONSUME_SHOWN = (
    "event_id serialnumber aep_opco aep_channel_id aep_derived_uom aep_raw_uom "
    "aep_meter_bucket endtimeperiod value aep_premise_nb hdp_update_user run_date"
).split()
SHOWN_SQL = ", ".join(CONSUME_SHOWN)
