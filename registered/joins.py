"""Lookup, validity, merge and reconciliation joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally import config
from gridtally.operators.dedup import dedup_latest
from gridtally.operators.joins import validity_check, validity_diagnose
from gridtally.operators.merge import ACTION, merge_preview, merge_upsert
from gridtally.operators.reconcile import reconcile, reconcile_against, reconcile_changed, reconcile_key
from gridtally.plans import views
from gridtally.sources.tables import unit_map
from registered import frames

READING_COLUMNS = (
    "metername intervallength starttime endtime unix_endtime channel value uom macid "
    "aep_uom name_register aep_sqi value_mltplr_flg"
).split()
PREMISE_COLUMNS = "prem_nb bill_cnst devc_cd pgm_id_nm sd mtr_pnt_nb mtr_inst_ts aep_zip".split()


def lookup_units(spark: SparkSession, sf: str) -> DataFrame:
    return frames.unit_readings(spark, sf).select(*READING_COLUMNS)


def lookup_units_shuffled(spark: SparkSession, sf: str) -> DataFrame:
    """The same lookup without a broadcast."""
    units = unit_map(frames.units(spark), frames.TENANT.code)
    joined = views.enrich_units(frames.readings(spark, sf), units, strategy="merge")
    return joined.select(*READING_COLUMNS)


def validity_join(spark: SparkSession, sf: str) -> DataFrame:
    joined = views.enrich_premise(frames.unit_readings(spark, sf), frames.validity_dim(spark, sf))
    return joined.select("metername", "endtime", "channel", "value", "macid", *PREMISE_COLUMNS)


def validity_join_slotted(spark: SparkSession, sf: str) -> DataFrame:
    """The same join by shuffle, as used for a large dimension."""
    joined = views.enrich_premise(
        frames.unit_readings(spark, sf), frames.validity_dim(spark, sf), strategy="merge"
    )
    return joined.select("metername", "endtime", "channel", "value", "macid", *PREMISE_COLUMNS)


VALIDITY_SQL = f"""{frames.TO_STAGE}
SELECT serialnumber AS metername, endtime, channel, value, macid, v.prem_nb, v.bill_cnst, v.devc_cd,
       v.pgm_id_nm, v.sd, v.mtr_pnt_nb, v.mtr_inst_ts, v.aep_zip
FROM stage LEFT JOIN validity v ON v.prem_nb = aep_premise_nb
"""


def prepared_validity(spark: SparkSession, sf: str) -> DataFrame:
    return frames.validity_dim(spark, sf)


WINDOWS = {"in_mtr_window": config.VALIDITY_INTERVALS[0], "in_acct_window": config.VALIDITY_INTERVALS[1]}
CHOSEN_DEVICES = ["900000001", "900000004", "900000007"]
CHECKS = {
    "meter_window_check": config.VALIDITY_INTERVALS[0],
    "account_window_check": config.VALIDITY_INTERVALS[1],
}


def diagnosed(spark: SparkSession, sf: str) -> DataFrame:
    """Readings of three devices against both validity rows of their device."""
    rows = validity_diagnose(
        frames.unit_readings(spark, sf),
        frames.validity_dim(spark, sf),
        on=("metername", "mfr_devc_ser_nbr"),
        at="unix_endtime",
        intervals=WINDOWS,
        chosen=CHOSEN_DEVICES,
    )
    shown = ["metername", "endtime", "channel", "value", "macid", "prem_nb"]
    return rows.select(*shown, *WINDOWS, *(c for c in rows.columns if c.endswith("_text")))


def checked(spark: SparkSession, sf: str) -> DataFrame:
    rows = validity_check(frames.validity_dim(spark, sf), F.lit(1483246800), CHECKS)
    return rows.select("mfr_devc_ser_nbr", "prem_nb", "mtr_rmvl_ts", *CHECKS)


# First delivery: events before 2024-01-20 or without a date. Second: events from 2024-01-10 on, values doubled.
MERGE_KEYS = config.BUSINESS_KEY
MERGE_UPDATES = ["value", "run_date", "hdp_update_user"]
MERGE_COLUMNS = [*MERGE_KEYS, "aep_opco", "value", "run_date", "hdp_update_user", "aep_premise_nb"]


def deliveries(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    consume = frames.consume(spark, sf)
    latest = dedup_latest(consume, MERGE_KEYS, [F.desc("event_id")])
    rows = latest.withColumn(
        "endtimeperiod", F.when(F.col("value") > 1, F.col("endtimeperiod"))
    ).withColumn("aep_usage_dt", F.col("aep_usage_dt").cast("string"))
    first = rows.filter((F.col("aep_usage_dt") < "2024-01-20") | F.col("aep_usage_dt").isNull())
    second = rows.filter(F.col("aep_usage_dt") >= "2024-01-10").withColumns(
        {
            "value": F.col("value") * 2,
            "aep_opco": F.lit("new"),
            "run_date": F.lit("20240201_000000"),
            "hdp_update_user": F.lit(config.INSERT_USER),
        }
    )
    return first.select(*MERGE_COLUMNS), second.select(*MERGE_COLUMNS)


def merged(spark: SparkSession, sf: str) -> DataFrame:
    target, source = deliveries(spark, sf)
    return merge_upsert(
        target,
        source,
        MERGE_KEYS,
        MERGE_UPDATES,
        on_update={"hdp_update_user": F.lit(config.UPDATE_USER)},
        on_insert={"hdp_update_user": F.lit(config.INSERT_USER)},
        action=True,
    )


DELIVERIES_SQL = f"""{frames.FROM_CONSUME},
latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
      PARTITION BY aep_usage_dt, aep_meter_bucket, serialnumber, aep_channel_id, aep_raw_uom, endtimeperiod
      ORDER BY event_id DESC) AS rn FROM consume)
  WHERE rn = 1
),
rows_ AS (
  SELECT CAST(aep_usage_dt AS VARCHAR) AS aep_usage_dt, aep_meter_bucket, serialnumber,
         aep_channel_id, aep_raw_uom, CASE WHEN value > 1 THEN endtimeperiod END AS endtimeperiod,
         aep_opco, value, run_date, hdp_update_user, aep_premise_nb
  FROM latest
),
target AS (SELECT * FROM rows_ WHERE aep_usage_dt < '2024-01-20' OR aep_usage_dt IS NULL),
source AS (
  SELECT * REPLACE ('new' AS aep_opco, value * 2 AS value, '20240201_000000' AS run_date,
                    'info-insert' AS hdp_update_user)
  FROM rows_ WHERE aep_usage_dt >= '2024-01-10'
)"""

MERGE_SQL = f"""{DELIVERIES_SQL}
SELECT coalesce(t.aep_usage_dt, s.aep_usage_dt) AS aep_usage_dt,
       coalesce(t.aep_meter_bucket, s.aep_meter_bucket) AS aep_meter_bucket,
       coalesce(t.serialnumber, s.serialnumber) AS serialnumber,
       coalesce(t.aep_channel_id, s.aep_channel_id) AS aep_channel_id,
       coalesce(t.aep_raw_uom, s.aep_raw_uom) AS aep_raw_uom,
       coalesce(t.endtimeperiod, s.endtimeperiod) AS endtimeperiod,
       coalesce(t.aep_opco, s.aep_opco) AS aep_opco,
       coalesce(s.value, t.value) AS value,
       coalesce(s.run_date, t.run_date) AS run_date,
       CASE WHEN s.value IS NOT NULL AND t.value IS NOT NULL THEN 'info-update'
            WHEN s.value IS NOT NULL THEN 'info-insert' ELSE t.hdp_update_user END AS hdp_update_user,
       CASE WHEN t.value IS NOT NULL THEN t.aep_premise_nb ELSE s.aep_premise_nb END AS aep_premise_nb,
       CASE WHEN s.value IS NOT NULL AND t.value IS NOT NULL THEN 'updated'
            WHEN s.value IS NOT NULL THEN 'inserted' ELSE 'kept' END AS {ACTION}
FROM target t FULL JOIN source s
  ON t.aep_usage_dt = s.aep_usage_dt AND t.aep_meter_bucket = s.aep_meter_bucket
 AND t.serialnumber = s.serialnumber AND t.aep_channel_id = s.aep_channel_id
 AND t.aep_raw_uom = s.aep_raw_uom AND t.endtimeperiod = s.endtimeperiod
"""


def previewed(spark: SparkSession, sf: str) -> DataFrame:
    """What the second delivery would change, by usage date."""
    target, source = deliveries(spark, sf)
    return merge_preview(target, source, MERGE_KEYS, ["aep_usage_dt"])


def order_copies(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Orders, a changed copy without the finished orders, and one without the low priority."""
    orders = frames.table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"
    )
    urgent = F.col("o_orderpriority") == "1-URGENT"
    changed = orders.filter(F.col("o_orderstatus") != "F").withColumn(
        "o_orderpriority", F.when(~urgent, F.col("o_orderpriority"))
    )
    other = orders.filter(F.col("o_orderpriority") != "5-LOW").withColumn(
        "o_custkey", F.col("o_custkey") + F.when(urgent, 1).otherwise(0)
    )
    return orders, changed, other


def reconciled(spark: SparkSession, sf: str) -> DataFrame:
    orders, changed, _ = order_copies(spark, sf)
    open_orders = orders.filter(F.col("o_orderstatus") != "P")
    return reconcile(open_orders, changed, ["o_orderkey"], names=("dev", "prod"))


def reconciled_changes(spark: SparkSession, sf: str) -> DataFrame:
    """The differences of the same tables, found by digests of buckets first."""
    orders, changed, _ = order_copies(spark, sf)
    open_orders = orders.filter(F.col("o_orderstatus") != "P")
    return reconcile_changed(open_orders, changed, ["o_orderkey"], names=("dev", "prod"))


RECONCILE_SQL = """
WITH l AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS c1, o_orderstatus AS c2,
                  o_orderpriority AS c3 FROM orders WHERE o_orderstatus <> 'P'),
r AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS c1, o_orderstatus AS c2,
             CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderpriority END AS c3
      FROM orders WHERE o_orderstatus <> 'F'),
j AS (SELECT coalesce(l.o_orderkey, r.o_orderkey) AS o_orderkey, l.o_orderkey AS lk, r.o_orderkey AS rk,
             l.c1 AS l1, l.c2 AS l2, l.c3 AS l3, r.c1 AS r1, r.c2 AS r2, r.c3 AS r3
      FROM l FULL JOIN r ON l.o_orderkey = r.o_orderkey),
u AS (SELECT o_orderkey, lk, rk, 'o_custkey' AS "column", l1 AS dev, r1 AS prod FROM j
      UNION ALL SELECT o_orderkey, lk, rk, 'o_orderstatus', l2, r2 FROM j
      UNION ALL SELECT o_orderkey, lk, rk, 'o_orderpriority', l3, r3 FROM j)
SELECT o_orderkey, "column", dev, prod,
       CASE WHEN rk IS NULL THEN 'NO prod' WHEN lk IS NULL THEN 'NO dev'
            WHEN dev IS NOT DISTINCT FROM prod THEN 'OK' ELSE 'DIFF' END AS status
FROM u
"""


def reconciled_three(spark: SparkSession, sf: str) -> DataFrame:
    dev, staged, consumed = order_copies(spark, sf)
    others = {"staged": staged, "consumed": consumed}
    return reconcile_against(dev, others, ["o_orderkey"], ignore=["o_orderstatus"])


def reconciled_key(spark: SparkSession, sf: str) -> DataFrame:
    """One order in three tables."""
    dev, staged, consumed = order_copies(spark, sf)
    others = {"staged": staged, "consumed": consumed}
    return reconcile_key(dev, others, {"o_orderkey": 7}, ignore=["o_orderstatus"])


THREE_SQL = """
WITH s AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS c1,
                  CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderpriority END AS c2
           FROM orders WHERE o_orderstatus <> 'F'),
c AS (SELECT o_orderkey, CAST(o_custkey + CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END
                              AS VARCHAR) AS c1, o_orderpriority AS c2
      FROM orders WHERE o_orderpriority <> '5-LOW'),
u AS (
  SELECT o.o_orderkey, 'o_custkey' AS "column", CAST(o.o_custkey AS VARCHAR) AS dev,
         s.c1 AS staged, c.c1 AS consumed, s.o_orderkey AS sk, c.o_orderkey AS ck
  FROM orders o LEFT JOIN s ON s.o_orderkey = o.o_orderkey LEFT JOIN c ON c.o_orderkey = o.o_orderkey
  UNION ALL
  SELECT o.o_orderkey, 'o_orderpriority', o.o_orderpriority, s.c2, c.c2, s.o_orderkey, c.o_orderkey
  FROM orders o LEFT JOIN s ON s.o_orderkey = o.o_orderkey LEFT JOIN c ON c.o_orderkey = o.o_orderkey
)
SELECT o_orderkey, "column", dev, staged, consumed,
       CASE WHEN sk IS NULL AND ck IS NULL THEN 'NO DATA'
            WHEN (sk IS NULL OR dev IS NOT DISTINCT FROM staged)
             AND (ck IS NULL OR dev IS NOT DISTINCT FROM consumed) THEN 'OK' ELSE 'DIFF' END AS status
FROM u
"""

EPOCHS = ["unix_endtime", *(c for pair in config.VALIDITY_INTERVALS for c in pair)]
TEXTS = ", ".join(
    f"strftime(make_timestamp({c} * 1000000), '%Y-%m-%d %H:%M:%S') AS {c}_text" for c in EPOCHS
)
UNITS_SQL = f"{frames.TO_UNITS} SELECT {', '.join(READING_COLUMNS)} FROM unit_readings"

QUERIES = {
    "lookup_units": (lookup_units, UNITS_SQL),
    "lookup_units_shuffled": (lookup_units_shuffled, UNITS_SQL),
    "validity_join": (validity_join, VALIDITY_SQL),
    "validity_join_slotted": (validity_join_slotted, VALIDITY_SQL),
    "prepare_validity": (
        prepared_validity, f"WITH {frames.VALIDITY_SQL} SELECT * FROM validity"
    ),
    "validity_diagnose": (
        diagnosed,
        f"""{frames.TO_UNITS}, {frames.VALIDITY_SQL}
            SELECT metername, endtime, channel, value, macid, prem_nb,
                   CASE WHEN unix_endtime BETWEEN unix_mtr_inst_ts AND unix_mtr_rmvl_ts
                        THEN 'YES' ELSE 'NO' END AS in_mtr_window,
                   CASE WHEN unix_endtime BETWEEN unix_acct_turn_on_dt AND unix_acct_turn_off_dt
                        THEN 'YES' ELSE 'NO' END AS in_acct_window, {TEXTS}
            FROM unit_readings JOIN validity ON metername = mfr_devc_ser_nbr
            WHERE metername IN ('900000001', '900000004', '900000007')""",
    ),
    "validity_check": (
        checked,
        f"""WITH {frames.VALIDITY_SQL}
            SELECT mfr_devc_ser_nbr, prem_nb, mtr_rmvl_ts,
                   CASE WHEN 1483246800 BETWEEN unix_mtr_inst_ts AND unix_mtr_rmvl_ts
                        THEN 'PASS' ELSE 'FAIL' END AS meter_window_check,
                   CASE WHEN 1483246800 BETWEEN unix_acct_turn_on_dt AND unix_acct_turn_off_dt
                        THEN 'PASS' ELSE 'FAIL' END AS account_window_check
            FROM validity""",
    ),
    "merge_upsert": (merged, MERGE_SQL),
    "merge_preview": (
        previewed,
        f"""SELECT aep_usage_dt, count(*) FILTER ({ACTION} = 'updated') AS updated,
                   count(*) FILTER ({ACTION} = 'inserted') AS inserted,
                   count(*) FILTER ({ACTION} = 'kept') AS kept
            FROM ({MERGE_SQL}) GROUP BY 1""",
    ),
    "reconcile_key": (reconciled_key, THREE_SQL + " WHERE o_orderkey = 7"),
    "reconcile": (reconciled, RECONCILE_SQL),
    "reconcile_changed": (reconciled_changes, f"SELECT * FROM ({RECONCILE_SQL}) WHERE status <> 'OK'"),
    "reconcile_three_way": (reconciled_three, THREE_SQL),
}
