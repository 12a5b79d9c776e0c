"""The reading views: enrichment, standardisation and the stored row layouts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally import config
from gridtally.config import Tenant
from gridtally.functions import times, values
from gridtally.operators.dedup import dedup_side_by_side, newest_first
from gridtally.operators.joins import lookup_left, validity_join


def enrich_units(
    readings: DataFrame,
    units: DataFrame,
    unique: bool = True,
    strategy: str | None = None,
) -> DataFrame:
    """Adds derived unit, register name, quality code and multiplier flag by channel."""
    joined = lookup_left(
        readings, units, {"channel": "aep_channel_id"}, unique=unique, strategy=strategy
    )
    return joined.withColumns(
        {
            "metername": F.trim("metername"),
            "uom": values.clean_unit(F.col("uom")),
            "aep_uom": values.or_unknown(F.col("aep_derived_uom")),
            "name_register": F.when(
                F.col("name_register").isNotNull(),
                values.register_name(F.col("name_register"), F.col("intervallength")),
            ).otherwise(config.UNKNOWN),
            "aep_sqi": values.or_unknown(F.col("aep_srvc_qlty_idntfr")),
        }
    ).drop("aep_derived_uom", "aep_srvc_qlty_idntfr")


def prepare_validity_dim(
    dim: DataFrame, company_codes: tuple[str, ...], zone: str = config.DIMENSION_ZONE
) -> DataFrame:
    """Validity rows of the given companies with their bounds as epoch seconds.

    Bounds are wall-clock text in ``zone``; ``9999-01-01`` marks an open end.
    """

    def day(name: str) -> Column:
        return times.zone_epoch(times.wall_date(F.col(name)).cast("timestamp_ntz"), zone)

    def second(name: str) -> Column:
        return times.zone_epoch(times.wall_time(F.col(name)), zone)

    removal = F.when(F.col("mtr_rmvl_ts") == config.OPEN_END, day("mtr_rmvl_ts")).otherwise(
        second("mtr_rmvl_ts")
    )
    replaced = ("tx_mand_data", "doe_nb", "serv_deliv_id", "co_cd_ownr")
    kept = [c for c in config.VALIDITY_COLUMNS if c not in replaced]
    return (
        dim.filter(F.col("co_cd_ownr").isin(list(company_codes)))
        .select(
            *kept,
            values.joined_text(
                [F.col("tx_mand_data"), F.col("doe_nb"), F.col("serv_deliv_id")]
            ).alias("sd"),
            values.null_text().alias("cmsg_mtr_mult_nb"),
            second("mtr_inst_ts").alias("unix_mtr_inst_ts"),
            removal.alias("unix_mtr_rmvl_ts"),
            day("acct_turn_on_dt").alias("unix_acct_turn_on_dt"),
            day("acct_turn_off_dt").alias("unix_acct_turn_off_dt"),
        )
        .withColumnsRenamed(
            {"serv_city_ad": "aep_city", "serv_zip_ad": "aep_zip", "state_cd": "aep_state"}
        )
    )


def enrich_premise(
    readings: DataFrame, validity_dim: DataFrame, strategy: str | None = None
) -> DataFrame:
    """Adds the meter and premise attributes valid at the reading's end.

    Of overlapping validity rows the one installed last is valid, then the one whose
    account began last.
    """
    return validity_join(
        readings,
        validity_dim,
        on=("metername", "mfr_devc_ser_nbr"),
        at="unix_endtime",
        intervals=config.VALIDITY_INTERVALS,
        order=newest_first(
            ["unix_mtr_inst_ts", "unix_acct_turn_on_dt", "prem_nb", "bill_acct_nb"]
        ),
        strategy=strategy,
    )


# Stage view columns that are another column under a new name.
STAGE_RENAMES = {
    "serialnumber": "metername",
    "aep_raw_value": "value",
    "aep_raw_uom": "uom",
    "aep_srvc_qlty_idntfr": "aep_sqi",
    "aep_premise_nb": "prem_nb",
    "aep_acct_cls_cd": "acct_clas_cd",
    "aep_acct_type_cd": "acct_type_cd",
    "aep_devicecode": "devc_cd",
    "aep_meter_program": "pgm_id_nm",
    "aep_srvc_dlvry_id": "sd",
    "aep_mtr_pnt_nb": "mtr_pnt_nb",
    "aep_tarf_pnt_nb": "tarf_pnt_nb",
    "aep_comp_mtr_mltplr": "cmsg_mtr_mult_nb",
    "aep_mtr_removal_ts": "mtr_rmvl_ts",
    "aep_mtr_install_ts": "mtr_inst_ts",
}


def stage_view(enriched: DataFrame, tenant: Tenant) -> DataFrame:
    """The 40 staged columns; also keeps the end epoch."""
    derived = {
        "aep_opco": F.lit(tenant.code),
        "aep_derived_uom": F.upper("aep_uom"),
        "aep_zip": F.substring("aep_zip", 1, 5),
        "hdp_update_user": F.lit(config.INSERT_USER),
        "aep_meter_bucket": values.meter_bucket(F.col("metername")),
    }
    derived |= {new: F.col(old) for new, old in STAGE_RENAMES.items()}
    return enriched.select(
        *[derived.get(c, F.col(c)).alias(c) for c in config.STAGE_COLUMNS], "unix_endtime"
    )


# Standard view columns that are a stage column under a new name.
STANDARD_RENAMES = {
    "timezoneoffset": "interval_epoch",
    "aep_channel_id": "channel",
    "endtimeperiod": "endtime",
    "starttimeperiod": "starttime",
    "scalarfloat": "bill_cnst",
}


def standard_view(
    staged: DataFrame, tenant: Tenant, run_ts: datetime, carry: list[str] | None = None
) -> DataFrame:
    """The 43 standard columns, plus the staged columns named by ``carry``."""
    stamp = F.lit(run_ts).cast("timestamp")
    derived = {
        "source": F.lit(config.SOURCE_LABEL),
        "isvirtual_meter": F.lit("N"),
        "isvirtual_register": F.lit("N"),
        "aep_meter_alias": values.null_text(),
        "aep_usage_type": F.lit(config.USAGE_TYPE),
        "aep_timezone_cd": F.lit(tenant.zone_label),
        "data_type": F.lit(config.DATA_TYPE_NEW),
        "hdp_insert_dttm": stamp,
        "hdp_update_dttm": stamp,
        "aep_service_point": values.compose_key(
            [F.col("aep_premise_nb"), F.col("aep_tarf_pnt_nb"), F.col("aep_mtr_pnt_nb")]
        ),
        "aep_sec_per_intrvl": values.as_int(F.col("intervallength")) * 60,
        "value": values.scale_value(F.col("value"), F.col("value_mltplr_flg"), F.col("bill_cnst")),
        "aep_comp_mtr_mltplr": values.as_double(F.col("aep_comp_mtr_mltplr")),
        "aep_endtime_utc": F.col("unix_endtime").cast("string"),
        "authority": values.authority(F.col("aep_premise_nb")),
        "aep_usage_dt": values.usage_date(F.col("starttime")),
    }
    derived |= {new: F.col(old) for new, old in STANDARD_RENAMES.items()}
    return staged.select(
        *[derived.get(c, F.col(c)).alias(c) for c in config.STANDARD_COLUMNS], *(carry or [])
    )


def output_view(standard: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """The 48 typed output columns; columns the standard view lacks are NULL."""
    known = set(standard.columns)

    def typed(name: str) -> Column:
        kind = config.OUTPUT_TYPES.get(name, "string")
        value = F.col(name) if name in known else F.lit(None)
        return (value.cast(kind) if kind != "float" else value.try_cast(kind)).alias(name)

    return standard.select(*[typed(c) for c in config.OUTPUT_COLUMNS], *(carry or []))


def dedup_readings(readings: DataFrame) -> DataFrame:
    """Flat readings, one per business key: the one collected last.

    All columns of the business key come from the reading, so the choice is made
    on the narrow rows, before anything is joined. Collection times compare as
    instants and sequence numbers as numbers; all other columns settle ties.
    """
    meter, end = F.trim("metername"), F.col("endtime")
    key = [F.col("channel"), values.clean_unit(F.col("uom")), meter, end, values.usage_date(F.col("starttime"))]
    newest = [
        times.epoch_of(F.col("int_gatewaycollectedtime")),
        F.col("int_blocksequencenumber").try_cast("bigint"),
        F.col("int_intervalsequencenumber").try_cast("bigint"),
        F.col("starttime"),
        F.col("value").try_cast("double"),
        F.col("rawvalue").try_cast("double"),
    ]
    order = [c.desc_nulls_last() for c in newest] + newest_first(sorted(readings.columns))
    return dedup_side_by_side(readings, [meter, end], key, order)


def readings_view(
    readings: DataFrame,
    units: DataFrame,
    validity_dim: DataFrame,
    tenant: Tenant,
    run_ts: datetime,
    strategy: str | None = None,
) -> DataFrame:
    """Flat readings to output rows, one for one."""
    enriched = enrich_premise(enrich_units(readings, units, strategy=strategy), validity_dim, strategy)
    return output_view(standard_view(stage_view(enriched, tenant), tenant, run_ts))


def consume_rows(output: DataFrame) -> DataFrame:
    """The 47 columns of the consume table, with the usage date as a date."""
    typed = output.withColumn("aep_usage_dt", F.col("aep_usage_dt").try_cast("date"))
    return typed.select(*config.CONSUME_COLUMNS)


def incremental_rows(output: DataFrame, tenant: Tenant, run_ts: datetime) -> DataFrame:
    """The 47 columns of the incremental table for this tenant's new rows."""
    new = output.filter(
        (F.col("data_type") == config.DATA_TYPE_NEW) & (F.col("aep_opco") == tenant.code)
    )
    return new.withColumns(
        {
            "aep_usage_dt": F.col("aep_usage_dt").try_cast("date"),
            "run_date": F.lit(times.run_date(run_ts)),
        }
    ).select(*config.INCREMENTAL_COLUMNS)
