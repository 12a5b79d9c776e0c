"""Fixed values, schemas and tenant configuration.

Everything in this module is data: column names, layouts, lookup tables and
literals that downstream tables and queries already depend on.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values: delivered files -----------------------------------------

MARKER_FILE = "index.txt"
MARKER_MAX_DEPTH = 2
DATA_FILE_EXT = ".xml"
DATA_FILE_MIN_SIZE = 0

# --- Fixed values: nested document layout ----------------------------------

ROW_TAG = "MeterData"
XML_OPTIONS = {
    "mode": "FAILFAST",
    "inferSchema": "false",
    "ignoreNamespace": "true",
    "valueTag": "tag_value",
    "timezone": "America/New_York",
}

RAW_SCHEMA = """
_MeterName STRING, _UtilDeviceID STRING, _MacID STRING,
IntervalReadData ARRAY<STRUCT<
  _NumberIntervals: STRING, _EndTime: STRING, _StartTime: STRING, _IntervalLength: STRING,
  Interval: ARRAY<STRUCT<
    _EndTime: STRING, _BlockSequenceNumber: STRING,
    _GatewayCollectedTime: STRING, _IntervalSequenceNumber: STRING,
    Reading: ARRAY<STRUCT<
      _Channel: STRING, _RawValue: STRING, _Value: STRING, _UOM: STRING, _BlockEndValue: STRING>>>>>>
"""

# Column of the flat readings for each field, by level of the document.
DOCUMENT_FIELDS = {
    "_MeterName": "metername",
    "_UtilDeviceID": "utildeviceid",
    "_MacID": "macid",
    "IntervalReadData": "interval_reading",
}
BLOCK_FIELDS = {
    "_IntervalLength": "intervallength",
    "_StartTime": "blockstarttime",
    "_EndTime": "blockendtime",
    "_NumberIntervals": "numberintervals",
}
INTERVAL_FIELDS = {
    "_EndTime": "int_endtime",
    "_GatewayCollectedTime": "int_gatewaycollectedtime",
    "_BlockSequenceNumber": "int_blocksequencenumber",
    "_IntervalSequenceNumber": "int_intervalsequencenumber",
    "Reading": "int_reading",
}
READING_FIELDS = {
    "_Channel": "channel",
    "_RawValue": "rawvalue",
    "_Value": "value",
    "_UOM": "uom",
}

# --- Fixed values: literals written to the tables ---------------------------

EARLIEST_BLOCK_DATE = "2015-03-01"
OPEN_END = "9999-01-01"
UNKNOWN = "UNK"
LENGTH_PLACEHOLDER = "mtr_ivl_len"
SOURCE_LABEL = "nonvee-hes"
USAGE_TYPE = "interval"
DATA_TYPE_NEW = "new"
INSERT_USER = "info-insert"
UPDATE_USER = "info-update"
RETENTION_DAYS = 8
RUN_DATE_FORMAT = "%Y%m%d_%H%M%S"
BATCH_LABEL_FORMAT = "%Y%m%d_%H%M"

# Wall-clock bounds in the validity dimension are given in this zone.
DIMENSION_ZONE = "America/New_York"

# --- Fixed values: column layouts -------------------------------------------


UNIT_MAP_COLUMNS = [
    "aep_channel_id", "aep_derived_uom", "name_register", "aep_srvc_qlty_idntfr", "value_mltplr_flg",
]

VALIDITY_COLUMNS = [
    "co_cd_ownr", "prem_nb", "bill_cnst", "acct_clas_cd", "acct_type_cd", "devc_cd", "pgm_id_nm",
    "tx_mand_data", "doe_nb", "serv_deliv_id", "mfr_devc_ser_nbr", "mtr_inst_ts", "mtr_rmvl_ts",
    "acct_turn_on_dt", "acct_turn_off_dt", "bill_acct_nb", "mtr_pnt_nb", "tarf_pnt_nb", "serv_city_ad",
    "serv_zip_ad", "state_cd",
]

VALIDITY_INTERVALS = [
    ("unix_mtr_inst_ts", "unix_mtr_rmvl_ts"),
    ("unix_acct_turn_on_dt", "unix_acct_turn_off_dt"),
]

STAGE_COLUMNS = [
    "aep_opco", "serialnumber", "utildeviceid", "macid", "intervallength", "blockstarttime", "blockendtime",
    "numberintervals", "starttime", "endtime", "interval_epoch", "int_gatewaycollectedtime",
    "int_blocksequencenumber", "int_intervalsequencenumber", "channel", "aep_raw_value", "value",
    "aep_raw_uom", "aep_derived_uom", "name_register", "aep_srvc_qlty_idntfr", "aep_premise_nb", "bill_cnst",
    "aep_acct_cls_cd", "aep_acct_type_cd", "aep_devicecode", "aep_meter_program", "aep_srvc_dlvry_id",
    "aep_mtr_pnt_nb", "aep_tarf_pnt_nb", "aep_comp_mtr_mltplr", "aep_mtr_removal_ts", "aep_mtr_install_ts",
    "aep_city", "aep_zip", "aep_state", "hdp_update_user", "part_date", "value_mltplr_flg",
    "aep_meter_bucket",
]

STANDARD_COLUMNS = [
    "serialnumber", "source", "aep_devicecode", "isvirtual_meter", "timezoneoffset", "aep_premise_nb",
    "aep_service_point", "aep_srvc_dlvry_id", "name_register", "isvirtual_register", "aep_derived_uom",
    "aep_raw_uom", "aep_srvc_qlty_idntfr", "aep_channel_id", "aep_sec_per_intrvl", "aep_meter_alias",
    "aep_meter_program", "aep_usage_type", "aep_timezone_cd", "endtimeperiod", "starttimeperiod", "value",
    "aep_raw_value", "scalarfloat", "aep_acct_cls_cd", "aep_acct_type_cd", "aep_mtr_pnt_nb",
    "aep_tarf_pnt_nb", "aep_comp_mtr_mltplr", "aep_endtime_utc", "aep_mtr_removal_ts", "aep_mtr_install_ts",
    "aep_city", "aep_zip", "aep_state", "hdp_insert_dttm", "hdp_update_dttm", "hdp_update_user", "authority",
    "aep_usage_dt", "data_type", "aep_opco", "aep_meter_bucket",
]

# Output view. Every column not named in OUTPUT_TYPES is a string.
OUTPUT_COLUMNS = [
    "serialnumber", "source", "aep_devicecode", "isvirtual_meter", "timezoneoffset", "aep_premise_nb",
    "aep_service_point", "aep_mtr_install_ts", "aep_mtr_removal_ts", "aep_srvc_dlvry_id",
    "aep_comp_mtr_mltplr", "name_register", "isvirtual_register", "toutier", "toutiername",
    "aep_srvc_qlty_idntfr", "aep_channel_id", "aep_raw_uom", "aep_sec_per_intrvl", "aep_meter_alias",
    "aep_meter_program", "aep_billable_ind", "aep_usage_type", "aep_timezone_cd", "endtimeperiod",
    "starttimeperiod", "value", "aep_raw_value", "scalarfloat", "aep_data_quality_cd", "aep_data_validation",
    "aep_acct_cls_cd", "aep_acct_type_cd", "aep_mtr_pnt_nb", "aep_tarf_pnt_nb", "aep_endtime_utc", "aep_city",
    "aep_zip", "aep_state", "hdp_update_user", "hdp_insert_dttm", "hdp_update_dttm", "authority",
    "aep_derived_uom", "data_type", "aep_opco", "aep_usage_dt", "aep_meter_bucket",
]
OUTPUT_TYPES = {
    "aep_comp_mtr_mltplr": "double",
    "aep_sec_per_intrvl": "double",
    "value": "float",
    "aep_raw_value": "float",
    "scalarfloat": "float",
    "hdp_insert_dttm": "timestamp",
    "hdp_update_dttm": "timestamp",
}

CONSUME_COLUMNS = [
    "serialnumber", "source", "aep_devicecode", "isvirtual_meter", "timezoneoffset", "aep_premise_nb",
    "aep_service_point", "aep_srvc_dlvry_id", "name_register", "isvirtual_register", "toutier", "toutiername",
    "aep_derived_uom", "aep_raw_uom", "aep_srvc_qlty_idntfr", "aep_channel_id", "aep_sec_per_intrvl",
    "aep_meter_alias", "aep_meter_program", "aep_billable_ind", "aep_usage_type", "aep_timezone_cd",
    "endtimeperiod", "starttimeperiod", "value", "aep_raw_value", "scalarfloat", "aep_data_quality_cd",
    "aep_data_validation", "aep_acct_cls_cd", "aep_acct_type_cd", "aep_mtr_pnt_nb", "aep_tarf_pnt_nb",
    "aep_comp_mtr_mltplr", "aep_endtime_utc", "aep_mtr_removal_ts", "aep_mtr_install_ts", "aep_city",
    "aep_zip", "aep_state", "hdp_update_user", "hdp_insert_dttm", "hdp_update_dttm", "authority", "aep_opco",
    "aep_usage_dt", "aep_meter_bucket",
]

# Columns that a matched merge row takes from the source.
UPDATE_COLUMNS = [
    "aep_srvc_qlty_idntfr", "aep_channel_id", "aep_sec_per_intrvl", "aep_meter_alias", "aep_meter_program",
    "aep_usage_type", "aep_timezone_cd", "endtimeperiod", "starttimeperiod", "value", "aep_raw_value",
    "scalarfloat", "aep_acct_cls_cd", "aep_acct_type_cd", "aep_mtr_pnt_nb", "aep_comp_mtr_mltplr",
    "aep_endtime_utc", "aep_mtr_removal_ts", "aep_mtr_install_ts", "aep_city", "aep_zip", "aep_state",
    "hdp_update_user", "hdp_update_dttm", "authority",
]

INCREMENTAL_COLUMNS = [
    "serialnumber", "source", "aep_devicecode", "isvirtual_meter", "timezoneoffset", "aep_premise_nb",
    "aep_service_point", "aep_mtr_install_ts", "aep_mtr_removal_ts", "aep_srvc_dlvry_id",
    "aep_comp_mtr_mltplr", "name_register", "isvirtual_register", "toutier", "toutiername",
    "aep_srvc_qlty_idntfr", "aep_channel_id", "aep_raw_uom", "aep_sec_per_intrvl", "aep_meter_alias",
    "aep_meter_program", "aep_billable_ind", "aep_usage_type", "aep_timezone_cd", "endtimeperiod",
    "starttimeperiod", "value", "aep_raw_value", "scalarfloat", "aep_data_quality_cd", "aep_data_validation",
    "aep_acct_cls_cd", "aep_acct_type_cd", "aep_mtr_pnt_nb", "aep_tarf_pnt_nb", "aep_endtime_utc", "aep_city",
    "aep_zip", "aep_state", "hdp_update_user", "hdp_insert_dttm", "hdp_update_dttm", "authority",
    "aep_usage_dt", "aep_derived_uom", "aep_opco", "run_date",
]

# Extract of the consume table used for side-by-side checks.
EXTRACT_COLUMNS = [
    "serialnumber", "aep_usage_dt", "aep_channel_id", "aep_raw_uom", "endtimeperiod", "starttimeperiod",
    "value", "aep_raw_value", "scalarfloat", "aep_derived_uom", "name_register", "aep_srvc_qlty_idntfr",
    "aep_sec_per_intrvl", "aep_premise_nb", "aep_service_point", "aep_srvc_dlvry_id", "aep_devicecode",
    "aep_meter_program", "aep_acct_cls_cd", "aep_acct_type_cd", "aep_mtr_pnt_nb", "aep_tarf_pnt_nb",
    "aep_endtime_utc", "aep_city", "aep_zip", "aep_state", "authority", "timezoneoffset", "aep_meter_bucket",
    "hdp_update_user",
]

# --- Keys --------------------------------------------------------------------

BUSINESS_KEY = [
    "aep_usage_dt", "aep_meter_bucket", "serialnumber", "aep_channel_id", "aep_raw_uom", "endtimeperiod",
]
CONSUME_PARTITIONS = ["aep_usage_dt"]
#: Layout of a consume table whose tenants are written at once.
TENANT_PARTITIONS = ["aep_usage_dt", "aep_opco"]
INCREMENTAL_PARTITIONS = ["aep_opco", "run_date"]
AUDIT_COLUMNS = ["hdp_insert_dttm", "hdp_update_dttm"]


def table_schema(columns: list[str], **overrides: str) -> str:
    """DDL of a stored table, with the usage date typed as a date."""
    types = {**OUTPUT_TYPES, "aep_usage_dt": "date", **overrides}
    return ", ".join(f"{c} {types.get(c, 'string')}" for c in columns)


CONSUME_SCHEMA = table_schema(CONSUME_COLUMNS)
INCREMENTAL_SCHEMA = table_schema(INCREMENTAL_COLUMNS)
EXTRACT_SCHEMA = ", ".join(f"{c} string" for c in EXTRACT_COLUMNS)

# --- Tenants -----------------------------------------------------------------

# Company codes and time zone label per tenant.
TENANT_COMPANY_CODES = {
    "oh": ["07", "10"],
    "im": ["04"],
    "pso": ["95"],
    "tx": ["94", "97"],
    "ap": ["01", "02", "06"],
    "swp": ["96"],
}
TENANT_ZONE_LABELS = {
    "oh": "US/Eastern",
    "im": "US/Eastern",
    "pso": "US/Central",
    "ap": "US/Eastern",
    "swp": "US/Eastern",
}


@dataclass(frozen=True)
class Tenant:
    code: str
    company_codes: tuple[str, ...]
    zone_label: str
    dimension_zone: str = DIMENSION_ZONE


def tenant(code: str, zone_label: str | None = None) -> Tenant:
    """Look up a tenant; fails on an unknown code or a tenant without a time zone."""
    if code not in TENANT_COMPANY_CODES:
        raise ValueError(f"unknown tenant {code!r}")
    label = zone_label or TENANT_ZONE_LABELS.get(code)
    if label is None:
        raise ValueError(f"tenant {code!r} has no time zone; pass zone_label")
    return Tenant(code, tuple(TENANT_COMPANY_CODES[code]), label)
