from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from gridtally import config
from gridtally.functions import times, values
from gridtally.operators.flatten import derive_interval_times


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def interval(spark, end, minutes="15"):
    df = spark.createDataFrame([(end, minutes)], "int_endtime string, intervallength string")
    return derive_interval_times(df).first()


def utc(*parts):
    return int(datetime(*parts, tzinfo=timezone.utc).timestamp())


def test_interval_times_keep_the_sent_offset(spark, any_zone):
    row = interval(spark, "2026-01-10T00:15:00-05:00")
    assert row.starttime == "2026-01-10T00:00:00-05:00"
    assert row.endtime == "2026-01-10T00:15:00-05:00"
    assert row.interval_epoch == "-05:00"
    assert row.unix_endtime == utc(2026, 1, 10, 5, 15)


def test_midnight_end_belongs_to_the_day_before(spark, any_zone):
    row = interval(spark, "2026-01-11T00:00:00-05:00")
    assert row.starttime == "2026-01-10T23:45:00-05:00"
    assert one(spark, d=values.usage_date(F.lit(row.starttime))).d == "2026-01-10"


@pytest.mark.parametrize(
    "end, start, epoch",
    [
        # inside the hour that New York skips
        ("2026-03-08T02:15:00-05:00", "2026-03-08T02:00:00-05:00", utc(2026, 3, 8, 7, 15)),
        # right after the skip, both in the new offset
        ("2026-03-08T03:00:00-04:00", "2026-03-08T02:45:00-04:00", utc(2026, 3, 8, 7, 0)),
        # both passes of the repeated hour
        ("2026-11-01T01:30:00-04:00", "2026-11-01T01:15:00-04:00", utc(2026, 11, 1, 5, 30)),
        ("2026-11-01T01:30:00-05:00", "2026-11-01T01:15:00-05:00", utc(2026, 11, 1, 6, 30)),
        ("2026-07-01T12:00:00+05:30", "2026-07-01T11:45:00+05:30", utc(2026, 7, 1, 6, 30)),
    ],
)
def test_clock_changes(spark, any_zone, end, start, epoch):
    row = interval(spark, end)
    assert (row.starttime, row.unix_endtime) == (start, epoch)


def test_z_suffix_is_offset_zero(spark):
    row = interval(spark, "2026-01-10T00:15:00Z")
    assert row.interval_epoch == "+00:00"
    assert row.endtime == "2026-01-10T00:15:00+00:00"
    assert row.unix_endtime == utc(2026, 1, 10, 0, 15)


def test_fraction_of_a_second_is_cut(spark):
    row = interval(spark, "2026-01-10T00:15:00.750-05:00")
    assert row.endtime == "2026-01-10T00:15:00-05:00"


@pytest.mark.parametrize("end", [None, "", "bad", "2026-13-40T00:00:00-05:00", "2026-01-10T00:15"])
def test_unparseable_end_gives_null(spark, end):
    row = interval(spark, end)
    assert (row.starttime, row.endtime, row.unix_endtime) == (None, None, None)


def test_end_without_offset_has_no_epoch(spark):
    assert interval(spark, "2026-01-10T00:15:00").unix_endtime is None


@pytest.mark.parametrize("minutes, start", [("5", "00:10"), ("60", "23:15"), ("1440", "00:15")])
def test_interval_lengths(spark, minutes, start):
    assert interval(spark, "2026-01-10T00:15:00-05:00", minutes).starttime[11:16] == start


def test_bad_interval_length_gives_null_start(spark):
    row = interval(spark, "2026-01-10T00:15:00-05:00", "x")
    assert row.starttime is None and row.endtime is not None


def test_zone_epoch(spark, any_zone):
    wall = times.wall_time(F.lit("2026-07-01 00:00:00.000"))
    day = times.wall_date(F.lit(config.OPEN_END)).cast("timestamp_ntz")
    row = one(
        spark,
        summer=times.zone_epoch(wall, "America/New_York"),
        utc=times.zone_epoch(wall, "UTC"),
        open=times.zone_epoch(day, "America/New_York"),
    )
    assert row.summer == utc(2026, 7, 1, 4)
    assert row.utc == utc(2026, 7, 1)
    assert row.open == utc(9999, 1, 1, 5)


def test_batch_bound(spark, any_zone):
    bound = times.batch_bound("2026-03-27 13:50:03", "America/New_York")
    assert one(spark, s=F.unix_seconds(F.lit(bound))).s == utc(2026, 3, 27, 17, 50, 3)


def test_labels():
    assert times.batch_label(datetime(2026, 3, 27, 13, 50, 3)) == "20260327_1350"
    assert times.run_date(datetime(2026, 3, 27, 13, 50, 3)) == "20260327_135003"


@pytest.mark.parametrize(
    "value, flag, multiplier, expected",
    [
        ("2.5", "Y", "4", 10.0),
        ("2.5", "Y", None, None),
        ("2.5", "N", "4", 2.5),
        ("2.5", None, "4", 2.5),
        ("x", "N", "4", None),
    ],
)
def test_scale_value(spark, value, flag, multiplier, expected):
    df = spark.createDataFrame([(value, flag, multiplier)], "v string, f string, m string")
    assert df.select(values.scale_value(F.col("v"), F.col("f"), F.col("m"))).first()[0] == expected


@pytest.mark.parametrize("minutes", ["5", "15", "060", "1440"])
def test_register_name_takes_the_length_as_a_whole(spark, minutes):
    row = one(spark, r=values.register_name(F.lit("E-KWH-mtr_ivl_len-TOT"), F.lit(minutes)))
    assert row.r == f"E-KWH-{minutes}-TOT"


def test_keys_and_text(spark):
    none = F.lit(None).cast("string")
    row = one(
        spark,
        full=values.compose_key([F.lit("p"), F.lit("t"), F.lit("m")]),
        part=values.compose_key([F.lit("p"), none, F.lit("m")]),
        joined=values.joined_text([none, F.lit("D"), none]),
        blank=values.joined_text([none, none]),
        bucket=values.meter_bucket(F.lit(" 900000010 ")),
        unit=values.clean_unit(F.lit(" kWh(rec) ")),
    )
    assert tuple(row) == ("p-t-m", None, "D", "", "10", "kwh(rec)")


def test_tenants():
    assert config.tenant("oh").company_codes == ("07", "10")
    assert config.tenant("tx", zone_label="US/Central").company_codes == ("94", "97")
    with pytest.raises(ValueError, match="no time zone"):
        config.tenant("tx")
    with pytest.raises(ValueError, match="unknown tenant"):
        config.tenant("zz")


def test_layouts():
    assert len(config.STAGE_COLUMNS) == 40
    assert len(config.STANDARD_COLUMNS) == 43
    assert len(config.OUTPUT_COLUMNS) == 48
    assert len(config.CONSUME_COLUMNS) == 47
    assert len(config.INCREMENTAL_COLUMNS) == 47
    assert len(set(config.CONSUME_COLUMNS) - set(config.UPDATE_COLUMNS)) == 22
    assert len(config.UPDATE_COLUMNS) == 25
    assert set(config.CONSUME_COLUMNS) == set(config.OUTPUT_COLUMNS) - {"data_type"}
    assert set(config.INCREMENTAL_COLUMNS) == set(config.OUTPUT_COLUMNS) - {
        "data_type",
        "aep_meter_bucket",
    } | {"run_date"}
