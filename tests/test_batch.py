"""The batch job on synthetic files, twice, with a re-delivery."""

import csv
import os
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from gridtally import config
from gridtally.functions import times
from gridtally.operators.merge import merge_upsert
from gridtally.plans import acceptance, views
from gridtally.plans.batch import run_batch
from gridtally.session import shared_folder, work_path
from gridtally.sinks import tables
from gridtally.sinks.staging import Watched, batch_metrics, materialize, stage, stage_counted
from gridtally.sources import files
from gridtally.sources.documents import file_count, read_documents
from gridtally.sources.files import (
    delivered_files,
    limit_files,
    marked_directories,
    refuse_hidden,
    select_batch_files,
)
from gridtally.sources.listing import can_open, list_tree
from gridtally.sources.tables import read_extract, read_parquet, read_table
from test_operators import validity_row

TENANT = config.tenant("oh")
RUN_1 = datetime(2026, 1, 11, 15, 0, 0, tzinfo=timezone.utc)
RUN_2 = datetime(2026, 1, 12, 15, 0, 0, tzinfo=timezone.utc)


def landed(path, text, moment):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    os.utime(path, (moment.timestamp(), moment.timestamp()))


def xml(meter, value, hours=2, prefix="n:"):
    intervals = "".join(
        f"""<{prefix}Interval EndTime="2026-01-10T{hour:02d}:00:00-05:00" BlockSequenceNumber="{hour}"
            GatewayCollectedTime="2026-01-10T12:00:00-05:00" IntervalSequenceNumber="1">
          <{prefix}Reading Channel="101" RawValue="{value}" Value="{value}" UOM=" kWh(del) "/>
          <{prefix}Reading Channel="777" RawValue="1" Value="1.25" UOM="V"/>
          <{prefix}Reading Channel="102" RawValue="1" UOM="V"/>
        </{prefix}Interval>"""
        for hour in range(hours)
    )
    space = ' xmlns:n="urn:x"' if prefix else ""
    return f"""<Root{space}><{prefix}MeterData MeterName=" {meter} " UtilDeviceID="u" MacID="m">
      <{prefix}IntervalReadData NumberIntervals="{hours}" StartTime="2026-01-10T00:00:00-05:00"
         EndTime="2026-01-10T02:00:00-05:00" IntervalLength="60">{intervals}</{prefix}IntervalReadData>
    </{prefix}MeterData></Root>"""


def at(day, hour=12):
    return datetime(2026, 1, day, hour, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def base(tmp_path_factory):
    root = tmp_path_factory.mktemp("store") / "raw"
    landed(root / "d1" / "a.xml", xml("900000010", 2.5), at(10))
    landed(root / "d1" / "sub" / "b.xml.part", xml("900000011", 3.5, prefix=""), at(10))
    landed(root / "d1" / "empty.xml", "", at(10))
    landed(root / "d1" / "notes.txt", "no data", at(10))
    landed(root / "d1" / "index.txt", "", at(10))
    landed(root / "d2" / "a.xml", xml("900000010", 9.5, hours=3), at(11))
    landed(root / "d2" / "index.txt", "", at(11))
    landed(root / "deep" / "x" / "index.txt", "", at(10))
    landed(root / "deep" / "c.xml", xml("900000012", 1), at(10))
    landed(root / "nodata" / "index.txt", "", at(10))
    landed(root / "late" / "c.xml", xml("900000012", 1), at(10))
    landed(root / "late" / "index.txt", "", at(20))
    return str(root)


@pytest.fixture(scope="module")
def units(spark):
    names = "aep_opco aep_channel_id aep_derived_uom name_register aep_srvc_qlty_idntfr value_mltplr_flg"
    return spark.createDataFrame(
        [("oh", "101", "kwh", "E-KWH-mtr_ivl_len-TOT", "TOT", "Y"), ("ap", "777", "v", "x", "y", "N")],
        ", ".join(f"{n} string" for n in names.split()),
    )


def validity(spark, **changes):
    schema = ", ".join(f"{c} string" for c in config.VALIDITY_COLUMNS)
    known = {
        "prem_nb": "071234567", "bill_cnst": "4", "tarf_pnt_nb": "t1", "mtr_pnt_nb": "m1",
        "serv_city_ad": "Town", "serv_zip_ad": "431234567", "state_cd": "ZZ", "devc_cd": "dev",
    }
    return spark.createDataFrame([validity_row(**(known | changes))], schema)


def bound(text):
    return times.batch_bound(text, TENANT.dimension_zone)


def test_selection(spark, base):
    # the marker of d1 landed at 07:00 New York time, that of d2 a day later
    window = bound("2026-01-10 07:00:00"), bound("2026-01-11 07:00:00")
    directories = marked_directories(spark, base, *window)
    assert [d.rsplit("/", 1)[1] for d in directories] == ["d1", "nodata"]
    files = delivered_files(spark, base, directories)
    names = sorted((r.dir[-3:], r.path.rsplit("/raw/", 1)[1]) for r in files.collect())
    assert names == [("/d1", "d1/a.xml"), ("/d1", "d1/sub/b.xml.part")]
    assert [r.path[-8:] for r in limit_files(files, 1).collect()] == ["d1/a.xml"]


def test_window_end_is_open(spark, base):
    window = bound("2026-01-10 00:00:00"), bound("2026-01-10 07:00:00")
    assert marked_directories(spark, base, *window) == []
    assert marked_directories(spark, base + "/missing", *window) == []
    assert delivered_files(spark, base, []).isEmpty()


def test_deeper_markers_count_when_allowed(spark, base):
    window = bound("2026-01-10 07:00:00"), bound("2026-01-10 08:00:00")
    directories = marked_directories(spark, base, *window, max_depth=3)
    assert [d.rsplit("/", 1)[1] for d in directories] == ["d1", "deep", "nodata"]


def test_selection_from_an_inventory(spark, base):
    listed = [
        (f"{dir}/{file}", os.path.getsize(f"{dir}/{file}"), os.path.getmtime(f"{dir}/{file}"))
        for dir, _, names in os.walk(base)
        for file in names
    ]
    inventory = spark.createDataFrame(listed, "path string, length long, s double").select(
        "path", "length", F.timestamp_seconds("s").alias("modificationTime")
    )
    for text in [("2026-01-10 07:00:00", "2026-01-11 07:00:00"), ("2026-01-11 00:00:00", "2026-01-30 00:00:00")]:
        window = [bound(t) for t in text]
        files = select_batch_files(inventory, base, *window)
        live = delivered_files(spark, base, marked_directories(spark, base, *window))
        assert sorted(r.path for r in files.collect()) == sorted(
            r.path.removeprefix("file:") for r in live.collect()
        )


def test_documents(spark, base, tmp_path):
    docs = read_documents(spark, [f"{base}/d1", f"{base}/d2/a.xml"])
    assert docs.count() == 3
    assert docs.schema["IntervalReadData"].dataType.elementType.names[-1] == "Interval"
    (tmp_path / "bad.xml").write_text('<Root><MeterData MeterName="1"><Interval></MeterData></Root>')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_documents(spark, [str(tmp_path)]).collect()


def test_empty_batch_writes_nothing(spark, base, units, tmp_path):
    result = run_batch(
        spark, base, TENANT, "2020-01-01 00:00:00", "2020-01-02 00:00:00", RUN_1, units,
        validity(spark), str(tmp_path / "consume"), str(tmp_path / "incremental"),
    )
    assert result.empty and not any(tmp_path.iterdir())


def test_batches(spark, base, units, tmp_path):
    consume_path, incremental_path = str(tmp_path / "consume"), str(tmp_path / "incremental")

    def run(start, end, run_ts, dim, **more):
        return run_batch(
            spark, base, TENANT, start, end, run_ts, units, dim, consume_path, incremental_path, **more
        )

    def consumed():
        table = read_parquet(spark, consume_path, config.CONSUME_SCHEMA)
        return table.select(*config.CONSUME_COLUMNS)

    first = run("2026-01-10 00:00:00", "2026-01-11 00:00:00", RUN_1, validity(spark))
    assert first.documents["rows"] == 2 and first.files == 3 and first.rejected == 0
    assert first.readings["rows"] == 8  # 2 meters, 2 hours, 2 complete channels
    rows = consumed().collect()
    assert len(rows) == 8 and {r.hdp_update_user for r in rows} == {"info-insert"}
    one = consumed().filter(
        "serialnumber = '900000010' and aep_channel_id = '101' and endtimeperiod like '%T01%'"
    ).first()
    assert one.value == 10.0 and one.aep_raw_value == 2.5 and one.scalarfloat == 4.0
    assert one.name_register == "E-KWH-60-TOT" and one.aep_derived_uom == "KWH"
    assert one.aep_raw_uom == "kwh(del)" and one.aep_sec_per_intrvl == 3600.0
    assert one.aep_service_point == "071234567-t1-m1" and one.authority == "07"
    assert one.aep_zip == "43123" and one.aep_meter_bucket == "10"
    assert one.aep_endtime_utc == str(int(at(10, 6).timestamp()))
    assert str(one.aep_usage_dt) == "2026-01-10"
    unmapped = consumed().filter("aep_channel_id = '777'").first()
    assert unmapped.aep_derived_uom == "UNK" and unmapped.value == 1.25
    # the interval that ends at midnight belongs to the day before
    midnight = consumed().filter("endtimeperiod like '%T00:00%'").first()
    assert str(midnight.aep_usage_dt) == "2026-01-09"

    # the same run again changes nothing but the update stamp
    again = run("2026-01-10 00:00:00", "2026-01-11 00:00:00", RUN_1, validity(spark))
    assert again.readings == first.readings
    assert {r.hdp_update_user for r in consumed().collect()} == {"info-update"}
    same = [c for c in config.CONSUME_COLUMNS if c != "hdp_update_user"]
    assert sorted(map(str, consumed().select(*same).collect())) == sorted(
        str(tuple_of(r, same)) for r in rows
    )

    # a re-delivery whose device is unknown to the dimension: updated columns turn
    # NULL, insert-only columns stay
    other = validity(spark, mfr_devc_ser_nbr="1")
    run("2026-01-11 00:00:00", "2026-01-12 00:00:00", RUN_2, other)
    table = consumed().filter("serialnumber = '900000010' and aep_channel_id = '101'")
    got = {r.endtimeperiod[11:13]: r for r in table.collect()}
    assert {h: r.hdp_update_user for h, r in got.items()} == {
        "00": "info-update", "01": "info-update", "02": "info-insert"
    }
    assert got["01"].aep_premise_nb == "071234567" and got["01"].aep_devicecode == "dev"
    assert got["01"].aep_city is None and got["01"].authority is None and got["01"].value is None
    assert got["01"].aep_raw_value == 9.5
    assert got["01"].hdp_insert_dttm < got["01"].hdp_update_dttm
    assert got["02"].aep_premise_nb is None
    assert consumed().count() == 10

    incremental = read_parquet(spark, incremental_path, config.INCREMENTAL_SCHEMA)
    incremental = incremental.select(*config.INCREMENTAL_COLUMNS)
    per_run = {r.run_date: r["count"] for r in incremental.groupBy("run_date").count().collect()}
    assert per_run == {"20260111_150000": 8, "20260112_150000": 6}

    checks = acceptance.acceptance_checks(
        consumed(), incremental, "oh", ["2026-01-09", "2026-01-10"]
    )
    assert len(checks) == 10
    found = {name: [tuple(r) for r in df.collect()] for name, df in checks.items()}
    assert found["total_records"] == [(10,)]
    assert found["distinct_meters"] == [(2,)]
    assert found["null_serials"] == [(0,)]
    assert found["incremental_records"] == [("oh", 14)]
    assert found["run_extent"] == [("20260111_150000", "20260112_150000")]
    assert sorted(found["insert_update_split"]) == [("info-insert", 2), ("info-update", 8)]
    assert len(found["sample"]) == 10

    # nine days later both runs have expired
    later = datetime(2026, 1, 21, 15, 0, 0, tzinfo=timezone.utc)
    dropped = tables.publish_incremental(incremental.limit(0), incremental_path, "oh", later)
    assert dropped == ["20260111_150000", "20260112_150000"]


def tuple_of(row, columns):
    from pyspark.sql import Row

    return Row(**{c: row[c] for c in columns})


def test_readings_without_an_instant_are_set_aside(spark, units, tmp_path):
    root = tmp_path / "raw"
    text = xml("900000010", 2.5)
    landed(root / "d1" / "a.xml", text.replace('T01:00:00-05:00"', 'T01:00:00"'), at(10))
    landed(root / "d1" / "index.txt", "", at(10))
    result = run_batch(
        spark, str(root), TENANT, "2026-01-10 00:00:00", "2026-01-11 00:00:00", RUN_1, units,
        validity(spark), str(tmp_path / "c"), str(tmp_path / "i"), rejected_path=str(tmp_path / "r"),
    )
    assert result.rejected == 2 and result.readings["rows"] == 2
    assert {r.run_date for r in spark.read.parquet(str(tmp_path / "r")).collect()} == {"20260111_150000"}


def test_a_failed_batch_leaves_no_work_behind(spark, base, units, tmp_path):
    folder = os.path.join(shared_folder(spark), "gridtally")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    twice = units.withColumn("name_register", F.lit("other")).union(units)
    with pytest.raises(Exception, match="more than one row for key"):
        run_batch(
            spark, base, TENANT, "2026-01-10 00:00:00", "2026-01-11 00:00:00", RUN_1, twice,
            validity(spark), str(tmp_path / "c"), str(tmp_path / "i"),
        )
    assert set(os.listdir(folder)) == before


def test_odd_names(spark, tmp_path):
    root = tmp_path / "in" / "box" / "in"  # the base's text occurs twice in its own path
    for name in ("d[2]", "d{a,b}", "d*"):
        landed(root / name / "a.xml", xml("900000010", 1), at(10))
        landed(root / name / "index.txt", "", at(10))
    window = bound("2026-01-10 00:00:00"), bound("2026-01-11 00:00:00")
    for base in (str(root), f"file:{root}/"):
        directories = marked_directories(spark, base, *window)
        assert [d.rsplit("/", 1)[1] for d in directories] == ["d*", "d[2]", "d{a,b}"]
        assert delivered_files(spark, base, directories).count() == 3
        assert read_documents(spark, directories).count() == 3
        assert file_count(read_documents(spark, directories[1:2])) == 1
    listing = spark.createDataFrame(
        [(p, 1, at(10)) for p in ("/in/inbox/in/d1/index.txt", "/in/inbox/in/d1/a.xml", "/other/in/inbox/in/d1/b.xml")],
        "path string, length long, modificationTime timestamp",
    )
    found = select_batch_files(listing, "/in/inbox/in", *window).collect()
    assert [tuple(r) for r in found] == [("/in/inbox/in/d1", "/in/inbox/in/d1/a.xml")]
    landed(root / "d*" / "sub" / "_a.xml", xml("900000010", 1), at(10))
    with pytest.raises(ValueError, match="hidden names"):
        refuse_hidden(spark, directories)


def rows_of(tree):
    return sorted((r.path, r.length, r.hidden) for r in tree.collect())


def test_listing_has_hidden_names(spark, tmp_path):
    root = tmp_path / "in {box}"
    for name in ("d 1/a.xml", "d 1/_b.xml", "d 1/x/.hid/c.xml", "d2/_part=1/d.xml", "d2/.a.xml.crc", "d2/e.xml._COPYING_", "d3/f.txt"):
        landed(root / name, "1234", at(10))
    directories = [f"file:{root}/d 1", f"file:{root}/d2", f"file:{root}/d3", f"file:{root}/none"]
    (root / "none").mkdir()
    tree = {r.path.split("box}/")[1]: r for r in list_tree(spark, directories).collect()}
    assert {name: r.hidden for name, r in tree.items()} == {
        "d 1/a.xml": False, "d 1/_b.xml": True, "d 1/x/.hid/c.xml": True, "d2/_part=1/d.xml": False,
        "d2/e.xml._COPYING_": True, "d3/f.txt": False,
    }
    one = tree["d 1/a.xml"]
    assert (one.length, one.dir) == (4, directories[0]) and one.modificationTime.timestamp() == at(10).timestamp()
    with pytest.raises(ValueError, match="3 data files with hidden names"):
        refuse_hidden(spark, directories)
    refuse_hidden(spark, directories[2:])
    with pytest.raises(ValueError, match="hidden names"):
        delivered_files(spark, str(root), directories[:1])
    assert can_open(f"file://{root}/d2") and not can_open("viewfs://in/x")
    assert rows_of(list_tree(spark, [f"file://{root}/d2"])) == rows_of(list_tree(spark, [f"file:{root}/d2"]))
    # stores that Arrow cannot open are searched by patterns
    assert sorted(p.rsplit("/", 1)[1] for p in files._hidden_by_glob(spark, directories, ".xml")) == ["_b.xml"]


def test_counts_come_from_the_writes(spark, base, units, tmp_path, monkeypatch):
    """No row is counted by a job of its own."""

    def refuse(self):
        raise AssertionError("a count job")

    monkeypatch.setattr(type(spark.range(1)), "count", refuse)
    monkeypatch.setattr(type(spark.range(1)), "isEmpty", refuse)
    result = run_batch(
        spark, base, TENANT, "2026-01-10 00:00:00", "2026-01-11 00:00:00", RUN_1, units,
        validity(spark), str(tmp_path / "c"), str(tmp_path / "i"),
    )
    assert (result.documents["rows"], result.readings["rows"], result.rejected) == (2, 8, 0)


def test_staged_rows_are_counted_once(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("k"))
    for more in ({}, {"partition_by": ["k"]}, {"max_partitions": 2}):
        staged, n = stage_counted(df.repartition(5, "k"), work_path(spark, "t"), **more)
        assert n == 1000 == staged.count()
    seen = Watched(df, F.col("id") > 998)
    assert stage_counted(seen.df.groupBy("k").count(), work_path(spark, "t"))[1] == 7 and seen.any()
    none = Watched(df, F.col("id") < 0)
    assert stage_counted(none.df.filter("id < 0"), work_path(spark, "t"))[1] == 0 and not none.any()


def test_tenants_apart(spark, base, units, tmp_path):
    other = spark.createDataFrame(units.collect(), units.schema).withColumn("aep_opco", F.lit("ap"))
    for tenant, map_ in ((TENANT, units), (config.tenant("ap"), other)):
        run_batch(
            spark, base, tenant, "2026-01-10 00:00:00", "2026-01-11 00:00:00", RUN_1, map_,
            validity(spark), str(tmp_path / "c"), str(tmp_path / "i"), tenants_apart=True,
        )
    table = read_parquet(spark, str(tmp_path / "c"), config.CONSUME_SCHEMA)
    assert {r.aep_opco: r["count"] for r in table.groupBy("aep_opco").count().collect()} == {"oh": 8, "ap": 8}
    assert (tmp_path / "c" / "aep_usage_dt=2026-01-10" / "aep_opco=oh").exists()


def test_an_interrupted_swap_is_finished(spark, tmp_path):
    path, schema = tmp_path / "t", "id int, v int, day string"

    def write(*data):
        source = spark.createDataFrame(list(data), schema)
        return tables.write_merge(
            source, str(path), schema=schema, keys=["day", "id"], update_cols=["v"], partition_by=["day"]
        )

    def stored():
        return sorted(tuple(r) for r in read_parquet(spark, str(path), schema).collect())

    write((1, 1, "a"), (2, 2, "b"), (3, 3, "c/d"))
    new = spark.createDataFrame([(1, 9, "a"), (2, 9, "b")], schema)
    new.write.partitionBy("day").parquet(str(path / "_swap--1"))  # complete, nothing moved yet
    (path / "day=a").rename(tmp_path / "gone")  # one old partition was already deleted
    new.write.partitionBy("day").parquet(str(path / "_swap--0"))
    (path / "_swap--0" / "_SUCCESS").unlink()  # this one was never complete
    write((3, 4, "c/d"))
    assert stored() == [(1, 9, "a"), (2, 9, "b"), (3, 4, "c/d")]
    assert not [p for p in path.iterdir() if p.name.startswith("_swap")]


def test_an_upsert_lists_only_its_partitions(spark, tmp_path):
    schema = "id int, v int, day string"
    source = spark.createDataFrame([(i, i, f"d{i % 20}") for i in range(100)], schema)
    tables.write_merge(source, str(tmp_path), schema=schema, keys=["day", "id"], update_cols=["v"], partition_by=["day"])
    read = tables.read_partitions(spark, str(tmp_path), schema, ["day"], [("d3",), ("none",), (None,)])
    assert {f.split("day=")[1].split("/")[0] for f in read.inputFiles()} == {"d3"}
    assert read.count() == 5 and read.columns == ["id", "v", "day"]


def test_overlapping_validity_rows_leave_one_reading(spark, base, units):
    dim = views.prepare_validity_dim(
        validity(spark).union(validity(spark, prem_nb="079999999", mtr_inst_ts="2021-01-01 00:00:00")),
        TENANT.company_codes,
    )
    from gridtally.operators.flatten import flatten_readings
    from gridtally.sources.tables import unit_map

    readings = flatten_readings(read_documents(spark, [f"{base}/d1/a.xml"]), "x")
    kept = views.readings_view(readings, unit_map(units, "oh"), dim, TENANT, RUN_1)
    assert kept.count() == 4
    assert {r.aep_premise_nb for r in kept.collect()} == {"079999999"}  # the later install wins


def test_stage_keeps_types_and_metrics(spark):
    df = spark.createDataFrame([("2026-01-10", 1), (None, 2)], "aep_usage_dt string, v int")
    staged = stage(df, work_path(spark, "t"), partition_by=["aep_usage_dt"])
    assert staged.schema == df.schema
    assert sorted(map(str, staged.collect())) == sorted(map(str, df.collect()))
    assert batch_metrics(stage(df, work_path(spark, "t"), max_partitions=1)) == {
        "rows": 2, "partitions": 1,
    }
    assert work_path(spark, "t").startswith(shared_folder(spark))
    assert materialize(df).count() == 2


def test_staging_nothing(spark):
    df = spark.createDataFrame([], "aep_usage_dt string, v int")
    assert stage(df, work_path(spark, "t"), partition_by=["aep_usage_dt"]).count() == 0


def test_merge_rewrites_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "id int, v int, day string"

    def write(*data):
        source = spark.createDataFrame(list(data), schema)
        return tables.write_merge(
            source, path, schema=schema, keys=["day", "id"], update_cols=["v"], partition_by=["day"]
        )

    write((1, 1, "a"), (2, 2, "b"), (3, 3, None))
    before = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "t").glob("day=b/*.parquet")}
    assert sorted(write((1, 9, "a"), (4, 4, None)), key=str) == [None, "a"]
    after = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "t").glob("day=b/*.parquet")}
    assert before == after
    got = read_parquet(spark, path, schema).collect()
    assert sorted((str(r.day), r.id, r.v) for r in got) == [
        ("None", 3, 3), ("None", 4, 4), ("a", 1, 9), ("b", 2, 2)
    ]
    assert write() == []


def test_catalog_tables(spark):
    df = spark.range(3).withColumn("aep_opco", F.lit("oh")).withColumn("run_date", F.lit("x"))
    df.write.mode("overwrite").saveAsTable("runs")
    try:
        assert read_table(spark, "runs").count() == 3
        # this catalog has no row-level operations: the error is passed on
        with pytest.raises(Exception, match="(?i)delete|unsupported"):
            tables.delete_expired_from_table(spark, "runs", "oh", RUN_1)
    finally:
        spark.sql("DROP TABLE runs")


def test_extract(spark, tmp_path):
    path = tmp_path / "extract.csv"
    with open(path, "w", newline="") as f:
        out = csv.writer(f, quoting=csv.QUOTE_ALL)
        out.writerow(config.EXTRACT_COLUMNS)
        out.writerow(["900000010", "2026-01-10"] + [""] * (len(config.EXTRACT_COLUMNS) - 2))
    row = read_extract(spark, str(path)).first()
    assert len(row) == 30 and row.serialnumber == "900000010" and row.value is None


def test_unhealthy_update_keeps_insert_only_columns(spark):
    schema = "id int, kept string, changed string"
    target = spark.createDataFrame([(1, "p", "c")], schema)
    source = spark.createDataFrame([(1, None, None)], schema)
    merged = merge_upsert(target, source, ["id"], ["changed"])
    assert tuple(merged.first()) == (1, "p", None)
