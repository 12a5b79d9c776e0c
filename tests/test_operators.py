import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from gridtally import config
from gridtally.operators import quality
from gridtally.operators.dedup import dedup_latest, dedup_removed, duplicate_counts, newest_first
from gridtally.operators.flatten import flatten_readings
from gridtally.operators.joins import (
    disjoint_validity,
    lookup_left,
    validity_check,
    validity_diagnose,
    validity_join,
)
from gridtally.operators.keys import assert_unique
from gridtally.operators.merge import ACTION, merge_upsert, retain_recent, retention_cutoff
from gridtally.operators.reconcile import reconcile, reconcile_against
from gridtally.plans import views


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


# --- flatten -----------------------------------------------------------------


def reading(channel="102", raw="0", value="0.5", unit=" kWh(rec) "):
    return (channel, raw, value, unit, None)


def interval(readings, end="2026-01-10T00:15:00-05:00"):
    return (end, "1", "2026-01-10T00:20:00-05:00", "1", readings)


def block(intervals, start="2026-01-10T00:00:00-05:00"):
    return ("1", "2026-01-10T00:15:00-05:00", start, "15", intervals)


def documents(spark, *blocks):
    return spark.createDataFrame([("m", "u", "x", b) for b in blocks], config.RAW_SCHEMA)


def test_null_and_empty_arrays_drop_out(spark):
    docs = documents(
        spark, None, [], [block(None)], [block([])], [block([interval(None)])],
        [block([interval([])])], [block([interval([reading()])])],
    )
    assert flatten_readings(docs).count() == 1


def test_incomplete_readings_drop_out(spark):
    whole = reading()
    holes = [tuple(None if i == j else v for j, v in enumerate(whole)) for i in range(4)]
    docs = documents(spark, [block([interval([whole, *holes])])])
    assert flatten_readings(docs).count() == 1


@pytest.mark.parametrize(
    "start, kept",
    [
        ("2015-02-28T23:45:00-05:00", 0),
        ("2015-03-01T00:00:00-05:00", 1),
        ("bad", 0),
        (None, 0),
    ],
)
def test_date_floor(spark, start, kept):
    docs = documents(spark, [block([interval([reading()])], start)])
    assert flatten_readings(docs).count() == kept


def test_reading_columns(spark):
    docs = documents(spark, [block([interval([reading(), reading("103")])])])
    flat = flatten_readings(docs, "20260110_0000")
    assert len(flat.columns) == 19
    first = flat.filter("channel = '103'").first()
    assert (first.part_date, first.intervallength, first.value) == ("20260110_0000", "15", "0.5")


# --- lookup join -------------------------------------------------------------


def units(spark, *channels):
    data = [(c, "kwh", "E-mtr_ivl_len", "TOT", "Y") for c in channels]
    return spark.createDataFrame(data, "c string, u string, n string, q string, f string")


@pytest.mark.parametrize("strategy", [None, "broadcast", "merge"])
def test_lookup_misses_take_the_default(spark, strategy):
    fact = spark.createDataFrame([("1",), ("2",), (None,)], "channel string")
    joined = lookup_left(
        fact, units(spark, "1"), {"channel": "c"}, {"u": F.lit("UNK")}, strategy=strategy
    )
    assert rows(joined.select("channel", "u")) == [("1", "kwh"), ("2", "UNK"), (None, "UNK")]


@pytest.mark.parametrize("strategy", [None, "broadcast", "merge"])
def test_lookup_repeats_fail_or_fan_out(spark, strategy):
    fact = spark.createDataFrame([("1",), ("2",)], "channel string")
    repeated = units(spark, "1", "1")
    with pytest.raises(Exception, match="more than one row for key 1"):
        lookup_left(
            fact, repeated, {"channel": "c"}, strategy=strategy
        ).collect()
    fanned = lookup_left(
        fact, repeated, {"channel": "c"}, unique=False, strategy=strategy
    )
    assert fanned.count() == 3


def test_lookup_strategy_follows_the_bytes(spark):
    fact = spark.range(100).select(F.col("id").cast("string").alias("channel"))

    def plan(limit):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        known = spark.range(3).select(F.col("id").cast("string").alias("c"))
        joined = lookup_left(fact, known, {"channel": "c"})
        return joined._jdf.queryExecution().executedPlan().toString()

    try:
        assert "BroadcastHashJoin" in plan("10m")
        assert "BroadcastHashJoin" not in plan("-1")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# --- validity join -----------------------------------------------------------

INTERVALS = [("lo1", "hi1"), ("lo2", "hi2")]
DIM = "device string, premise string, lo1 long, hi1 long, lo2 long, hi2 long"


@pytest.mark.parametrize("strategy", [None, "broadcast", "merge"])
@pytest.mark.parametrize(
    "at, premises",
    [
        (99, [None]),
        (100, ["A"]),  # on the lower bounds
        (150, ["A"]),
        (200, ["A", "B"]),  # on the upper bound of A and the lower of B
        (201, ["B"]),
        (None, [None]),
        (10**9, ["B"]),  # open end
    ],
)
def test_validity_bounds_are_inclusive(spark, strategy, at, premises):
    dim = spark.createDataFrame(
        [
            ("d", "A", 100, 200, 50, 200),
            ("d", "B", 200, 10**11, 0, 10**11),
            ("d", "no overlap", 0, 120, 130, 10**11),
            ("d", "null bound", 0, None, 0, 10**11),
            ("e", "other", 0, 10**11, 0, 10**11),
            (None, "null key", 0, 10**11, 0, 10**11),
        ],
        DIM,
    )
    fact = spark.createDataFrame([("d", at)], "meter string, at long")
    joined = validity_join(
        fact, dim, ("meter", "device"), "at", INTERVALS, strategy=strategy
    )
    assert sorted([r.premise for r in joined.collect()], key=str) == premises


@pytest.mark.parametrize("strategy", ["broadcast", "merge"])
def test_validity_join_equals_brute_force(spark, strategy):
    fact = spark.range(600).select(
        # one device has a third of the readings
        F.when(F.col("id") < 200, "hot").otherwise(F.concat(F.lit("d"), F.col("id") % 7)).alias("meter"),
        F.when(F.col("id") % 11 != 0, (F.col("id") * 7919) % 5000).alias("at"),
        "id",
    )
    low = (F.col("n") * 104729) % 5000
    dim = spark.range(300).withColumnRenamed("id", "n").select(
        F.when(F.col("n") < 100, "hot").otherwise(F.concat(F.lit("d"), F.col("n") % 9)).alias("device"),
        F.col("n").cast("string").alias("premise"),
        low.alias("lo1"),
        (low + F.col("n") % 700).alias("hi1"),
        (low - 100).alias("lo2"),
        (low + (F.col("n") * 31) % 500).alias("hi2"),
    )
    joined = validity_join(
        fact, dim, ("meter", "device"), "at", INTERVALS, strategy=strategy
    )
    expected = []
    dims = dim.collect()
    for r in fact.collect():
        hits = [
            d.premise
            for d in dims
            if r["at"] is not None
            and d.device == r.meter
            and d.lo1 <= r["at"] <= d.hi1
            and d.lo2 <= r["at"] <= d.hi2
        ]
        expected += [(r.id, h) for h in hits or [None]]
    assert rows(joined.select("id", "premise")) == sorted(expected, key=str)


@pytest.fixture
def fixed_partitions(spark):
    """Twenty shuffle partitions that are neither merged nor split at run time."""
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "20",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def largest_share(df):
    """The largest part of the rows that one task holds."""
    # the hash needs every column, so that no join can be optimised away
    tasks = df.groupBy(F.spark_partition_id().alias("task")).agg(
        F.count("*").alias("n"), F.max(F.xxhash64(*df.columns)).alias("hash")
    )
    return tasks.agg(F.max("n") / F.sum("n"), F.max("hash")).first()[0]


@pytest.fixture
def skew_handling(spark):
    """Adaptive skew handling with thresholds that fit a small table."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "20",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def task_sizes(df, column):
    """Rows by task of a join; the counting reads the join's own tasks."""
    sizes = df.withColumn("task", F.spark_partition_id()).select("task", column)
    counts = {}
    for r in sizes.collect():
        counts[r.task] = counts.get(r.task, 0) + 1
    return counts, sizes._jdf.queryExecution().executedPlan().toString()


def busy_readings(spark, share):
    """Readings of which every ``share``-th is of one device; one reading is far off, as from a bad clock."""
    key = F.when(F.col("id") % share == 0, "hot").otherwise(F.concat(F.lit("d"), F.col("id") % 5000))
    at = F.when(F.col("id") == 9, 253370782800).otherwise((F.col("id") * 7919) % 200000)
    return spark.range(0, 60000, 1, 16).select(key.alias("meter"), at.alias("at"), "id")


@pytest.fixture(scope="module")
def stored_dims(spark, tmp_path_factory):
    """A lookup and a validity dimension as stored tables."""
    base = str(tmp_path_factory.mktemp("dims"))
    devices = busy_readings(spark, 3).select("meter").distinct()
    devices.select(F.col("meter").alias("device"), F.length("meter").alias("width")).write.parquet(f"{base}/lookup")
    halves = F.explode(F.array(F.lit(0), F.lit(1)))
    rows_ = devices.select(
        F.col("meter").alias("device"),
        halves.alias("half"),
    ).select(
        "device",
        (F.col("half") * 100_000).cast("long").alias("lo"),
        F.when(F.col("half") == 0, 150_000).otherwise(10**12).alias("hi"),
    )
    rows_.write.parquet(f"{base}/validity")
    return spark.read.parquet(f"{base}/lookup"), spark.read.parquet(f"{base}/validity")


@pytest.mark.parametrize("unique", [True, False])
def test_a_busy_channel_spreads_over_tasks(spark, skew_handling, stored_dims, unique):
    lookup, _ = stored_dims
    found = lookup_left(busy_readings(spark, 3), lookup, {"meter": "device"}, unique=unique)
    counts, plan = task_sizes(found, "id")
    assert sum(counts.values()) == 60000
    assert "skew=true" in plan
    assert max(counts.values()) < 0.15 * 60000


@pytest.mark.parametrize("ordered", [False, True])
def test_a_hot_device_spreads_over_tasks(spark, skew_handling, stored_dims, ordered):
    _, validity = stored_dims
    order = newest_first(["lo"]) if ordered else None
    if not ordered:
        validity = validity.filter("lo > 0").withColumn("lo", F.lit(0).cast("long"))
    valid = validity_join(busy_readings(spark, 3), validity, ("meter", "device"), "at", [("lo", "hi")], order=order)
    counts, plan = task_sizes(valid, "id")
    assert sum(counts.values()) == 60000
    assert "skew=true" in plan
    assert max(counts.values()) < 0.15 * 60000


def test_batch_joins_split_a_busy_meter(spark, skew_handling, tmp_path):
    """The joins as the batch job runs them: unit lookup, then validity with its order."""
    names = [c for c in config.VALIDITY_COLUMNS if c not in ("mfr_devc_ser_nbr", "co_cd_ownr")]
    bounds = {"mtr_inst_ts": "2020-01-01 00:00:00", "mtr_rmvl_ts": config.OPEN_END, "acct_turn_on_dt": "2020-01-01", "acct_turn_off_dt": config.OPEN_END}
    readings = busy_readings(spark, 3).withColumnsRenamed({"meter": "metername"}).withColumns(
        {"unix_endtime": F.lit(1_700_000_000) + F.col("id"), "channel": F.when(F.col("id") % 3 == 1, "1").otherwise(F.col("id") % 4000), "uom": F.lit("kwh"), "intervallength": F.lit("15")}
    )
    readings = readings.withColumn("channel", F.col("channel").cast("string"))
    dim = readings.select(F.col("metername").alias("mfr_devc_ser_nbr")).distinct()
    dim = dim.withColumns({"co_cd_ownr": F.lit("07"), **{n: F.lit(bounds.get(n, n)) for n in names}})
    dim.select(*config.VALIDITY_COLUMNS).write.parquet(f"{tmp_path}/validity")
    units_ = spark.range(4000).select(
        F.col("id").cast("string").alias("aep_channel_id"), F.lit("kwh").alias("aep_derived_uom"), F.lit("E").alias("name_register"),
        F.lit("TOT").alias("aep_srvc_qlty_idntfr"), F.lit("N").alias("value_mltplr_flg"),
    )
    units_.write.parquet(f"{tmp_path}/units")
    stored = views.prepare_validity_dim(spark.read.parquet(f"{tmp_path}/validity"), ("07",))
    enriched = views.enrich_units(readings, spark.read.parquet(f"{tmp_path}/units"))
    counts, plan = task_sizes(enriched, "id")
    assert "skew=true" in plan and max(counts.values()) < 0.15 * 60000
    counts, plan = task_sizes(views.enrich_premise(enriched, stored), "id")
    assert sum(counts.values()) == 60000
    assert plan.count("skew=true") >= 2 and max(counts.values()) < 0.15 * 60000


def test_many_overlapping_rows_of_one_device(spark):
    """Thousands of open-ended rows of a placeholder device stay far from all pairs."""
    n = 20_000
    rows_ = spark.range(n).select(
        F.lit("none").alias("device"), (F.col("id") * 10).alias("lo"), F.lit(10**12).alias("hi"), F.col("id").alias("row")
    )
    parts = disjoint_validity(rows_, "device", [("lo", "hi")], newest_first(["lo"]))
    got = rows(parts.agg(F.count("*"), F.sum(F.col("__to") - F.col("__from") + 1), F.count_if(F.col("__from") == F.col("row") * 10)))
    assert got == [(n, 10**12 + 1, n)]
    first = disjoint_validity(rows_, "device", [("lo", "hi")], [F.asc("lo")])
    assert rows(first.select("row", "__from", "__to")) == [(0, 0, 10**12)]


def test_settled_rows_equal_brute_force(spark):
    rng = random.Random(3)
    data = []
    for i in range(150):
        low = rng.randrange(40)
        data.append((f"d{rng.randrange(6)}", low, low + rng.randrange(-1, 25), rng.randrange(3), i % 140))
    dim = spark.createDataFrame(data, "device string, lo long, hi long, grade int, row int")
    parts = disjoint_validity(dim, "device", [("lo", "hi")], newest_first(["grade"])).collect()
    for device in {d[0] for d in data}:
        for at in range(70):
            valid = {d for d in data if d[0] == device and d[1] <= at <= d[2]}
            best = max(valid, key=lambda d: (d[3], *[d[i] for i in range(5)]), default=None)
            hit = [p for p in parts if p.device == device and p["__from"] <= at <= p["__to"]]
            assert [tuple(p)[:5] for p in hit] == ([best] if best else [])


def test_the_dimension_is_not_copied(spark):
    rows_ = spark.range(1000).select(
        F.col("id").cast("string").alias("device"), F.lit(0).cast("long").alias("lo"), F.lit(10**11).alias("hi")
    )
    parts = disjoint_validity(rows_, "device", [("lo", "hi")], newest_first(["lo"]))
    assert parts.count() == 1000


def test_overlapping_validity_rows_are_settled_by_their_columns(spark):
    data = [("d", "A", 0, 100, 0, 100), ("d", "B", 50, 200, 50, 200), ("d", "C", 50, 80, 50, 80), ("d", "B", 50, 200, 50, 200)]
    fact = spark.createDataFrame([("d", t) for t in (0, 49, 50, 80, 81, 100, 101, 200, 201)], "meter string, at long")
    found = []
    for order in (data, data[::-1]):
        dim = spark.createDataFrame(order, DIM)
        joined = validity_join(fact, dim, ("meter", "device"), "at", INTERVALS, order=newest_first(["lo1"]))
        found.append(rows(joined.select("at", "premise")))
    assert found[0] == found[1] == sorted(
        [(0, "A"), (49, "A"), (50, "C"), (80, "C"), (81, "B"), (100, "B"), (101, "B"), (200, "B"), (201, None)], key=str
    )


def test_hot_null_keys_bypass_the_merge_join(spark, fixed_partitions):
    rows_ = spark.range(0, 60000, 1, 16).select(
        F.when(F.col("id") % 3 != 0, F.col("id")).alias("id"), F.col("id").alias("v")
    )
    merged = merge_upsert(rows_, rows_, ["id"], ["v"])
    assert largest_share(merged) < 0.15
    assert merged.count() == 80000


def test_validity_join_without_any_epoch(spark):
    fact = spark.createDataFrame([("d", None)], "meter string, at long")
    dim = spark.createDataFrame([("d", "A", 0, 9, 0, 9)], DIM)
    joined = validity_join(fact, dim, ("meter", "device"), "at", INTERVALS, strategy="merge")
    assert [r.premise for r in joined.collect()] == [None]


def test_diagnose_and_check(spark):
    dim = spark.createDataFrame([("d", "A", 0, 100, 50, 100), ("e", "B", 0, None, 0, 9)], DIM)
    fact = spark.createDataFrame([("d", 40), ("z", 40)], "meter string, at long")
    flags = {"in_meter": ("lo1", "hi1"), "in_account": ("lo2", "hi2")}
    found = validity_diagnose(fact, dim, ("meter", "device"), "at", flags, ["d", "z"])
    assert rows(found.select("meter", *flags)) == [("d", "YES", "NO")]
    assert rows(found.select("at_text", "hi1_text")) == [("1970-01-01 00:00:40", "1970-01-01 00:01:40")]
    none = validity_diagnose(fact, dim, ("meter", "device"), "at", flags, ["z"])
    assert none.count() == 0
    checked = validity_check(dim, F.lit(50), flags)
    assert rows(checked.select("device", *flags)) == [("d", "PASS", "PASS"), ("e", "FAIL", "FAIL")]


def validity_row(**values):
    base = dict.fromkeys(config.VALIDITY_COLUMNS)
    base |= {
        "co_cd_ownr": "07",
        "mfr_devc_ser_nbr": "900000010",
        "mtr_inst_ts": "2020-01-01 00:00:00",
        "mtr_rmvl_ts": "9999-01-01",
        "acct_turn_on_dt": "2020-01-01",
        "acct_turn_off_dt": "9999-01-01",
    }
    return tuple((base | values)[c] for c in config.VALIDITY_COLUMNS)


def test_prepare_validity_dim(spark, any_zone):
    schema = ", ".join(f"{c} string" for c in config.VALIDITY_COLUMNS)
    dim = spark.createDataFrame(
        [
            validity_row(prem_nb="a", tx_mand_data="T", serv_deliv_id="S"),
            validity_row(prem_nb="b", mtr_rmvl_ts="2025-07-01 00:00:00.000"),
            validity_row(prem_nb="c", mtr_rmvl_ts="2025-07-01"),
            validity_row(prem_nb="other company", co_cd_ownr="99"),
        ],
        schema,
    )
    got = {r.prem_nb: r for r in views.prepare_validity_dim(dim, ("07", "10")).collect()}
    assert sorted(got) == ["a", "b", "c"]
    assert got["a"].sd == "TS" and got["b"].sd == "" and got["a"].cmsg_mtr_mult_nb is None
    assert got["a"].unix_mtr_inst_ts == int(datetime(2020, 1, 1, 5, tzinfo=timezone.utc).timestamp())
    assert got["b"].unix_mtr_rmvl_ts == int(datetime(2025, 7, 1, 4, tzinfo=timezone.utc).timestamp())
    # only the open-end marker may leave out the time of day
    assert got["c"].unix_mtr_rmvl_ts is None
    assert got["a"].unix_mtr_rmvl_ts == got["a"].unix_acct_turn_off_dt


# --- dedup -------------------------------------------------------------------


def test_dedup_settles_ties(spark):
    df = spark.createDataFrame(
        [("k", 1, 5, "a"), ("k", 1, 7, "b"), ("k", 0, 9, "c"), (None, 1, 1, "d"), (None, 1, 2, "e")],
        "key string, stamp int, seq int, v string",
    )
    for parts in (1, 5):
        kept = dedup_latest(df.repartition(parts), ["key"], newest_first(["stamp", "seq"]))
        assert rows(kept.select("key", "v")) == [("k", "b"), (None, "e")]
    assert rows(duplicate_counts(df, ["key"], 3)) == [("k", 3)]
    assert rows(dedup_removed(df, ["key"])) == [(5, 2, 3)]
    assert rows(dedup_removed(df.limit(0), ["key"])) == [(0, 0, 0)]


def test_dedup_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("key"), "id")
    plan = dedup_latest(df, ["key"], [F.desc("id")])._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in below and "Partial" in below


# --- merge -------------------------------------------------------------------

TABLE = "day string, id int, value double, made string, by string"


def merge(spark, target, source):
    return merge_upsert(
        spark.createDataFrame(target, TABLE),
        spark.createDataFrame(source, TABLE),
        ["day", "id"],
        ["value", "by"],
        on_update={"by": F.lit("update")},
        on_insert={"by": F.lit("insert")},
        action=True,
    )


def test_merge_updates_inserts_and_keeps(spark):
    target = [("d", 1, 1.0, "old", "x"), ("d", 2, 2.0, "old", "x"), ("d", None, 3.0, "old", "x")]
    source = [("d", 1, None, "new", "y"), ("d", 4, 4.0, "new", "y"), ("d", None, 5.0, "new", "y")]
    assert rows(merge(spark, target, source)) == sorted(
        [
            ("d", 1, None, "old", "update", "updated"),  # NULL source values overwrite
            ("d", 2, 2.0, "old", "x", "kept"),
            ("d", 4, 4.0, "new", "insert", "inserted"),
            ("d", None, 3.0, "old", "x", "kept"),  # NULL keys never match
            ("d", None, 5.0, "new", "insert", "inserted"),
        ],
        key=str,
    )


def test_merge_is_idempotent(spark):
    source = [("d", 1, 1.5, "new", "y"), ("d", 4, 4.0, "new", "y")]
    once = merge(spark, [("d", 1, 1.0, "old", "x")], source).drop(ACTION)
    twice = merge(spark, [tuple(r) for r in once.collect()], source)
    assert rows(twice.drop(ACTION, "by")) == rows(once.drop("by"))
    assert {r[ACTION] for r in twice.collect()} == {"updated"}


def test_merge_rejects_repeated_source_keys(spark):
    with pytest.raises(Exception, match="merge source: more than one row for key d,1"):
        merge(spark, [], [("d", 1, 1.0, "a", "b"), ("d", 1, 2.0, "a", "b")]).collect()


def test_unique_check_reuses_the_join_shuffle(spark):
    left = spark.range(100).withColumnRenamed("id", "a")
    right = assert_unique(spark.range(100), ["id"], "right")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = left.join(right, F.col("a") == F.col("id"), "full_outer")
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2


def test_retention_compares_run_dates_as_text(spark):
    run_ts = datetime(2026, 1, 20, 12, 0, 0, tzinfo=timezone.utc)
    cutoff = retention_cutoff(run_ts)
    assert cutoff == "20260112_120000"
    data = [
        ("oh", "20260112_115959", "expired"),
        ("oh", cutoff, "at the cutoff"),
        ("oh", "20260119_000000", "recent"),
        ("ap", "20250101_000000", "other tenant"),
        ("oh", None, "no run date"),
        (None, "20250101_000000", "no tenant"),
    ]
    df = spark.createDataFrame(data, "aep_opco string, run_date string, what string")
    assert {r.what for r in retain_recent(df, "oh", run_ts).collect()} == {d[2] for d in data[1:]}


# --- reports -----------------------------------------------------------------


def test_quality_report(spark):
    df = spark.createDataFrame(
        [
            ("d1", "m1", "1", "p", "KWH", 1.0, 1.0, "c", "07"),
            ("d1", "m1", "2", None, "UNK", None, None, None, None),
            ("d2", "m2", "1", "p", "KWH", 1.0, None, "c", "07"),
        ],
        "aep_usage_dt string, serialnumber string, aep_channel_id string, aep_premise_nb string, "
        "aep_derived_uom string, value double, scalarfloat double, aep_city string, authority string",
    )
    assert [tuple(r) for r in quality.quality_report(df).collect()] == [
        ("d1", 2, 1, 2, 1, 1, 1, 1, 1, 1, 1),
        ("d2", 1, 1, 1, 0, 1, 0, 0, 1, 0, 0),
    ]


def test_stamps_are_half_open(spark):
    df = spark.createDataFrame(
        [(1, datetime(2026, 1, 1), None), (2, None, datetime(2026, 1, 2)), (3, None, None)],
        "id int, hdp_insert_dttm timestamp_ntz, hdp_update_dttm timestamp_ntz",
    )
    stamps = config.AUDIT_COLUMNS
    day = quality.any_stamp_in(stamps, datetime(2026, 1, 1), datetime(2026, 1, 2))
    assert [r.id for r in df.filter(day).collect()] == [1]
    since = quality.any_stamp_in(stamps, datetime(2026, 1, 2))
    assert [r.id for r in df.filter(since).collect()] == [2]


def test_top_groups_break_ties_by_key(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "k string")
    assert [tuple(r) for r in quality.top_groups(df, "k", 2).collect()] == [("c", 2), ("a", 1)]


# --- reconcile ---------------------------------------------------------------


def test_reconcile(spark):
    schema = "id int, a int, b string, hdp_insert_dttm string"
    left = spark.createDataFrame([(1, 1, None, "x"), (2, 2, "b", "x"), (None, 9, "n", "x")], schema)
    right = spark.createDataFrame([(1, 1, None, "y"), (2, 3, "b", "y"), (4, 4, "d", "y")], schema)
    got = rows(reconcile(left, right, ["id"]))
    assert got == sorted(
        [
            (1, "a", "1", "1", "OK"),
            (1, "b", None, None, "OK"),
            (2, "a", "2", "3", "DIFF"),
            (2, "b", "b", "b", "OK"),
            (4, "a", None, "4", "NO left"),
            (4, "b", None, "d", "NO left"),
            (None, "a", "9", None, "NO right"),
            (None, "b", "n", None, "NO right"),
        ],
        key=str,
    )
    only = reconcile(left, right, ["id"], only_differences=True)
    assert rows(only) == [r for r in got if r[-1] != "OK"]
    with pytest.raises(Exception, match="left: more than one row"):
        reconcile(left.union(left), right, ["id"]).collect()


def test_reconcile_three_ways(spark):
    schema = "id int, a string"
    dev = spark.createDataFrame([(1, "x"), (2, "x"), (3, "x"), (4, "x")], schema)
    staged = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], schema)
    consumed = spark.createDataFrame([(1, "x"), (2, "z")], schema)
    got = reconcile_against(dev, {"staged": staged, "consumed": consumed}, ["id"])
    assert {r.id: r.status for r in got.collect()} == {1: "OK", 2: "DIFF", 3: "DIFF", 4: "NO DATA"}
