"""What the reading queries send between tasks, on rows made here."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

import registered
import registered.reports
from gridtally.operators.dedup import dedup_latest, dedup_side_by_side, newest_first


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Some lineitem and supplier rows; every third reading comes again with other amounts."""
    folder = str(tmp_path_factory.mktemp("tables"))
    lineitem = [
        (k, k % 50, k % 5 + 1, k % 4, float(k % 40), 10.0 * (k % 9), 0.01 * (k % 7), 0.02 * (k % 3), "NRA"[k % 3], "OF"[k % 2],
         datetime(1998, 5 + k % 2, 1 + k % 9))
        for k in range(400)
    ]
    names = (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    )
    spark.createDataFrame(lineitem, names).write.parquet(f"{folder}/lineitem.parquet")
    supplier = [(k, k, 100.0 * k) for k in range(1, 6)]
    supplier = spark.createDataFrame(supplier, "s_suppkey long, s_nationkey int, s_acctbal double")
    supplier.write.parquet(f"{folder}/supplier.parquet")
    return folder


def ran(df):
    """The rows of a frame and the plan that gave them."""
    rows = df.collect()
    return sorted(map(repr, rows)), df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.mark.parametrize(
    "name",
    ["stage_view", "lookup_units", "output_view", "standard_view", "validity_join", "validity_join_slotted", "audit_stamps", "match_rate"],
)
def test_readings_are_not_sent_by_channel(spark, tables, name):
    rows, plan = ran(registered.QUERIES[name](spark, tables))
    assert rows
    assert "hashpartitioning(channel" not in plan


@pytest.mark.parametrize("name", ["dedup_readings", "batch_quality_report", "merged_quality_report", "device_detail"])
def test_readings_are_sent_by_interval(spark, tables, name, monkeypatch):
    plans = []
    stage = registered.reports.stage

    def watched(df, path):
        plans.append(ran(df)[1])
        return stage(df, path)

    monkeypatch.setattr(registered.reports, "stage", watched)
    rows, plan = ran(registered.QUERIES[name](spark, tables))
    plan = plans[0] if plans else plan
    assert rows
    assert "hashpartitioning(__place" in plan
    assert "EmptyRelation Join LeftSemi" in plan  # the way of crowded places, by all of the key, reads nothing


@pytest.mark.parametrize("name", ["validity_join", "output_view", "audit_stamps", "batch_quality_report", "merged_quality_report"])
def test_readings_are_not_sorted_by_device(spark, tables, name, monkeypatch):
    """They stream past the hashed parts of their devices, so that the join has nothing to spill."""
    plans = []
    stage = registered.reports.stage

    def watched(df, path):
        plans.append(ran(df)[1])
        return stage(df, path)

    monkeypatch.setattr(registered.reports, "stage", watched)
    rows, plan = ran(registered.QUERIES[name](spark, tables))
    plan = plans[0] if plans else plan
    joins = [line for line in plan.splitlines() if "Join" in line and "LeftOuter" in line and "__dim_key" in line]
    assert rows and joins
    assert all("ShuffledHashJoin" in line for line in joins)
    assert "Sort [metername" not in plan


def test_crowded_places_keep_the_same_rows(spark):
    df = spark.range(0, 4000, 1, 8).select(
        F.when(F.col("id") % 3 != 0, F.col("id") % 50).alias("meter"),
        F.when(F.col("id") % 4 == 0, -1).when(F.col("id") % 7 != 0, F.col("id") % 11).alias("moment"),
        F.when(F.col("id") % 13 != 0, F.col("id") % 3).alias("channel"),
        (F.col("id") * 7919 % 101).alias("value"),
    )
    keys, order = [F.col("moment"), F.col("meter"), F.col("channel")], newest_first(["value"])
    want, _ = ran(dedup_latest(df, keys, order).select(*df.columns))
    for crowd, split in ((10**6, False), (20, True), (0, True)):
        found, plan = ran(dedup_side_by_side(df, [F.col("moment"), F.col("meter")], keys, order, crowd).select(*df.columns))
        assert found == want
        assert ("EmptyRelation Join LeftSemi" not in plan) == split
    empty = dedup_side_by_side(df.limit(0), keys[:2], keys, order)
    assert empty.columns == df.columns and empty.count() == 0
