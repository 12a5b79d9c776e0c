"""Time the batch stages and the headline queries; print one JSON line.

The stages run on documents whose usage dates fill thirty daily partitions. A sixth
of the documents is also written as XML, for the scan and for the whole batch job.
The upsert brings a delivery of which 60 % of the rows are stored already. ``rates``
gives rows per second, ``rates_per_core`` the same divided by the cores. ``yardstick`` is
the time of one plain aggregate, which no round changes, and ``in_yardsticks`` all times in
units of it, so that rounds on machines of different speed can be compared.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from datetime import datetime, timedelta
from pathlib import Path
from zoneinfo import ZoneInfo

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from gridtally import config  # noqa: E402
from gridtally.operators import quality  # noqa: E402
from gridtally.operators.flatten import flatten_readings  # noqa: E402
from gridtally.plans import views  # noqa: E402
from gridtally.plans.batch import run_batch  # noqa: E402
from gridtally.session import build_session  # noqa: E402
from gridtally.sinks import tables  # noqa: E402
from gridtally.sinks.staging import stage  # noqa: E402
from gridtally.sources.documents import read_documents  # noqa: E402
from gridtally.sources.tables import read_parquet, unit_map  # noqa: E402
from registered import QUERIES, frames  # noqa: E402

HEADLINE = [
    "batch_select",
    "union_sources",
    "validity_check",
    "merge_upsert",
    "reconcile",
    "reconcile_three_way",
    "dedup_latest",
    "dedup_removed",
    "duplicate_probe",
    "event_quality_report",
    "unit_distribution",
    "distinct_meters",
    "latest_run",
    "top_meters",
    "retention",
    "interval_times",
    "scale_value",
    "validity_join_slotted",
    "validity_diagnose",
    "incremental_publish",
    "ordered_rows",
    "xml_scan",
]


def session(cpus: str, folder: str) -> SparkSession:
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.sql.shuffle.partitions": cpus,
            "spark.checkpoint.dir": folder,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def deliver(docs: DataFrame, folder: str) -> str:
    """A store with the documents as XML in one directory with its marker."""
    directory = f"{folder}/store/d1"
    out = docs.write.format("xml").option("rootTag", "Root").option("rowTag", "MeterData")
    out.save(directory)
    Path(directory, config.MARKER_FILE).touch()
    return f"{folder}/store"


def run_through(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    folder = tempfile.mkdtemp(prefix="bench-")
    spark = session(cpus, folder)
    seconds: dict[str, float] = {}
    rows: dict[str, int] = {}

    def timed(name: str, action, repeat: int = 2):
        """The best of several runs; returns the last result."""
        best, result = None, None
        for _ in range(repeat):
            start = time.perf_counter()
            result = action()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
        return result

    run_through(spark.range(1000))
    # Core operations only, the same in every round: how fast the machine is.
    measures = [F.sum(c).alias(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")]
    plain = frames.table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus", "l_suppkey").agg(*measures)
    timed("yardstick", lambda: run_through(plain), repeat=7)
    yardstick = seconds.pop("yardstick")
    # The test table has a single row group, which one task would read alone.
    day = F.pmod(F.date_diff(F.col("l_shipdate").cast("date"), F.lit("1992-01-01").cast("date")), 30)
    month = F.timestamp_add("DAY", day.cast("int"), F.lit("1999-01-01").cast("timestamp_ntz"))
    lineitem = frames.table(spark, sf, "lineitem").withColumn("l_shipdate", month)
    source = frames.as_documents(lineitem.repartition(int(cpus)))
    documents = timed("stage_documents", lambda: stage(source, f"{folder}/documents"))
    rows["stage_documents"] = documents.count()
    tenant, run_ts = frames.TENANT, frames.RUN_TS
    units, validity = frames.units(spark), frames.validity(spark, sf)

    sixth = frames.as_documents(lineitem.filter(F.col("l_orderkey") % 6 == 0).repartition(int(cpus)))
    store = deliver(sixth, folder)
    scanned = timed(
        "scan_xml", lambda: stage(read_documents(spark, [f"{store}/d1"]), f"{folder}/scanned")
    )
    rows["scan_xml"] = rows["run_batch"] = scanned.count()
    now = datetime.now(ZoneInfo(tenant.dimension_zone))
    window = [(now + d).strftime("%Y-%m-%d %H:%M:%S") for d in (-timedelta(days=1), timedelta(days=1))]
    batches = iter(range(9))

    def batch():
        place = f"{folder}/batch{next(batches)}"
        return run_batch(
            spark, store, tenant, *window, run_ts, units, validity, f"{place}/consume", f"{place}/incremental"
        )

    timed("run_batch", batch)

    readings = flatten_readings(documents, frames.LABEL)
    timed("flatten_readings", lambda: run_through(readings))
    rows["flatten_readings"] = rows["dedup"] = readings.count()
    chosen = timed("dedup", lambda: stage(views.dedup_readings(readings), f"{folder}/chosen"))
    dim = frames.validity_dim(spark, sf)
    tenant_units = unit_map(units, tenant.code)

    def output(strategy: str | None) -> DataFrame:
        return views.readings_view(chosen, tenant_units, dim, tenant, run_ts, strategy)

    timed("enrich_shuffled", lambda: run_through(output("merge")))
    deduped = timed("enrich", lambda: stage(output(None), f"{folder}/output"))
    rows["enrich"] = rows["merge"] = rows["publish"] = rows["quality_report"] = deduped.count()

    upsert = stage(views.consume_rows(deduped), f"{folder}/upsert")
    schema = config.CONSUME_SCHEMA
    known = F.pmod(F.xxhash64("serialnumber", "endtimeperiod"), F.lit(10)) < 6
    stored_paths = []

    def merge():
        target = f"{folder}/consume{len(stored_paths)}"
        stored_paths.append(target)
        first = upsert.filter(known)
        tables.write_merge(first, target, schema=schema)
        start = time.perf_counter()
        tables.write_merge(upsert, target, schema=schema)
        return time.perf_counter() - start

    seconds["merge"] = round(min(merge(), merge()), 3)
    incremental = views.incremental_rows(deduped, tenant, run_ts)
    timed(
        "publish",
        lambda: tables.publish_incremental(incremental, f"{folder}/incremental", tenant.code, run_ts),
    )
    stored = read_parquet(spark, stored_paths[-1], schema)
    timed("quality_report", lambda: run_through(quality.quality_report(stored)))

    for name in HEADLINE:
        timed(name, lambda: run_through(QUERIES[name](spark, sf)), repeat=3)

    rates = {name: round(n / seconds[name]) for name, n in rows.items()}
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rates": rates,
                "rates_per_core": {name: round(n / int(cpus)) for name, n in rates.items()},
                "rows": rows,
                "yardstick": yardstick,
                "in_yardsticks": {name: round(s / yardstick, 2) for name, s in seconds.items()},
                "cpus": int(cpus),
                "sf": Path(sf).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
