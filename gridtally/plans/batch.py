"""The batch job: select, scan, flatten, enrich, deduplicate, upsert, publish."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally import config
from gridtally.config import Tenant
from gridtally.functions import times
from gridtally.operators.flatten import flatten_readings
from gridtally.plans import views
from gridtally.session import drop_path, work_path
from gridtally.sinks.staging import Watched, batch_metrics, stage_counted, write_partitions
from gridtally.sinks.tables import publish_incremental, write_merge
from gridtally.sources.documents import file_count, read_documents
from gridtally.sources.files import marked_directories, refuse_hidden
from gridtally.sources.tables import unit_map


@dataclass(frozen=True)
class BatchResult:
    """What one batch did; ``empty`` means that no document was delivered and
    nothing was written. ``files`` counts the selected files, empty ones too.

    ``rejected`` counts readings whose end time has no usable offset: they have no
    instant, so they are not stored but written to the rejected path.
    """

    empty: bool
    files: int = 0
    documents: dict[str, int] = field(default_factory=dict)
    readings: dict[str, int] = field(default_factory=dict)
    rejected: int = 0
    usage_dates: list = field(default_factory=list)
    expired_runs: list[str] = field(default_factory=list)


def transform(
    documents: DataFrame,
    units: DataFrame,
    validity: DataFrame,
    tenant: Tenant,
    run_ts: datetime,
    label: str,
) -> DataFrame:
    """Raw documents to one output row per business key."""
    return transform_readings(flatten_readings(documents, label), units, validity, tenant, run_ts)


def transform_readings(
    flat: DataFrame, units: DataFrame, validity: DataFrame, tenant: Tenant, run_ts: datetime
) -> DataFrame:
    """Flat readings to one output row per business key; readings without an instant are left out."""
    dim = views.prepare_validity_dim(validity, tenant.company_codes, tenant.dimension_zone)
    readings = views.dedup_readings(flat.filter(F.col("unix_endtime").isNotNull()))
    return views.readings_view(readings, unit_map(units, tenant.code), dim, tenant, run_ts)


def run_batch(
    spark: SparkSession,
    base: str,
    tenant: Tenant,
    batch_start: str,
    batch_end: str,
    run_ts: datetime,
    units: DataFrame,
    validity: DataFrame,
    consume_path: str,
    incremental_path: str,
    rejected_path: str | None = None,
    days: int = config.RETENTION_DAYS,
    keep_work: bool = False,
    tenants_apart: bool = False,
    wait: float = 0.0,
) -> BatchResult:
    """Process the directories whose marker landed in [batch_start, batch_end).

    The window is wall-clock text in the tenant's dimension zone. ``run_ts``
    (with a time zone) stamps every row and names the run. Raw documents and
    deduplicated rows are written once to the shared folder, where the upsert
    and the incremental publish both read the latter, and are deleted at the
    end, also of a batch that fails, unless ``keep_work`` is set. Readings without
    an instant are counted and, if ``rejected_path`` is given, stored there by run.
    Rows are counted while they are written; documents are flattened a second time only
    if there are readings to reject.

    One batch at a time writes the consume table; another one waits up to ``wait`` seconds
    for it and then fails. With ``tenants_apart`` the table has a folder per usage date
    and tenant, and batches of different tenants write at once; keys are then matched
    within the tenant.
    """
    zone = tenant.dimension_zone
    directories = marked_directories(
        spark, base, times.batch_bound(batch_start, zone), times.batch_bound(batch_end, zone)
    )
    if not directories:
        return BatchResult(empty=True)
    refuse_hidden(spark, directories)
    scanned = read_documents(spark, directories)
    files = file_count(scanned)
    if not files:
        return BatchResult(empty=True)

    work = [work_path(spark, name) for name in ("documents", "rejected", "readings")]
    try:
        documents, n_documents = stage_counted(scanned, work[0])
        if not n_documents:
            return BatchResult(empty=True, files=files)
        label = times.batch_label(datetime.fromisoformat(batch_end))
        lost = F.col("unix_endtime").isNull()
        flat = Watched(flatten_readings(documents, label), lost)
        output, n_readings = stage_counted(
            transform_readings(flat.df, units, validity, tenant, run_ts), work[2]
        )
        n_rejected = 0
        if flat.any():
            stamp = F.lit(times.run_date(run_ts))
            rejects = flatten_readings(documents, label).filter(lost).withColumn("run_date", stamp)
            rejected, n_rejected = stage_counted(rejects, work[1])
            if rejected_path is not None:
                write_partitions(rejected, rejected_path, ["run_date"])
        usage_dates = write_merge(
            views.consume_rows(output),
            consume_path,
            on_update={"hdp_update_user": F.lit(config.UPDATE_USER)},
            on_insert={"hdp_update_user": F.lit(config.INSERT_USER)},
            partition_by=config.TENANT_PARTITIONS if tenants_apart else config.CONSUME_PARTITIONS,
            scope=tenant.code if tenants_apart else None,
            wait=wait,
        )
        expired = publish_incremental(
            views.incremental_rows(output, tenant, run_ts),
            incremental_path,
            tenant.code,
            run_ts,
            days,
        )
        return BatchResult(
            empty=False,
            files=files,
            documents=batch_metrics(documents, n_documents),
            readings=batch_metrics(output, n_readings),
            rejected=n_rejected,
            usage_dates=sorted(usage_dates, key=str),
            expired_runs=expired,
        )
    finally:
        if not keep_work:
            for path in work:
                drop_path(spark, path)
