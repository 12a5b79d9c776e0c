"""Writes to the stored tables: append, upsert, retention and incremental publish.

Partitioned Parquet paths are the portable form. The ``*_table`` variants use
the row-level commands of a catalog table that supports them.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally import config
from gridtally.functions import times
from gridtally.operators.merge import merge_upsert, retention_cutoff
from gridtally.sinks.folders import Folder, Lease, leased, scope_name
from gridtally.sinks.staging import by_partition, write_partitions
from gridtally.sources.files import escaped

_SWAP = "_swap-"
_BATCH = "_batch-"
#: Partitions that the driver swaps in at a time.
SWAP_THREADS = 8
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def append(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Add rows to a partitioned path, columns matched by name."""
    by_partition(df, partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)


def append_table(df: DataFrame, table: str) -> None:
    """Add rows to a catalog table, columns matched by name."""
    df.writeTo(table).append()


def partition_values(df: DataFrame, column: str) -> list:
    """The distinct values of a partition column."""
    return [r[0] for r in df.select(column).distinct().collect()]


def partition_folder(column: str, value: object) -> str:
    """The name of a partition's folder."""
    if value is None or value == "":
        return f"{column}={NULL_PARTITION}"
    hostile = set('"#%\'*/:=?\\\x7f{[]^') | {chr(c) for c in range(1, 32)}
    return f"{column}=" + "".join(f"%{ord(c):02X}" if c in hostile else c for c in str(value))


def _leaves(folder: Folder, name: str) -> list[str]:
    """The innermost partition folders below a folder, relative to it."""
    inner = [n for n in folder.names(name) if "=" in n]
    return [f"{n}/{leaf}" if leaf else n for n in inner for leaf in _leaves(folder, f"{name}/{n}")] or [""]


def _swap_in(folder: Folder, scope: str, lease: Lease) -> None:
    """Put what complete swaps hold into its place, and drop the others.

    Only the holder of the lease comes here, so a swap without its mark of success
    belongs to a writer that is gone. Every step can be repeated.
    """
    prefix = f"{_SWAP}{scope_name(scope)}-"
    for swap in sorted(n for n in folder.names() if n.startswith(prefix)):
        if "_SUCCESS" in folder.names(swap):

            def replace(leaf: str) -> None:
                lease.check()
                folder.delete(leaf)
                folder.move(f"{swap}/{leaf}", leaf)

            leaves = [leaf for leaf in _leaves(folder, swap) if leaf]
            with ThreadPoolExecutor(SWAP_THREADS) as pool:
                list(pool.map(replace, leaves))
            lease.check()
            stream, _, number = swap.removeprefix(prefix).partition("-")[2].rpartition("-")
            if stream:
                folder.write(f"{_BATCH}{stream}", number)
        lease.check()
        folder.delete(swap)


def last_batch(folder: Folder, stream: str) -> int:
    """The number of the stream's last batch in the table; -1 if there is none."""
    name = f"{_BATCH}{scope_name(stream)}"
    return int(folder.read(name)) if folder.has(name) else -1


def finish_swaps(spark: SparkSession, path: str, scope: str = "", wait: float = 0.0) -> None:
    """Put complete partitions that an interrupted upsert left aside into their place.

    A set of new partitions counts as complete once its write has succeeded. Fails while
    another writer holds the table.
    """
    with leased(spark, path, scope, wait) as lease:
        _swap_in(lease.folder, scope, lease)


def read_partitions(
    spark: SparkSession, path: str, schema: str, columns: list[str], values: list[tuple]
) -> DataFrame:
    """The rows of the given partitions, each named by its values; no other folder is listed."""
    folder = Folder(spark, path)
    names = ["/".join(partition_folder(c, v) for c, v in zip(columns, place)) for place in values]
    there = [n for n in dict.fromkeys(names) if folder.has(n)]
    if not there:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", path)
    stored = reader.parquet(*[escaped(f"{path.rstrip('/')}/{n}") for n in there])
    return stored.select(*spark.createDataFrame([], schema).columns)


def write_merge(
    source: DataFrame,
    path: str,
    schema: str = config.CONSUME_SCHEMA,
    keys: list[str] = config.BUSINESS_KEY,
    update_cols: list[str] = config.UPDATE_COLUMNS,
    partition_by: list[str] = config.CONSUME_PARTITIONS,
    on_update: dict[str, Column] | None = None,
    on_insert: dict[str, Column] | None = None,
    scope: str | None = None,
    wait: float = 0.0,
    batch: tuple[str, int] | None = None,
) -> list:
    """Upsert ``source`` into a partitioned path and return the touched values of its first level.

    Only the folders of partitions that occur in the source are listed, read and
    replaced. The new partitions are written aside first and then swapped in; a run that
    was interrupted in between is finished by the next one. Pass a staged source: it is
    read more than once.

    One writer at a time: a second one waits up to ``wait`` seconds and then fails with
    ``TableBusy``; one that was taken for dead fails with ``LeaseLost`` before it replaces
    anything. With ``scope`` the lease is that of one value of the last partition level,
    such as a tenant: writers of different scopes do not meet, and a source with rows
    of another scope is refused. Keys are then matched within the scope.

    ``batch`` is the name of a stream and the number of its batch. A batch that the table
    holds already changes nothing; its number is stored with the swap it came in.
    """
    spark = source.sparkSession
    lease_of = "" if scope is None else scope
    with leased(spark, path, lease_of, wait) as lease:
        _swap_in(lease.folder, lease_of, lease)
        if batch is not None and batch[1] <= last_batch(lease.folder, batch[0]):
            return []
        places = [tuple(r) for r in source.select(*partition_by).distinct().collect()]
        if scope is not None:
            foreign = sorted({str(p[-1]) for p in places if p[-1] != scope})
            if foreign:
                raise ValueError(f"rows of {partition_by[-1]} {foreign[0]} in an upsert of {scope}")
        if places:
            target = read_partitions(spark, path, schema, partition_by, places)
            merged = merge_upsert(target, source, keys, update_cols, on_update, on_insert)
            swap = f"{path.rstrip('/')}/{_SWAP}{scope_name(lease_of)}-{uuid.uuid4().hex}"
            if batch is not None:
                swap += f"-{scope_name(batch[0])}-{batch[1]}"
            by_partition(merged, partition_by).write.partitionBy(*partition_by).parquet(swap)
            _swap_in(lease.folder, lease_of, lease)
    return list(dict.fromkeys(p[0] for p in places))


def merge_into_table(
    source: DataFrame,
    table: str,
    keys: list[str] = config.BUSINESS_KEY,
    update_cols: list[str] = config.UPDATE_COLUMNS,
    columns: list[str] = config.CONSUME_COLUMNS,
    partition_col: str = config.CONSUME_PARTITIONS[0],
    on_update: dict[str, Column] | None = None,
    on_insert: dict[str, Column] | None = None,
) -> None:
    """The same upsert through MERGE INTO, for catalog tables with row-level operations."""
    touched = [v for v in partition_values(source, partition_col) if v is not None]
    stored = table.split(".")[-1]  # columns are qualified by the table's own name
    same = [F.col(f"{stored}.{k}") == F.col(f"source.{k}") for k in keys]
    condition = reduce(
        lambda a, b: a & b, [F.col(f"{stored}.{partition_col}").isin(touched), *same]
    )
    updates = {c: F.col(f"source.{c}") for c in update_cols} | (on_update or {})
    inserts = {c: F.col(f"source.{c}") for c in columns} | (on_insert or {})
    (
        source.alias("source")
        .mergeInto(table, condition)
        .whenMatched()
        .update(updates)
        .whenNotMatched()
        .insert(inserts)
        .merge()
    )


def drop_expired_runs(
    spark: SparkSession,
    path: str,
    tenant: str,
    run_ts: datetime,
    days: int = config.RETENTION_DAYS,
) -> list[str]:
    """Delete a tenant's run partitions older than the retention; returns their run dates.

    Run date is a partition column, so retention removes whole directories and
    reads no data.
    """
    tenant_col, run_col = config.INCREMENTAL_PARTITIONS
    cutoff = retention_cutoff(run_ts, days)
    files = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = files.Path(f"{path}/{tenant_col}={tenant}")
    system = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    dropped = []
    if not system.exists(root):
        return dropped
    for entry in system.listStatus(root):
        column, _, value = entry.getPath().getName().partition("=")
        if column == run_col and value < cutoff:
            if not system.delete(entry.getPath(), True):
                raise OSError(f"could not delete {entry.getPath()}")
            dropped.append(value)
    return sorted(dropped)


def delete_expired_from_table(
    spark: SparkSession,
    table: str,
    tenant: str,
    run_ts: datetime,
    days: int = config.RETENTION_DAYS,
) -> None:
    """The retention DELETE, for catalog tables that support it; errors are passed on."""
    spark.sql(
        "DELETE FROM IDENTIFIER(:t) WHERE aep_opco = :tenant AND run_date < :cutoff",
        args={"t": table, "tenant": tenant, "cutoff": retention_cutoff(run_ts, days)},
    )


def publish_incremental(
    rows: DataFrame,
    path: str,
    tenant: str,
    run_ts: datetime,
    days: int = config.RETENTION_DAYS,
) -> list[str]:
    """Drop expired runs, then add this run's new rows under its run date.

    ``rows`` are incremental rows. They all go to the run's own partition, so
    they are written without a shuffle, and publishing the same run again
    replaces it.
    """
    dropped = drop_expired_runs(rows.sparkSession, path, tenant, run_ts, days)
    stamped = rows.filter(F.col("aep_opco") == tenant).withColumn(
        "run_date", F.lit(times.run_date(run_ts))
    )
    write_partitions(stamped, path, config.INCREMENTAL_PARTITIONS)
    return dropped
