"""What the operators share: table access, folds, code shipping, bounded slices, staging."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally.session import work_path, work_scope
from gridtally.sinks.staging import stage

PACKAGE = Path(__file__).resolve().parent.parent
#: Rows that Python code of a task holds decoded at a time.
SLICE_ROWS = 256
_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        folder = tempfile.mkdtemp(prefix="gridtally-code-")
        archive = shutil.make_archive(
            f"{folder}/gridtally", "zip", root_dir=PACKAGE.parent, base_dir=PACKAGE.name
        )
        context.addPyFile(archive)
        _shipped.add(context.applicationId)


def fold(id_col: str, modulus: int) -> Column:
    """The remainder of the CRC-32 of the id as text; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus


def sampled_labels(
    labels: DataFrame, id_col: str, label_col: str, size: int, use: Column | None = None
) -> tuple[DataFrame, dict[int, int]]:
    """((train_id, label) of about ``size`` labelled rows of each class, all rows by class).

    Classes are 0 and 1. A row is chosen by the hash of its id, so no row is sorted or
    sent anywhere to choose: a class of more than ``size`` rows gives that number on
    average, with a standard deviation of its square root at most. Repeated rows count
    once.
    """
    known = labels.filter(F.col(id_col).isNotNull() & (F.lit(True) if use is None else use)).select(
        F.col(id_col).alias("train_id"), F.col(label_col).cast("int").alias("label")
    )
    known = known.filter(F.col("label").isin(0, 1)).distinct()
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    place = F.pmod(F.xxhash64("train_id"), F.lit(1 << 40))
    chosen = F.lit(False)
    for label, n in counts.items():
        chosen = chosen | ((F.col("label") == label) & (place < int((1 << 40) * min(1.0, size / n))))
    return known.filter(chosen), counts


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in slices of few rows, so that little is decoded at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: later steps survive lost executors."""
    return stage(df, work_path(df.sparkSession, name))


def settled(spark: SparkSession, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` gives, written; the tables that were written on the way are deleted."""
    path = work_path(spark, name)
    with work_scope(spark):
        return stage(make(), path)
