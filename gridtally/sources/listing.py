"""Listings of directory trees made by tasks, hidden names included.

Spark's own listing leaves out hidden names, so data below one would be lost without a
word. Here each directory is listed by a task through the file system clients of Arrow
(local, HDFS, S3, GCS, Azure); the driver only names the directories.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import quote, urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

TREE = "dir string, path string, length bigint, modificationTime timestamp, hidden boolean"
#: Tasks of one listing, at most.
LISTING_TASKS = 1000
#: Rows that a task holds before it hands them on.
BATCH_ROWS = 10_000
#: Names of Hadoop's schemes that Arrow calls otherwise.
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}
THRESHOLD = "spark.sql.sources.parallelPartitionDiscovery.threshold"


def is_hidden(name: str) -> bool:
    """Whether Spark's scans skip files and folders of this name."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def is_checksum(name: str) -> bool:
    """Whether the file belongs to another one, as Hadoop's local file system writes them."""
    return name.startswith(".") and name.endswith(".crc")


def _open(directory: str) -> tuple[pafs.FileSystem, str, str]:
    """(file system, path in it, what comes before such paths in full ones)."""
    parts = urlsplit(directory, allow_fragments=False)
    if parts.scheme in ("", "file"):
        # file:/x and file:///x are the same; Spark's listings write the former
        path = directory.removeprefix("file:")
        return pafs.LocalFileSystem(), "/" + path.lstrip("/"), "file:"
    scheme = ARROW_SCHEMES.get(parts.scheme, parts.scheme)
    system, path = pafs.FileSystem.from_uri(f"{scheme}://{parts.netloc}{quote(parts.path)}")
    return system, path, directory[: len(directory) - len(path)]


def can_open(directory: str) -> bool:
    """Whether Arrow has a client for the directory's file system."""
    try:
        _open(directory)
    except (pa.ArrowException, OSError, ValueError):
        return False
    return True


def _files(directory: str) -> Iterator[tuple]:
    system, root, start = _open(directory)
    for entry in system.get_file_info(pafs.FileSelector(root, recursive=True)):
        if entry.type == pafs.FileType.File and not is_checksum(entry.base_name):
            below = entry.path[len(root) :].strip("/").split("/")
            yield directory, start + entry.path, entry.size, entry.mtime, any(map(is_hidden, below))


def list_tree(spark: SparkSession, directories: list[str]) -> DataFrame:
    """(dir, path, length, modificationTime, hidden) of all files below the directories, at any depth.

    A task lists whole directories. Checksum files of the local file system do not count.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.string(), pa.int64(), pa.timestamp("us", "UTC"), pa.bool_()]
        names = ["dir", "path", "length", "modificationTime", "hidden"]
        held: list[tuple] = []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)

        for given in batches:
            for directory in given.column(0).to_pylist():
                for row in _files(directory):
                    held.append(row)
                    if len(held) >= BATCH_ROWS:
                        yield batch()
                        held = []
        if held:
            yield batch()

    todo = spark.createDataFrame([(d,) for d in directories], "directory string")
    tasks = max(1, min(len(directories), LISTING_TASKS))
    return todo.repartition(tasks).mapInArrow(run, TREE)


@contextmanager
def listed_by_tasks(spark: SparkSession) -> Iterator[None]:
    """Lets Spark list more than one directory of a scan by tasks, however few there are."""
    before = spark.conf.get(THRESHOLD, None)
    spark.conf.set(THRESHOLD, "1")
    try:
        yield
    finally:
        spark.conf.unset(THRESHOLD) if before is None else spark.conf.set(THRESHOLD, before)
