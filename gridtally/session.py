"""Session settings and the shared folder for intermediate data."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name: str = "gridtally", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for name, value in {**SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, from ``spark.checkpoint.dir``.

    Only a local session may run without the setting; it then gets a fresh
    temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="gridtally-")
        context.setCheckpointDir(folder)
    elif folder.startswith("file:") and not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is local to each machine; name a shared folder")
    return folder.rstrip("/")


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


_scopes: list[list[str]] = []


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one intermediate table."""
    path = f"{shared_folder(spark)}/gridtally/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def work_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, the intermediate tables that begin in it.

    Results that read such tables must be written, to a path made before, within the scope.
    """
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield
    finally:
        _scopes.pop()
        for path in paths:
            drop_path(spark, path)
