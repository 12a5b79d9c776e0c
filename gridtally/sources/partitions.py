"""Answers about partition columns from the names of folders; no data file is opened.

The driver lists the levels of the partition columns, one folder for each partition
above them. Folders without a data file do not count.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally.sinks.folders import Folder
from gridtally.sinks.tables import NULL_PARTITION, partition_folder
from gridtally.sources.files import escaped


def _value(folder: str) -> str | None:
    text = folder.partition("=")[2]
    return None if text == NULL_PARTITION else re.sub(r"%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), text)


def _holds_data(folder: Folder, name: str) -> bool:
    for entry in folder.names(name):
        if "=" in entry:
            if _holds_data(folder, f"{name}/{entry}"):
                return True
        elif not entry.startswith(("_", ".")):
            return True
    return False


def stored_partitions(
    spark: SparkSession, path: str, columns: list[str], where: dict[str, object] | None = None
) -> list[tuple]:
    """The values of the first partition levels that hold data, as text, sorted; NULLs come first.

    ``where`` fixes values of levels: only their folders are listed.
    """
    where = where or {}
    folder = Folder(spark, path)
    found: list[tuple[str, tuple]] = [("", ())]
    for column in columns:
        after = []
        for name, values in found:
            if column in where:
                inner = [partition_folder(column, where[column])]
                inner = [n for n in inner if folder.has(f"{name}/{n}".lstrip("/"))]
            else:
                inner = [n for n in folder.names(name) if n.startswith(f"{column}=")]
            after += [(f"{name}/{n}".lstrip("/"), (*values, _value(n))) for n in inner]
        found = after
    held = [values for name, values in found if _holds_data(folder, name)]
    return sorted(held, key=lambda values: [(v is not None, v or "") for v in values])


def stored_extent(
    spark: SparkSession, path: str, columns: list[str], where: dict[str, object] | None = None
) -> tuple[str | None, str | None]:
    """The least and greatest value of the last of ``columns``; NULLs do not count."""
    values = [p[-1] for p in stored_partitions(spark, path, columns, where) if p[-1] is not None]
    return (min(values), max(values)) if values else (None, None)


def read_latest(
    spark: SparkSession, path: str, schema, columns: list[str], where: dict[str, object] | None = None
) -> DataFrame:
    """The rows of the latest value of the last of ``columns``, such as the last run of a tenant.

    Only the folders of that value are read, and none to find it. Values compare as text.
    """
    places = stored_partitions(spark, path, columns, where)
    _, latest = stored_extent(spark, path, columns, where)
    empty = spark.createDataFrame([], schema)
    if latest is None:
        return empty
    chosen = [p for p in places if p[-1] == latest]
    names = ["/".join(partition_folder(c, v) for c, v in zip(columns, p)) for p in chosen]
    reader = spark.read.schema(schema).option("basePath", path)
    rows = reader.parquet(*[escaped(f"{path.rstrip('/')}/{n}") for n in names]).select(*empty.columns)
    fixed = [F.col(c) == F.lit(v) for c, v in (where or {}).items()]
    return reduce(DataFrame.filter, fixed, rows)
