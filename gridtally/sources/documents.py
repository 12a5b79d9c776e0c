"""Scans of nested XML documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridtally import config
from gridtally.sources.files import escaped
from gridtally.sources.listing import listed_by_tasks


def read_documents(
    spark: SparkSession,
    paths: list[str],
    row_tag: str = config.ROW_TAG,
    schema: str = config.RAW_SCHEMA,
    mode: str = "FAILFAST",
    ext: str = config.DATA_FILE_EXT,
) -> DataFrame:
    """One scan over all given files and directories, with a fixed schema.

    Directories are searched in depth for names that contain ``ext``. They are
    listed once, here, by tasks: ``file_count`` and every read of the frame see the same
    files. By default a malformed document fails the job.
    """
    options = {**config.XML_OPTIONS, "rowTag": row_tag, "mode": mode}
    with listed_by_tasks(spark):
        return (
            spark.read.format("xml")
            .options(**options)
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", f"*{ext}*")
            .schema(schema)
            .load([escaped(p) for p in paths])
        )


def file_count(docs: DataFrame) -> int:
    """How many files a scan reads; the names stay where they are."""
    return len(docs._jdf.inputFiles())
