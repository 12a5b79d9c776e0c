"""Scans of stored tables and extracts."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally import config


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_parquet(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Parquet data, with an explicit schema where partition types must not be guessed."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored table, or no rows if nothing was written there yet."""
    try:
        return read_parquet(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_extract(
    spark: SparkSession, path: str, schema: str = config.EXTRACT_SCHEMA
) -> DataFrame:
    """A CSV extract with a header row; empty fields are NULL."""
    return spark.read.option("header", True).schema(schema).csv(path)


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """All rows of several frames, matched by column name."""
    return reduce(DataFrame.unionByName, frames)


def unit_map(table: DataFrame, tenant: str) -> DataFrame:
    """The unit mapping of one tenant, without repeats."""
    return (
        table.filter(F.col("aep_opco") == tenant).select(*config.UNIT_MAP_COLUMNS).distinct()
    )
