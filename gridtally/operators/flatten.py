"""Nested documents to one row per reading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally import config
from gridtally.functions import times, values
from gridtally.operators.keys import all_present


def _fields(element: str, layout: dict[str, str]) -> list[Column]:
    """The fields of a struct column under their flat names."""
    return [F.col(f"{element}.{field}").alias(name) for field, name in layout.items()]


def name_documents(docs: DataFrame, part_date: str | None = None) -> DataFrame:
    """Plain column names, plus the batch label when one is given."""
    named = docs.withColumnsRenamed(config.DOCUMENT_FIELDS)
    return named if part_date is None else named.withColumn("part_date", F.lit(part_date))


def explode_intervals(named: DataFrame, earliest: str = config.EARLIEST_BLOCK_DATE) -> DataFrame:
    """One row per interval of every block that starts on or after ``earliest``."""
    head = [c for c in named.columns if c != "interval_reading"]
    blocks = (
        named.select(*head, F.explode("interval_reading").alias("block"))
        .filter(times.wall_date(F.col("block._StartTime")) >= F.lit(earliest).cast("date"))
        .select(*head, *_fields("block", config.BLOCK_FIELDS), F.col("block.Interval").alias("intervals"))
    )
    kept = [c for c in blocks.columns if c != "intervals"]
    exploded = blocks.select(*kept, F.explode("intervals").alias("ivl"))
    return exploded.select(*kept, *_fields("ivl", config.INTERVAL_FIELDS))


def derive_interval_times(
    df: DataFrame, end_col: str = "int_endtime", minutes_col: str = "intervallength"
) -> DataFrame:
    """Adds ``starttime``, ``endtime``, ``interval_epoch`` and ``unix_endtime``.

    ``interval_epoch`` is the UTC offset sent with the interval end. The start
    is the end minus the interval length, written with that same offset, so a
    clock change inside the interval does not shift it.
    """
    end = F.col("__end")
    sent = F.replace(F.substring(end_col, 1, 19), F.lit(" "), F.lit("T"))
    start = times.minutes_before(end, values.as_int(F.col(minutes_col)))
    return (
        df.withColumns(
            {
                "__end": times.wall_time(F.col(end_col)),
                "interval_epoch": times.offset(F.col(end_col)),
            }
        )
        .withColumns(
            {
                "starttime": F.concat(times.iso_wall(start), F.col("interval_epoch")),
                "endtime": F.when(
                    end.isNotNull(), F.concat(sent, F.col("interval_epoch"))
                ),
                "unix_endtime": times.epoch(end, F.col("interval_epoch")),
            }
        )
        .drop("__end")
    )


def explode_readings(intervals: DataFrame) -> DataFrame:
    """One row per channel reading that has channel, raw value, value and unit."""
    head = [c for c in intervals.columns if c not in ("int_reading", "int_endtime")]
    timed = derive_interval_times(intervals).drop("int_endtime")
    added = ["starttime", "endtime", "interval_epoch", "unix_endtime"]
    return (
        timed.select(*head, *added, F.explode("int_reading").alias("reading"))
        .select(*head, *added, *_fields("reading", config.READING_FIELDS))
        .filter(all_present(list(config.READING_FIELDS.values())))
    )


def flatten_readings(docs: DataFrame, part_date: str | None = None) -> DataFrame:
    """Documents to readings: three explodes, the date floor and the NOT NULL filter."""
    return explode_readings(explode_intervals(name_documents(docs, part_date)))
