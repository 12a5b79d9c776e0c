"""One row per business key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK, _HASH = "__rank", "__hash"
_PLACE, _CROWD, _ROWS = "__place", "__crowd", "__rows"

#: Places with more rows are reduced before they are shuffled.
CROWD = 10_000


def newest_first(columns: list[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


def dedup_latest(df: DataFrame, keys: list[str] | list[Column], order: list[Column]) -> DataFrame:
    """The first row of every key in the given order.

    The order must settle every tie, or a rerun may keep another row. Spark
    keeps one row per key and input partition before the shuffle, so a key with
    very many copies never reaches one task as a whole. Rows are sorted by a hash of
    the key first: eight bytes tell most keys apart, where texts such as dates are alike.
    """
    hashed = df.withColumn(_HASH, F.xxhash64(*keys))
    rank = F.row_number().over(Window.partitionBy(_HASH, *keys).orderBy(*order))
    return hashed.withColumn(_RANK, rank).filter(F.col(_RANK) == 1).drop(_RANK, _HASH)


def dedup_side_by_side(
    df: DataFrame, place: list[Column], keys: list[Column], order: list[Column], crowd: int = CROWD
) -> DataFrame:
    """``dedup_latest`` for rows that come side by side with others of the same ``place``.

    ``place`` is a part of the key, such as device and moment, by which alone rows are sent. So
    the channels of an interval, which have most columns in common, stay side by side, before the
    shuffle and behind it, and take little more than one row when they are compressed. Rows
    are sorted once, behind the shuffle, in parts that fit a task's memory.

    A place with more than ``crowd`` rows could be too much for one task. Rows are counted by
    place first, in a pass of its own that shuffles numbers only, and those of crowded places go
    through ``dedup_latest``. Both ways keep the same row.
    """
    placed = df.withColumn(_PLACE, F.xxhash64(*place))
    counts = placed.groupBy(_PLACE).agg(F.count("*").alias(_ROWS))
    # at most one in ``crowd`` rows
    crowded = F.broadcast(counts.filter(F.col(_ROWS) > crowd).select(F.col(_PLACE).alias(_CROWD)))
    here = F.col(_PLACE) == F.col(_CROWD)
    sent = placed.join(crowded, here, "left_anti").repartition(_PLACE)
    rank = F.row_number().over(Window.partitionBy(_PLACE, *keys).orderBy(*order))
    few = sent.withColumn(_RANK, rank).filter(F.col(_RANK) == 1).drop(_RANK, _PLACE)
    many = placed.join(crowded, here, "left_semi").drop(_PLACE)
    return few.unionByName(dedup_latest(many, keys, order))


def duplicate_counts(df: DataFrame, keys: list[str], least: int = 1) -> DataFrame:
    """Copies per key, for keys with at least ``least`` rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("cnt")).filter(F.col("cnt") >= least)


def dedup_removed(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows before and after keeping one row per key, and the difference."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("copies"))
    before, after = F.coalesce(F.sum("copies"), F.lit(0)), F.count("*")
    return per_key.agg(
        before.alias("rows_before"),
        after.alias("rows_after"),
        (before - after).alias("rows_removed"),
    )
