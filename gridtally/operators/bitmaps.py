"""Exact distinct counts that can be stored by batch and merged.

Values such as device numbers get whole numbers once and for all. The values seen in a
group are then bits: one bitmap of 4 KB for each 32,768 numbers. Bitmaps of batches or
days are merged by OR and counted, so a report over many days reads bitmaps and
not readings, and shuffles no (group, value) pairs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtally.operators import quality

#: Values are numbered in so many parts at a time; each takes every ``PARTS``-th number.
PARTS = 256


def assign_numbers(values: DataFrame, known: DataFrame | None = None, parts: int = PARTS) -> DataFrame:
    """(value, number) of all values; values of ``known``, a former result, keep their number.

    ``values`` has one column; NULLs and repeats do not count. Each part numbers its values on
    its own, in their order, behind those it has already, so numbers stay dense and no
    task sees all values. Rerunning it on the same input gives the same numbers.
    """
    column = values.columns[0]
    fresh = values.select(F.col(column).alias("value")).filter(F.col("value").isNotNull()).distinct()
    if known is not None:
        fresh = fresh.join(known.select("value"), "value", "left_anti")
    part = F.pmod(F.xxhash64("value"), F.lit(parts))
    turn = F.row_number().over(Window.partitionBy("part").orderBy("value"))
    fresh = fresh.withColumn("part", part).withColumn("turn", turn.cast("long"))
    if known is None:
        return fresh.select("value", ((F.col("turn") - 1) * parts + F.col("part")).alias("number"))
    taken = known.groupBy(F.pmod("number", F.lit(parts)).alias("part")).agg(
        (F.max(F.floor(F.col("number") / parts)) + 1).alias("taken")
    )
    turn = F.col("turn") - 1 + F.coalesce("taken", F.lit(0))
    # at most ``parts`` rows
    added = fresh.join(F.broadcast(taken), "part", "left").select("value", (turn * parts + F.col("part")).alias("number"))
    return known.select("value", "number").unionByName(added)


def value_bitmaps(df: DataFrame, by: tuple[str, ...], column: str, numbers: DataFrame) -> DataFrame:
    """(by, bucket, bits): the values of ``column`` in each group; NULLs do not count."""
    pairs = df.filter(F.col(column).isNotNull()).select(*by, F.col(column).alias("value")).distinct()
    bucket = F.bitmap_bucket_number("number").alias("bucket")
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")
    return pairs.join(numbers, "value").groupBy(*by, bucket).agg(bits)


def merged_bitmaps(bitmaps: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Bitmaps of several batches, or of finer groups, put together by ``by``."""
    return bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def counted_bitmaps(bitmaps: DataFrame, by: tuple[str, ...], name: str) -> DataFrame:
    """How many values each group has."""
    merged = merged_bitmaps(bitmaps, by)
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias(name))


def partial_report(
    df: DataFrame,
    numbers: dict[str, DataFrame],
    by: tuple[str, ...] = ("aep_usage_dt",),
    distinct: dict[str, str] | None = None,
    flags: dict[str, Column] | None = None,
) -> DataFrame:
    """The quality report of one batch in a form that can be stored and merged.

    ``numbers`` has the numbered values of each column that is counted. Rows of the
    empty ``measure`` hold counts by group, others the bitmaps of one measure.
    """
    distinct = distinct or {"unique_meters": "serialnumber", "unique_channels": "aep_channel_id"}
    flags = flags or quality.quality_flags()
    counts = df.groupBy(*by).agg(
        F.count("*").alias("total_records"), *[F.count_if(c).alias(name) for name, c in flags.items()]
    )
    parts = [counts.withColumn("measure", F.lit(""))]
    for name, column in distinct.items():
        bitmaps = value_bitmaps(df, by, column, numbers[column])
        parts.append(bitmaps.withColumn("measure", F.lit(name)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def merged_report(
    partials: DataFrame,
    by: tuple[str, ...] = ("aep_usage_dt",),
    distinct: tuple[str, ...] = ("unique_meters", "unique_channels"),
) -> DataFrame:
    """``quality_report`` of everything the stored partial reports cover; NULL groups stay."""
    measures = ("measure", "bucket", "bits")
    counts = [c for c in partials.columns if c not in (*by, *measures)]
    merged = partials.groupBy(*by, "measure", "bucket").agg(
        F.bitmap_or_agg(F.coalesce("bits", F.to_binary(F.lit(""), F.lit("hex")))).alias("bits"),
        *[F.sum(c).alias(c) for c in counts],
    )

    def values(name: str) -> Column:
        return F.sum(F.when(F.col("measure") == name, F.bitmap_count("bits"))).alias(name)

    whole = merged.groupBy(*by).agg(*[F.sum(c).alias(c) for c in counts], *map(values, distinct))
    rest = [c for c in counts if c != "total_records"]
    shown = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in distinct]
    return whole.select(*by, "total_records", *shown, *rest).orderBy(*by)
