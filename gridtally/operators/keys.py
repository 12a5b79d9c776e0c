"""Key checks shared by the join-like operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SEEN = "__seen"


def all_present(columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def _shown(keys: list[str]) -> Column:
    return F.concat_ws(",", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])


def require_unique(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    """The same rows where they are; the job fails if a key shows up twice.

    The check is an aggregate of its own, so ``df`` is computed twice, and only keys are
    shuffled for it. The rows keep their partitioning: a join by the keys gives them a
    shuffle of its own, without which adaptive skew handling could not split the other side.
    """
    repeated = df.groupBy(*keys).agg(F.count("*").alias(_SEEN)).filter(F.col(_SEEN) > 1)
    first = repeated.agg(F.min(_shown(keys))).scalar()
    twice = F.raise_error(F.concat(F.lit(f"{what}: more than one row for key "), first))
    return df.filter(F.when(first.isNotNull(), twice.cast("boolean")).otherwise(True))


def assert_unique(
    df: DataFrame, keys: list[str], what: str, where: Column | None = None, shown: list[str] | None = None
) -> DataFrame:
    """The same rows; the job fails as soon as a key shows up twice, among rows ``where``.

    The message names the columns ``shown`` of the key, or all of them.

    The check clusters and sorts by the keys, which a sort-merge join on the
    same keys then reuses, so it adds no shuffle to such a join. That suits joins of
    two sides with unique keys; where the other side may have busy keys, use
    ``require_unique``.
    """
    seen = F.row_number().over(Window.partitionBy(*keys).orderBy(keys[0]))
    twice = F.raise_error(F.concat(F.lit(f"{what}: more than one row for key "), _shown(shown or keys)))
    again = F.col(_SEEN) > 1 if where is None else (F.col(_SEEN) > 1) & where
    return (
        df.withColumn(_SEEN, seen)
        .filter(F.when(again, twice.cast("boolean")).otherwise(True))
        .drop(_SEEN)
    )
