"""Data-quality and activity reports."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally import config


def row_count(df: DataFrame, where: Column | None = None, name: str = "total_records") -> DataFrame:
    kept = df if where is None else df.filter(where)
    return kept.agg(F.count("*").alias(name))


def count_by(df: DataFrame, *by: str, name: str = "record_count") -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias(name))


def distinct_count(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.agg(F.count_distinct(column).alias(name))


def quality_flags() -> dict[str, Column]:
    """The conditions counted by the quality report."""
    return {
        "null_premise_count": F.col("aep_premise_nb").isNull(),
        "matched_premise_count": F.col("aep_premise_nb").isNotNull(),
        "unknown_uom_count": F.col("aep_derived_uom") == config.UNKNOWN,
        "null_value_count": F.col("value").isNull(),
        "null_scalarfloat_count": F.col("scalarfloat").isNull(),
        "null_city_count": F.col("aep_city").isNull(),
        "null_authority_count": F.col("authority").isNull(),
    }


def quality_report(
    df: DataFrame,
    by: tuple[str, ...] = ("aep_usage_dt",),
    distinct: dict[str, str] | None = None,
    flags: dict[str, Column] | None = None,
) -> DataFrame:
    """Row, distinct and condition counts per group, in one aggregate.

    Only the distinct (group, device) and (group, channel) pairs of each input
    partition are shuffled; all other counts are combined before that.
    """
    distinct = distinct or {"unique_meters": "serialnumber", "unique_channels": "aep_channel_id"}
    flags = flags or quality_flags()
    return (
        df.groupBy(*by)
        .agg(
            F.count("*").alias("total_records"),
            *[F.count_distinct(column).alias(name) for name, column in distinct.items()],
            *[F.count_if(condition).alias(name) for name, condition in flags.items()],
        )
        .orderBy(*by)
    )


def match_rate(df: DataFrame, matched: dict[str, str], nulls: dict[str, str]) -> DataFrame:
    """One row: all rows, and the named counts of filled and of NULL columns."""
    return df.agg(
        F.count("*").alias("total_rows"),
        *[F.count_if(F.col(c).isNotNull()).alias(name) for name, c in matched.items()],
        *[F.count_if(F.col(c).isNull()).alias(name) for name, c in nulls.items()],
    )


def premise_match_rate(df: DataFrame) -> DataFrame:
    """How many staged readings found their premise, and which attributes are missing."""
    return match_rate(
        df,
        {"matched_premise_count": "aep_premise_nb"},
        {
            "null_premise_count": "aep_premise_nb",
            "null_bill_cnst_count": "bill_cnst",
            "null_city_count": "aep_city",
            "null_meter_program_count": "aep_meter_program",
        },
    )


def null_counts(df: DataFrame, formulas: dict[str, Column]) -> DataFrame:
    """One row: all rows and, per formula, how many rows it leaves NULL."""
    return df.agg(
        F.count("*").alias("total_rows"),
        *[F.count_if(formula.isNull()).alias(name) for name, formula in formulas.items()],
    )


def extent(df: DataFrame, column: str, low: str, high: str) -> DataFrame:
    return df.agg(F.min(column).alias(low), F.max(column).alias(high))


def latest_only(df: DataFrame, column: str) -> DataFrame:
    """The rows of the latest value, such as the last run; a partition filter when stored so."""
    return df.filter(F.col(column) == df.agg(F.max(column)).scalar())


def top_groups(df: DataFrame, by: str, k: int, name: str = "cnt") -> DataFrame:
    """The ``k`` largest groups; ties go to the smaller key."""
    return count_by(df, by, name=name).orderBy(F.desc(name), F.asc(by)).limit(k)


def any_stamp_in(columns: list[str], start: datetime, end: datetime | None = None) -> Column:
    """Whether any of the stamps lies in [start, end); open-ended without ``end``."""

    def inside(name: str) -> Column:
        stamp = F.col(name)
        return stamp >= start if end is None else (stamp >= start) & (stamp < end)

    return reduce(lambda a, b: a | b, [inside(c) for c in columns])


def activity(
    df: DataFrame,
    start: datetime,
    end: datetime | None = None,
    stamps: tuple[str, ...] = tuple(config.AUDIT_COLUMNS),
    user: str = "hdp_update_user",
) -> DataFrame:
    """Rows inserted or updated in the window, counted per user stamp."""
    return count_by(df.filter(any_stamp_in(list(stamps), start, end)), user)


def point_lookup(df: DataFrame, **values: object) -> DataFrame:
    """Rows whose columns equal the given values."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(c) == F.lit(v) for c, v in values.items()]))
