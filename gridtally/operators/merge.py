"""Upsert and retention as DataFrame operators."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally import config
from gridtally.functions import times
from gridtally.operators.keys import all_present, assert_unique

ACTION = "merge_action"


def _packed(df: DataFrame, side: str, keys: list[str], groups: dict[str, list[str]]) -> DataFrame:
    """Keys, a presence marker, and one struct per group of columns that are chosen together.

    ``__place`` is a hash of the key, by which rows are dealt to tasks and sorted first.
    Rows with a NULL key match nothing; theirs is a hash of the whole row, so that they are
    dealt to all tasks of the join.
    """
    loose = F.xxhash64(F.lit(side), *df.columns)
    return df.select(
        *[F.col(k).alias(f"__{side}_{k}") for k in keys],
        *[F.struct(*members).alias(f"__{side}_{name}") for name, members in groups.items()],
        F.lit(True).alias(f"__{side}"),
        F.when(all_present(keys), F.xxhash64(*keys)).otherwise(loose).alias(f"__{side}_place"),
    )


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update_cols: list[str],
    on_update: dict[str, Column] | None = None,
    on_insert: dict[str, Column] | None = None,
    action: bool = False,
) -> DataFrame:
    """The table after MERGE: matched rows updated, new rows inserted, others kept.

    A matched row takes ``update_cols`` from the source and keeps the rest; an
    inserted row takes every column. ``on_update`` and ``on_insert`` replace
    single columns, for example the user stamp. Keys match by plain equality,
    so rows with a NULL key never match; they are spread over all tasks. Each
    side is read once. A repeated source key fails the job. With ``action`` the
    result says per row whether it was updated, inserted or kept.
    """
    on_update, on_insert = on_update or {}, on_insert or {}
    columns = target.columns
    groups = {
        "changed": [c for c in columns if c in update_cols and c not in keys],
        "fixed": [c for c in columns if c not in update_cols and c not in keys],
    }
    groups = {name: members for name, members in groups.items() if members}

    known = _packed(target, "old", keys, groups)
    # Keys of one type on both sides, so that equal ones have equal hashes.
    alike = [F.col(c).cast(target.schema[c].dataType).alias(c) if c in keys else F.col(c) for c in columns]
    fresh = _packed(source.select(*alike), "new", keys, groups)
    new_keys = [f"__new_{k}" for k in keys]
    fresh = assert_unique(fresh, ["__new_place", *new_keys], "merge source", all_present(new_keys), new_keys)
    same = [F.col("__old_place") == F.col("__new_place")]
    same += [F.col(f"__old_{k}") == F.col(f"__new_{k}") for k in keys]
    in_target, in_source = F.col("__old").isNotNull(), F.col("__new").isNotNull()

    def pick(name: str) -> Column:
        old, new = F.col(f"__old_{name}"), F.col(f"__new_{name}")
        if name == "fixed":
            return F.when(in_target, old).otherwise(new)
        return F.when(in_source, new).otherwise(old)

    did = F.when(in_target & in_source, "updated").when(in_source, "inserted").otherwise("kept")
    joined = known.join(fresh, same, "full_outer").select(
        did.alias(ACTION),
        *[F.coalesce(f"__old_{k}", f"__new_{k}").alias(k) for k in keys],
        *[pick(name).alias(f"__{name}") for name in groups],
    )
    place = {c: f"__{name}.{c}" for name, members in groups.items() for c in members}

    def merged(name: str) -> Column:
        value = F.col(place.get(name, name))
        for label, changes in (("updated", on_update), ("inserted", on_insert)):
            if name in changes:
                value = F.when(F.col(ACTION) == label, changes[name]).otherwise(value)
        return value.alias(name)

    result = joined.select(*[merged(c) for c in columns], ACTION)
    return result if action else result.drop(ACTION)


def merge_preview(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    by: list[str],
) -> DataFrame:
    """What an upsert would update, insert and keep, counted by ``by``; nothing is written."""
    columns = list(dict.fromkeys([*keys, *by]))
    merged = merge_upsert(target.select(*columns), source.select(*columns), keys, [], action=True)
    return merged.groupBy(*by).agg(
        *[
            F.count(F.when(F.col(ACTION) == name, True)).alias(name)
            for name in ("updated", "inserted", "kept")
        ]
    )


def retention_cutoff(run_ts: datetime, days: int = config.RETENTION_DAYS) -> str:
    return times.run_date(run_ts - timedelta(days=days))


def retain_recent(
    df: DataFrame,
    tenant: str,
    run_ts: datetime,
    days: int = config.RETENTION_DAYS,
    tenant_col: str = "aep_opco",
    run_col: str = "run_date",
) -> DataFrame:
    """The rows a retention DELETE for one tenant leaves behind.

    Run dates compare as text; rows with a NULL tenant or run date stay.
    """
    expired = (F.col(tenant_col) == tenant) & (
        F.col(run_col) < retention_cutoff(run_ts, days)
    )
    return df.filter(~F.coalesce(expired, F.lit(False)))
