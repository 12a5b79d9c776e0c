"""Column-by-column comparison of tables that share a key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally import config
from gridtally.operators.keys import all_present, assert_unique
from gridtally.session import work_path
from gridtally.sinks.staging import stage

OK, DIFF = "OK", "DIFF"


def _packed(df: DataFrame, keys: list[str], columns: list[str], name: str) -> DataFrame:
    """Key columns and one struct of the compared columns as text."""
    texts = F.struct(*[F.col(c).cast("string").alias(c) for c in columns])
    return df.select(*[F.col(k).alias(f"__{name}_{k}") for k in keys], texts.alias(f"__{name}"))


def _long(
    joined: DataFrame,
    keys: list[Column],
    columns: list[str],
    names: list[str],
    status,
    only_differences: bool,
) -> DataFrame:
    """One row per key and column with the value of each side and a status."""
    lines = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                *[F.col(f"__{n}.{c}").alias(n) for n in names],
                status(c).alias("status"),
            )
            for c in columns
        ]
    )
    if only_differences:
        lines = F.filter(lines, lambda line: line["status"] != OK)
    return joined.select(*keys, F.inline(lines))


def reconcile(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    ignore: list[str] | None = None,
    names: tuple[str, str] = ("left", "right"),
    only_differences: bool = False,
) -> DataFrame:
    """Compare two tables row by row and column by column.

    Values compare as text and NULL equals NULL. Rows of one side only get the
    status ``NO <other side>``. Both sides must be unique by key; rows with a
    NULL key match nothing and bypass the join.
    """
    skip = set(keys) | set(config.AUDIT_COLUMNS if ignore is None else ignore)
    columns = [c for c in left.columns if c not in skip]
    sides = {
        name: assert_unique(df.filter(all_present(keys)), keys, name)
        for name, df in zip(names, (left, right))
    }
    one, two = names
    packed = {n: _packed(df, keys, columns, n) for n, df in sides.items()}
    same = [F.col(f"__{one}_{k}") == F.col(f"__{two}_{k}") for k in keys]
    joined = packed[one].join(packed[two], same, "full_outer")

    loose_left = _packed(left.filter(~all_present(keys)), keys, columns, one)
    loose_right = _packed(right.filter(~all_present(keys)), keys, columns, two)
    joined = joined.unionByName(loose_left, allowMissingColumns=True)
    joined = joined.unionByName(loose_right, allowMissingColumns=True)

    def status(c: str) -> Column:
        equal = F.col(f"__{one}.{c}").eqNullSafe(F.col(f"__{two}.{c}"))
        return (
            F.when(F.col(f"__{two}").isNull(), f"NO {two}")
            .when(F.col(f"__{one}").isNull(), f"NO {one}")
            .when(equal, OK)
            .otherwise(DIFF)
        )

    shown = [F.coalesce(F.col(f"__{one}_{k}"), F.col(f"__{two}_{k}")).alias(k) for k in keys]
    return _long(joined, shown, columns, list(names), status, only_differences)


def bucket_digests(
    df: DataFrame, keys: list[str], columns: list[str], by: list[str], buckets: int
) -> DataFrame:
    """(by, bucket, rows, digest): one line for each bucket of keys, whatever the order of rows.

    The digest is the sum and the XOR of two 64-bit hashes of a row's key and columns; NULLs are told
    from empty text. Combined before the shuffle, so a bucket costs one row per task.
    """
    cells = [F.col(c).cast("string") for c in [*keys, *columns]]
    empty = [c.isNull() for c in cells]
    return (
        df.select(
            *by,
            F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket"),
            F.xxhash64(*cells, *empty).alias("one"),
            F.xxhash64(F.lit("two"), *empty, *cells).alias("two"),
        )
        .groupBy(*by, "bucket")
        .agg(
            F.count("*").alias("rows"),
            F.sum(F.col("one").cast("decimal(38,0)")).alias("sum"),
            F.bit_xor("two").alias("xor"),
        )
        .select(*by, "bucket", "rows", F.concat_ws(":", F.col("sum").cast("string"), F.hex("xor")).alias("digest"))
    )


def differing_buckets(
    left: DataFrame, right: DataFrame, keys: list[str], columns: list[str], by: list[str], buckets: int
) -> DataFrame:
    """(by, bucket) of the buckets whose digests differ, or that one side only has."""
    sides = [
        bucket_digests(df.filter(all_present(keys)), keys, columns, by, buckets).withColumn("side", F.lit(side))
        for df, side in ((left, "left"), (right, "right"))
    ]
    both = sides[0].unionByName(sides[1]).groupBy(*by, "bucket")
    seen = both.agg(
        F.count("*").alias("sides"), F.count_distinct(F.struct("rows", "digest")).alias("kinds")
    )
    return seen.filter((F.col("sides") == 1) | (F.col("kinds") > 1)).select(*by, "bucket")


def reconcile_changed(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    by: list[str] | None = None,
    buckets: int = 4096,
    ignore: list[str] | None = None,
    names: tuple[str, str] = ("left", "right"),
) -> DataFrame:
    """The lines of ``reconcile`` that are not OK, without joining what is equal.

    Digests of buckets of keys are compared first; only rows of buckets that differ, and
    rows with a NULL key, are compared in full. ``by`` names key columns, such as the usage date, by
    which buckets are kept apart. Both tables are read twice and keys of equal buckets
    are not checked for repeats. Two buckets that differ have equal digests with a
    chance of about one in 10^38.
    """
    by = by or []
    if set(by) - set(keys):
        raise ValueError("buckets can be kept apart by key columns only")
    skip = set(keys) | set(config.AUDIT_COLUMNS if ignore is None else ignore)
    columns = [c for c in left.columns if c not in skip]
    changed = stage(differing_buckets(left, right, keys, columns, by, buckets), work_path(left.sparkSession, "buckets"))
    place = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")

    def chosen(df: DataFrame) -> DataFrame:
        complete = df.filter(all_present(keys)).withColumn("bucket", place)
        loose = df.filter(~all_present(keys))
        return complete.join(changed, [*by, "bucket"], "left_semi").select(df.columns).unionByName(loose)

    return reconcile(chosen(left), chosen(right), keys, ignore, names, only_differences=True)


def reconcile_against(
    base: DataFrame,
    others: dict[str, DataFrame],
    keys: list[str],
    ignore: list[str] | None = None,
    base_name: str = "dev",
    only_differences: bool = False,
) -> DataFrame:
    """Compare every row of ``base`` with its row in each other table.

    A column is OK when all tables that have the row agree with the base, and
    ``NO DATA`` when none has it. Rows of the base with a NULL key match nothing
    and bypass the joins. The left joins keep the base partitioned by key, so each
    table is shuffled once.
    """
    skip = set(keys) | set(config.AUDIT_COLUMNS if ignore is None else ignore)
    columns = [c for c in base.columns if c not in skip]
    complete = all_present(keys)
    joined = _packed(assert_unique(base.filter(complete), keys, base_name), keys, columns, base_name)
    for name, df in others.items():
        side = assert_unique(df.filter(all_present(keys)), keys, name)
        same = [F.col(f"__{base_name}_{k}") == F.col(f"__{name}_{k}") for k in keys]
        joined = joined.join(_packed(side, keys, columns, name), same, "left")

    loose = _packed(base.filter(~complete), keys, columns, base_name)
    joined = joined.unionByName(loose, allowMissingColumns=True)
    present = [F.col(f"__{n}").isNotNull() for n in others]

    def status(c: str) -> Column:
        mine = F.col(f"__{base_name}.{c}")
        agree = [
            F.col(f"__{n}").isNull() | mine.eqNullSafe(F.col(f"__{n}.{c}")) for n in others
        ]
        return (
            F.when(~reduce(lambda a, b: a | b, present), "NO DATA")
            .when(reduce(lambda a, b: a & b, agree), OK)
            .otherwise(DIFF)
        )

    shown = [F.col(f"__{base_name}_{k}").alias(k) for k in keys]
    return _long(joined, shown, columns, [base_name, *others], status, only_differences)


def reconcile_key(
    base: DataFrame,
    others: dict[str, DataFrame],
    key: dict[str, object],
    prune: dict[str, object] | None = None,
    ignore: list[str] | None = None,
    base_name: str = "dev",
) -> DataFrame:
    """``reconcile_against`` for one key; ``prune`` names partition values of that key.

    Key and partition filters are applied to every table before anything is
    joined, so stored tables read one partition and only the row's row groups.
    """

    def chosen(df: DataFrame) -> DataFrame:
        for column, value in {**(prune or {}), **key}.items():
            df = df.filter(F.col(column) == F.lit(value))
        return df

    picked = {name: chosen(df) for name, df in others.items()}
    return reconcile_against(chosen(base), picked, list(key), ignore, base_name)
