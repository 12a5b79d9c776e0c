"""Lookup and validity-interval joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtally.functions import times
from gridtally.operators.keys import all_present, require_unique

_FROM, _TO, _CUT, _END = "__from", "__to", "__cut", "__end"
_PART_KEY, _RANK, _PLACE = "__part_key", "__rank", "__place"


def _hinted(df: DataFrame, strategy: str | None) -> DataFrame:
    return df if strategy is None else df.hint(strategy)


def lookup_left(
    fact: DataFrame,
    dim: DataFrame,
    on: dict[str, str],
    defaults: dict[str, Column] | None = None,
    unique: bool = True,
    strategy: str | None = None,
) -> DataFrame:
    """Left join to a lookup; ``on`` maps fact columns to lookup key columns.

    Spark broadcasts the lookup if its bytes are below the session's threshold and
    shuffles otherwise, where adaptive skew handling splits the readings of a busy
    key. ``strategy`` is a join hint that overrides this. With ``unique`` the job
    fails if the lookup would multiply readings; this check runs beside the join and
    leaves the lookup's partitioning alone, so that skew handling still applies.
    """
    keys = list(on.values())
    usable = dim.filter(all_present(keys))
    if unique:
        usable = require_unique(usable, keys, "lookup")
    renamed = {k: f"__key_{k}" for k in keys}
    usable = _hinted(usable.withColumnsRenamed(renamed), strategy)
    condition = [F.col(f) == F.col(renamed[k]) for f, k in on.items()]
    joined = fact.join(usable, condition, "left").drop(*renamed.values())
    for name, value in (defaults or {}).items():
        joined = joined.withColumn(name, F.coalesce(F.col(name), value))
    return joined


def _bounded(dim: DataFrame, intervals: list[tuple[str, str]]) -> DataFrame:
    """Dimension rows that can match at all, with the overlap of their intervals.

    A point lies in all closed intervals exactly if it lies in their overlap,
    and a NULL bound never matches.
    """
    lows = [F.col(lo) for lo, _ in intervals]
    highs = [F.col(hi) for _, hi in intervals]
    return (
        dim.filter(all_present([c for pair in intervals for c in pair]))
        .withColumn(_FROM, F.greatest(*lows) if len(lows) > 1 else lows[0])
        .withColumn(_TO, F.least(*highs) if len(highs) > 1 else highs[0])
        .filter(F.col(_FROM) <= F.col(_TO))
    )


def _tree_nodes(low: str, high: str) -> Column:
    """The nodes (level, number) of a binary tree that together span the places [low, high)."""
    first = f"shiftright({low} + shiftleft(1L, k) - 1, k)"
    last = f"shiftright({high}, k)"
    left = f"if({first} < {last} and {first} % 2 = 1, named_struct('level', k, 'number', {first}), null)"
    right = f"if({first} < {last} and {last} % 2 = 1, named_struct('level', k, 'number', {last} - 1), null)"
    levels = f"transform(sequence(0, length(bin({high}))), k -> array({left}, {right}))"
    return F.expr(f"array_compact(flatten({levels}))")


def disjoint_validity(
    dim: DataFrame, key: str, intervals: list[tuple[str, str]], order: list[Column]
) -> DataFrame:
    """Validity rows cut to parts of which at most one covers any moment of a key.

    Where rows overlap, the first one in ``order`` is valid; the columns settle
    what the order leaves open, so the choice does not depend on the input order.
    The part is in the added bound columns.

    Works on the dimension alone. The borders of a key's rows are its places. A row
    is noted at the few nodes of a binary tree over the places that make up its span,
    a node keeps its first row, and a place takes the first row of the nodes above it.
    So n rows of one key cost n log n, also if all of them overlap. Neighbouring parts
    of one row are put together.
    """
    rows = _bounded(dim, intervals).filter(F.col(key).isNotNull()).distinct()
    rest = [F.col(c).desc_nulls_last() for c in dim.columns]
    rows = rows.withColumn(_RANK, F.row_number().over(Window.partitionBy(key).orderBy(*order, *rest)))
    border = F.explode(F.array(F.col(_FROM), F.col(_TO) + 1)).alias(_CUT)
    by_cut = Window.partitionBy(_PART_KEY).orderBy(_CUT)
    placed = rows.select(F.col(key).alias(_PART_KEY), _RANK, border).withColumn(
        _PLACE, F.dense_rank().over(by_cut).cast("long") - 1
    )
    spans = placed.groupBy(_PART_KEY, _RANK).agg(F.min(_PLACE).alias("__low"), F.max(_PLACE).alias("__high"))
    noted = spans.select(_PART_KEY, _RANK, F.inline(_tree_nodes("__low", "__high")))
    node = [_PART_KEY, "level", "number"]
    best = noted.groupBy(*node).agg(F.min(_RANK).alias(_RANK))

    parts = (
        placed.select(_PART_KEY, _CUT, _PLACE)
        .distinct()
        .withColumn(_END, F.lead(_CUT).over(by_cut) - 1)
        .withColumn("__high", F.max(_PLACE).over(Window.partitionBy(_PART_KEY)))
        .filter(F.col(_END).isNotNull())
    )
    above = parts.withColumn("level", F.explode(F.expr("sequence(0, length(bin(__high)))")))
    above = above.withColumn("number", F.expr(f"shiftright({_PLACE}, level)"))
    won = above.join(best, node).groupBy(_PART_KEY, _CUT, _END).agg(F.min(_RANK).alias(_RANK))
    fresh = (F.lag(_RANK).over(by_cut) != F.col(_RANK)) | (F.lag(_END).over(by_cut) != F.col(_CUT) - 1)
    whole = (
        won.withColumn("__fresh", fresh)
        .withColumn("__run", F.sum(F.coalesce("__fresh", F.lit(True)).cast("int")).over(by_cut))
        .groupBy(_PART_KEY, _RANK, "__run")
        .agg(F.min(_CUT).alias(_CUT), F.max(_END).alias(_END))
        .withColumnRenamed(_RANK, "__won")
    )
    rows = rows.drop(_FROM, _TO)
    chosen = rows.join(whole, (F.col(key) == F.col(_PART_KEY)) & (F.col(_RANK) == F.col("__won")))
    return chosen.select(*dim.columns, F.col(_CUT).alias(_FROM), F.col(_END).alias(_TO))


def validity_join(
    fact: DataFrame,
    dim: DataFrame,
    on: tuple[str, str],
    at: str,
    intervals: list[tuple[str, str]],
    how: str = "left",
    order: list[Column] | None = None,
    strategy: str | None = None,
) -> DataFrame:
    """Join readings to the dimension rows that are valid at the reading's epoch.

    ``on`` is (fact key, dimension key) and ``intervals`` lists (low, high)
    column pairs, all inclusive. Overlapping validity rows multiply readings,
    unless ``order`` says which of them is valid.

    An equi join on the key with the interval as a further condition. Readings
    are read once and no validity row is copied. Adaptive skew handling splits the
    readings of a busy device over several tasks, whatever their epochs are: the parts that
    ``order`` leaves are partitioned by device and row, so the join shuffles both sides.
    These parts are hashed and readings stream past them, so no reading is sorted,
    held or spilled; the parts of a task's devices must fit its memory. Without
    ``order``, Spark broadcasts a small dimension by its bytes and sorts otherwise.
    ``strategy`` is a join hint that overrides the choice; with ``merge`` both sides are
    sorted and may spill.
    """
    fact_key, dim_key = on
    if order is None:
        valid = _bounded(dim, intervals).filter(F.col(dim_key).isNotNull())
    else:
        valid = disjoint_validity(dim, dim_key, intervals, order)
        strategy = strategy or "shuffle_hash"
    valid = _hinted(valid.withColumnRenamed(dim_key, "__dim_key"), strategy)
    inside = F.col(at).between(F.col(_FROM), F.col(_TO))
    same_key = F.col(fact_key) == F.col("__dim_key")
    return fact.join(valid, same_key & inside, how).drop("__dim_key", _FROM, _TO)


def window_flag(at: Column, low: Column, high: Column, yes: str, no: str) -> Column:
    """``yes`` if the point lies in the closed interval, else ``no`` (also for NULL bounds)."""
    return F.when(at.between(low, high), F.lit(yes)).otherwise(F.lit(no))


def validity_diagnose(
    fact: DataFrame,
    dim: DataFrame,
    on: tuple[str, str],
    at: str,
    intervals: dict[str, tuple[str, str]],
    chosen: list[str],
) -> DataFrame:
    """Readings of the chosen keys with every validity row and a YES/NO flag per interval.

    ``intervals`` maps the flag column to a (low, high) pair. The result has one
    row per reading and validity row of a device, so the devices must be named;
    both sides are cut to them before the join. The reading's epoch and all bounds
    are also given as text in UTC, with ``_text`` added to their names.
    """
    fact_key, dim_key = on
    rows = dim.filter(F.col(dim_key).isin(chosen))
    fact = fact.filter(F.col(fact_key).isin(chosen))
    bounds = [c for pair in intervals.values() for c in pair]
    texts = {f"{c}_text": times.epoch_text(F.col(c)) for c in dict.fromkeys([at, *bounds])}
    flags = {
        name: window_flag(F.col(at), F.col(lo), F.col(hi), "YES", "NO")
        for name, (lo, hi) in intervals.items()
    }
    joined = fact.join(rows, F.col(fact_key) == F.col(dim_key), "inner")
    return joined.withColumns(flags | texts)


def validity_check(
    dim: DataFrame, at: Column, intervals: dict[str, tuple[str, str]]
) -> DataFrame:
    """Every validity row with PASS or FAIL per interval at the given epoch."""
    return dim.withColumns(
        {
            name: window_flag(at, F.col(lo), F.col(hi), "PASS", "FAIL")
            for name, (lo, hi) in intervals.items()
        }
    )
