"""Mixing sources to target weights by hash thresholds, with DataFrame functions only.

Every row has a hash; a source's budget is met by the rows below a threshold. One
histogram sums words by source and the first ``BITS`` bits of the hash; the bucket
in which the budget is reached is refined by the next bits, and so on until the
hash is used up. No row is sorted or collected, and the histogram of a source has at
most ``2**BITS`` rows at a time. Budgets are nested: a row below the threshold of a
smaller budget is below that of any larger one, so smaller mixes are parts of larger
ones of the same seed.

Targets share out all words by weight; none exceeds ``CAP`` times its source, and
what is above goes to the others by weight. A target above its source's size takes
all rows as often as it fits, and the rest by threshold. The last cell, rows of one
hash, is taken if that comes nearer to the budget.

Defined cases: null text has no words. A null source is a source of its own, the last
one. Rows of equal id and text have equal hashes and are taken alike; null ids differ
by their text. Rows without words are taken as often as others, at no cost. An empty
table gives an empty table; other columns are not read by ``mix`` and stay in
``apply_mix``. Sources meet in one task only as one row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtally.llm.groups import join_keyed
from gridtally.llm.tables import staged

# Fixed value: what is a word.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
CAP = 3
BITS = 12
#: 60 bits of hash are refined in five steps.
HASH_DIGITS = 15
STEPS = 4 * HASH_DIGITS // BITS


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_hash(id_col: Column, text: Column) -> Column:
    """60 bits that look random, from the id and the text."""
    none = F.lit("")
    row = F.concat(F.coalesce(id_col.cast("string"), none), F.lit(":"), F.coalesce(text, none))
    return F.conv(F.substring(F.md5(row), 1, HASH_DIGITS), 16, 10).cast("long")


def source_key(source: Column) -> Column:
    """Text that is null for no source."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source_key, n_rows, source_size, target) from (source_key, source, size).

    In the order of cap by weight a source is at its cap as long as the level that
    the remaining words would reach over the remaining weights is not below it.
    """
    by_code_point = Window.orderBy(F.col("source").asc_nulls_last())
    order = Window.orderBy("ratio", "source_key")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    weight = F.element_at(
        F.array(*(F.lit(w) for w in weights)), (F.col("place") - 1) % len(weights) + 1
    ).cast("long")
    rest = F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0))
    return (
        sized.groupBy("source_key", "source")
        .agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
        .withColumn("place", F.row_number().over(by_code_point))
        .withColumn("weight", weight)
        .withColumn("most", cap * F.col("source_size"))
        .withColumn("ratio", F.col("most") / F.col("weight"))
        .withColumn("level", rest / F.sum("weight").over(onward))
        .withColumn("free", F.col("ratio") > F.col("level"))
        .withColumn("final", F.max(F.when(F.col("free"), F.col("level"))).over(everything))
        .withColumn(
            "target",
            F.when(F.col("free"), F.col("weight") * F.col("final")).otherwise(F.col("most").cast("double")),
        )
        .select("source_key", "n_rows", "source_size", "target")
    )


def thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source_key, rung, threshold) for budgets (source_key, rung, budget).

    ``sized`` has (source_key, hash, size). Rows whose hash is below the threshold
    have about the budget's words in all. A source may have several rungs.
    """
    edge = budgets.withColumn("below", F.lit(0).cast("long"))
    rows = sized
    for step in range(STEPS):
        shift = BITS * (STEPS - 1 - step)
        keys = ["source_key", "prefix"] if step else ["source_key"]
        above = F.shiftright("hash", shift + BITS).alias("prefix")
        cells = rows.groupBy("source_key", *([above] if step else []), F.shiftright("hash", shift).alias("cell"))
        found = edge.join(cells.agg(F.sum("size").alias("size")), keys)
        upto = F.sum("size").over(Window.partitionBy("source_key", "rung").orderBy("cell"))
        first = F.min(F.struct("cell", "upto", "size"))
        edge = (
            found.withColumn("upto", F.col("below") + upto)
            .filter(F.col("upto") > F.col("budget"))
            .groupBy("source_key", "rung", "budget")
            .agg(first.alias("first"))
            .select(
                "source_key",
                "rung",
                "budget",
                F.col("first.cell").alias("prefix"),
                (F.col("first.upto") - F.col("first.size")).alias("below"),
                F.col("first.size").alias("last"),
            )
        )
        if step == 0:
            # Only rows of the boundary buckets are looked into further.
            edge = staged(edge, "edge")
            wanted = edge.select("source_key", "prefix").distinct()
            inside = sized.withColumn("prefix", F.shiftright("hash", shift)).join(wanted, ["source_key", "prefix"])
            rows = staged(
                inside.groupBy("source_key", "hash").agg(F.sum("size").alias("size")), "boundary"
            )
    nearer = F.col("below") + F.col("last") - F.col("budget") < F.col("budget") - F.col("below")
    last = edge.select(
        "source_key", "rung", (F.col("prefix") + nearer.cast("long")).alias("threshold")
    )
    everything = F.lit(1 << (4 * HASH_DIGITS))
    return budgets.join(last, ["source_key", "rung"], "left").select(
        "source_key", "rung", F.coalesce("threshold", everything).alias("threshold")
    )


def plan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    fraction: float = 1.0,
) -> tuple[DataFrame, DataFrame]:
    """(sized rows, one row per source with its target, whole repeats and threshold)."""
    sized = staged(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            source_key(F.col(source_col)).alias("source_key"),
            words(F.col(text_col)).alias("size"),
            row_hash(F.col(id_col), F.col(text_col)).alias("hash"),
        ),
        "sized",
    )
    by_source = staged(targets(sized), "targets")
    wanted = F.col("target") * F.lit(float(fraction))
    fits = F.when(F.col("source_size") > 0, F.floor(wanted / F.col("source_size"))).otherwise(0)
    by_source = by_source.withColumn("repeats", fits.cast("long"))
    budgets = by_source.select(
        "source_key",
        F.lit(0).alias("rung"),
        (wanted - F.col("repeats") * F.col("source_size")).alias("budget"),
    )
    found = thresholds(sized, budgets).drop("rung")
    return sized, staged(by_source.join(found, "source_key"), "plan")


def mix(docs: DataFrame, **columns) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row."""
    sized, by_source = plan(docs, **columns)
    rows = join_keyed(sized.drop("source"), by_source, "source_key", "n_rows", sized.count())
    copies = F.col("repeats") + (F.col("hash") < F.col("threshold")).cast("long")
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"))


def apply_mix(docs: DataFrame, **columns) -> DataFrame:
    """The rows of the mix, each as often as it is taken, with the columns of ``docs``."""
    names = {"id_col": "doc_id", "text_col": "text", "source_col": "source"} | columns
    sized, by_source = plan(docs, **columns)
    taken = set(docs.columns)
    mark = {}
    for c in by_source.columns:
        mark[c] = f"mix_{c}"
        while mark[c] in taken:
            mark[c] += "_"
    keyed = docs.withColumn(mark["source_key"], source_key(F.col(names["source_col"])))
    right = by_source.select(*(F.col(c).alias(m) for c, m in mark.items()))
    rows = join_keyed(keyed, right, mark["source_key"], mark["n_rows"], sized.count())
    below = row_hash(F.col(names["id_col"]), F.col(names["text_col"])) < F.col(mark["threshold"])
    often = (F.col(mark["repeats"]) + below.cast("long")).cast("int")
    return rows.withColumn(mark["repeats"], F.explode(F.array_repeat(F.lit(0), often))).select(docs.columns)


ORACLE_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, length(regexp_replace(regexp_replace(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+', 'w', 'g'), '[^w]', '', 'g')) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, {HASH_DIGITS}) AS BIGINT) AS hash
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         list_extract([5, 2, 1], CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT)) AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT *, 3 * source_size / weight AS ratio,
         CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (
           ORDER BY 3 * source_size / weight, source NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)
         / CAST(sum(weight) OVER (
           ORDER BY 3 * source_size / weight, source NULLS FIRST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS level
  FROM sources
), targets AS (
  SELECT source, source_size,
         CASE WHEN ratio > level THEN weight * max(CASE WHEN ratio > level THEN level END) OVER ()
              ELSE CAST(3 * source_size AS DOUBLE) END AS target
  FROM levels
), budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS repeats FROM targets
), cells AS (
  SELECT source, hash, CAST(sum(size) AS BIGINT) AS cell_size FROM sized GROUP BY source, hash
), sums AS (
  SELECT source, hash, cell_size, CAST(sum(cell_size) OVER (PARTITION BY source ORDER BY hash) AS BIGINT) AS upto FROM cells
), edges AS (
  SELECT s.source, min(s.hash) AS edge, arg_min(s.upto, s.hash) AS upto, arg_min(s.cell_size, s.hash) AS cell_size
  FROM sums s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source
  WHERE s.upto > b.target - b.repeats * b.source_size GROUP BY s.source
)
SELECT d.doc_id, CAST(d.size AS BIGINT) AS size, b.source_size, b.target,
       CAST(d.size * (b.repeats + CASE
         WHEN e.edge IS NULL OR d.hash < e.edge THEN 1
         WHEN d.hash = e.edge AND e.upto - (b.target - b.repeats * b.source_size)
              < (b.target - b.repeats * b.source_size) - (e.upto - e.cell_size) THEN 1
         ELSE 0 END) AS BIGINT) AS taken
FROM sized d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source
LEFT JOIN edges e ON d.source IS NOT DISTINCT FROM e.source
"""
