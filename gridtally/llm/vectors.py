"""Near-duplicate vectors by cross-polytope hashing.

Vectors are compared only if their labels are equal. Each distinct vector is
normalised, padded to a power of two and turned by pseudo-random rotations: three
rounds of random signs and a fast Hadamard transform. The hash of a rotated vector is
the signed axis nearest to it; ``AXES`` rotations make a bucket of one of ``TABLES``
tables. Each vector is also posted under the ``PROBES`` buckets next in likelihood, in
which one axis is replaced by its runner-up of the least loss.

Two vectors meet in the first bucket, by table and number, that both are posted in,
however many others are in it: what links two vectors depends on these two alone. Buckets
are split in blocks by hash, and each pair of blocks is a group of its own: up
to ``COPIES`` blocks of ``BLOCK`` vectors or more, beyond ``COPIES * WIDEST`` vectors
blocks of ``WIDEST``. No task holds more than two blocks, however large a bucket is.
There, candidate pairs are verified by their cosine in double precision. A group
returns the links of each vector as a count, and a forest that connects what is linked,
not the pairs. The pairs of a bucket grow with the square of its vectors; they are dealt
to as many tasks as there are pairs of blocks.

On demand only, ``links`` parts buckets of more than ``crowded`` vectors by ``PART_AXES``
further axes of rotations of their table, again with probes, if that at least halves the
pairs to compare. Pairs whose vectors fall into different parts are then lost, the more
crowded the buckets are, so ``near_duplicates`` never asks for it.

Vectors that are equal form one row with a count before all this. With the settings
below a pair at the very bound is missed with a chance of about one in fifty thousand,
and of about one in 1,800 if all its buckets are parted; the tests measure the
recall against brute force.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components link with nothing, and so do vectors without a label or of different
lengths. A null id names no component. Repeated rows are vectors of their own that
link with each other. An empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally.llm.groups import components, join_keyed
from gridtally.llm.tables import ship, slices, staged
from gridtally.llm.words import mix

COSINE = 0.98
TABLES = 6
AXES = 3
PROBES = 2  # at most PART_AXES
#: Buckets of one table that a vector is posted in.
WAYS = 1 + PROBES
BLOCK = 1024
WIDEST = 4096
#: A vector of a bucket of COPIES * WIDEST vectors or less is sent at most so many times.
COPIES = 8
PART_AXES = 3
#: Rows that are multiplied with a block at a time.
TILE = 512
#: Groups of at most so many vectors are compared together, not one by one.
SMALL = 32
#: Pairs whose first common bucket is looked up at a time.
PAIRS = 100_000
ROUNDS = 3
SEED = 20_240_101


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of the rows, scaled to keep lengths."""
    n, width = x.shape
    half = 1
    while half < width:
        x = x.reshape(n, width // (2 * half), 2, half)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, width)
        half *= 2
    return x / np.sqrt(width)


def rotated(x: np.ndarray, number: int) -> np.ndarray:
    """The rows, padded to a power of two, under one pseudo-random rotation."""
    width = 1 << max(1, int(x.shape[1] - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, width - x.shape[1])))
    for turn in range(ROUNDS):
        seed = np.uint64(SEED + (number * ROUNDS + turn) * width)
        bits = mix(np.arange(width, dtype=np.uint64) + seed) >> np.uint64(63)
        x = hadamard(x * np.where(bits == 1, 1.0, -1.0))
    return x


def table_codes(x: np.ndarray, first: int, axes: int, salt: int) -> list[np.ndarray]:
    """The bucket of every row by ``axes`` rotations from ``first`` on, then its probes."""
    rows = np.arange(len(x))
    best, next_best, loss = [], [], []
    for axis in range(axes):
        y = rotated(x, first + axis)
        size = np.abs(y)
        order = np.argsort(-size, axis=1, kind="stable")[:, :2]
        for k, out in ((0, best), (1, next_best)):
            at = order[:, k]
            out.append(2 * at + (y[rows, at] < 0))
        loss.append(size[rows, order[:, 0]] - size[rows, order[:, 1]])
    loss_order = np.argsort(np.stack(loss, axis=1), axis=1, kind="stable")
    found = []
    for probe in range(1 + PROBES):
        value = np.full(len(x), salt, dtype=np.uint64)
        for axis in range(axes):
            code = best[axis]
            if probe:
                code = np.where(loss_order[:, probe - 1] == axis, next_best[axis], code)
            value = mix(value * np.uint64(1 << 20) + code.astype(np.uint64))
        found.append(value)
    return found


def buckets(x: np.ndarray) -> np.ndarray:
    """(rows, TABLES * WAYS) bucket numbers; different tables have different ones."""
    found = [c for t in range(TABLES) for c in table_codes(x, t * AXES, AXES, t + 1)]
    return (np.stack(found, axis=1) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def parts(x: np.ndarray) -> np.ndarray:
    """(rows, TABLES * WAYS) part numbers, from nothing up, by rotations that no bucket uses."""
    first = TABLES * AXES
    found = [
        c for t in range(TABLES) for c in table_codes(x, first + t * PART_AXES, PART_AXES, TABLES + t + 1)
    ]
    return (np.stack(found, axis=1) >> np.uint64(33)).astype(np.int32)


def _matrix(lists: pa.Array) -> np.ndarray:
    """Lists of one length as rows."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(lists), -1)


def _filled(lists: pa.ChunkedArray, empty: int | bool) -> np.ndarray:
    """Lists of TABLES * WAYS values as rows; empty ones give rows of ``empty``."""
    lists = lists.combine_chunks()
    found = np.full((len(lists), TABLES * WAYS), empty)
    full = lists.value_lengths().to_numpy(zero_copy_only=False) > 0
    found[full] = lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, TABLES * WAYS)
    return found


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaling by the largest component first keeps squares finite."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _may_link(label: Column, vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = label.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)
    return F.coalesce(good, F.lit(False))


def distinct_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(label, vector, least_id, n, node) of the vectors that may link."""
    return (
        vectors.select(
            F.col(id_col).alias("vec_id"),
            F.col(label_col).alias("label"),
            F.col(vector_col).alias("vector"),
        )
        .filter(_may_link(F.col("label"), F.col("vector")))
        .groupBy("label", "vector")
        .agg(F.min("vec_id").alias("least_id"), F.count("*").alias("n"))
        .withColumn("node", F.monotonically_increasing_id())
    )


def _coded(rows: DataFrame, codes: Callable[[np.ndarray], np.ndarray], name: str) -> DataFrame:
    """``rows`` with the array ``codes`` gives for their unit vectors; reads width and vector."""
    ship(rows.sparkSession)
    width_at, vector_at = rows.columns.index("width"), rows.columns.index("vector")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            width = batch.column(width_at).to_numpy(zero_copy_only=False)
            for w in np.unique(width):
                part = batch.filter(pa.array(width == w))
                found = codes(_unit(_matrix(part.column(vector_at))))
                ends = pa.array(np.arange(len(found) + 1, dtype=np.int32) * found.shape[1])
                lists = pa.ListArray.from_arrays(ends, pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*part.schema.names, name])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{fields}, {name} array<int>")


def post(nodes: DataFrame) -> DataFrame:
    """(node, label, n, width, vector, codes, parted, parts): the bucket numbers of every vector.

    ``parted`` tells which of them are parted, and ``parts`` holds the part numbers by
    table; both are empty until ``part`` fills them.
    """
    rows = nodes.select("node", "label", "n", F.size("vector").alias("width"), "vector")
    return _coded(rows, buckets, "codes").withColumns(
        {"parted": F.array().cast("array<boolean>"), "parts": F.array().cast("array<int>")}
    )


def memberships(posted: DataFrame) -> DataFrame:
    """(node, bucket): the buckets, or parts of parted ones, that every vector is posted in."""

    def of_code(code: Column, i: Column) -> Column:
        own = F.slice("parts", (F.floor(i / WAYS) * WAYS + 1).cast("int"), F.lit(WAYS))
        own = F.when(F.get("parted", i), own).otherwise(F.array(F.lit(-1)))
        return F.transform(own, lambda p: F.struct("label", "width", code.alias("code"), p.alias("part")))

    every = F.array_distinct(F.flatten(F.transform("codes", of_code)))
    return posted.select("node", F.explode(every).alias("bucket"))


def part(posted: DataFrame, large: DataFrame, total: int) -> DataFrame:
    """``posted`` with ``parted`` and ``parts`` for the buckets of ``large`` that parting helps."""
    members = staged(
        join_keyed(memberships(posted), large, "bucket", "in_bucket", total)
        .select("node", "bucket", "in_bucket"),
        "large-members",
    )
    rows = posted.select("node", "width", "vector", "codes").join(
        members.select("node").distinct(), "node", "left_semi"
    )
    finer = staged(_coded(rows, parts, "parts").select("node", "codes", "parts"), "parts")
    at = F.array_position("codes", F.col("bucket.code")) - 1
    own = F.slice("parts", (F.floor(at / WAYS) * WAYS + 1).cast("int"), F.lit(WAYS))
    sizes = (
        members.join(finer, "node")
        .select("bucket", "in_bucket", F.explode(F.array_distinct(own)).alias("part"))
        .groupBy("bucket", "in_bucket", "part")
        .agg(F.count("*").cast("double").alias("in_part"))
        .groupBy("bucket", "in_bucket")
        .agg(F.sum(F.col("in_part") * F.col("in_part")).alias("pairs"))
    )
    helped = sizes.filter(2 * F.col("pairs") <= F.col("in_bucket").cast("double") * F.col("in_bucket"))
    helped = staged(helped.select("bucket", "in_bucket"), "parted")
    chosen = (
        join_keyed(members.select("node", "bucket"), helped, "bucket", "in_bucket", total)
        .groupBy("node")
        .agg(F.collect_set("bucket.code").alias("chosen"))  # at most TABLES * WAYS
        .join(finer.select("node", "parts"), "node")
    )
    parted = F.transform("codes", lambda code: F.array_contains("chosen", code))
    return (
        posted.drop("parted", "parts")
        .join(chosen, "node", "left")
        .withColumns(
            {
                "parted": F.when(F.col("chosen").isNull(), F.array().cast("array<boolean>")).otherwise(parted),
                "parts": F.coalesce("parts", F.array().cast("array<int>")),
            }
        )
        .drop("chosen")
    )


def first_common(
    a: np.ndarray,
    b: np.ndarray,
    parted: np.ndarray | None = None,
    part_a: np.ndarray | None = None,
    part_b: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """The first bucket, by table and number, of each pair of rows, and its least common
    part, -1 if it is not parted; without a common one the bucket is ``1 << 40``.

    ``parted`` tells which codes of ``a`` are parted, the parts are given by table.
    """
    n = len(a)
    a, b = a.reshape(n, TABLES, WAYS), b.reshape(n, TABLES, WAYS)
    shared = (a[:, :, :, None] == b[:, :, None, :]).any(axis=3)
    if parted is not None:
        part_a, part_b = part_a.reshape(n, TABLES, WAYS), part_b.reshape(n, TABLES, WAYS)
        same = (part_a[:, :, :, None] == part_b[:, :, None, :]).any(axis=3)
        least = np.where(same, part_a.astype(np.int64), 1 << 40).min(axis=2)
        parted = parted.reshape(n, TABLES, WAYS)
        shared &= ~parted | (least < 1 << 40)[:, :, None]
    found = shared.any(axis=2)
    rows, table = np.arange(n), found.argmax(axis=1)
    codes = np.where(shared[rows, table], a[rows, table].astype(np.int64), 1 << 40)
    at = codes.argmin(axis=1)
    part_number = np.full(n, -1, dtype=np.int64)
    if parted is not None:
        part_number = np.where(parted[rows, table, at], least[rows, table], -1)
    return codes[rows, at], part_number


def forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` items the least item that the pairs connect it with."""
    root = np.arange(n)
    while True:
        new = root.copy()
        np.minimum.at(new, i, root[j])
        np.minimum.at(new, j, root[i])
        new = new[new]
        if (new == root).all():
            return root
        root = new


def group_pairs(group: np.ndarray, own: np.ndarray, split: np.ndarray, x: np.ndarray, least: float):
    """Pairs of rows, in pieces, that meet in a group and whose product reaches ``least``.

    ``group`` is sorted. Rows of a split group meet only those of the other block.
    """
    starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(group)])))
    small = (sizes <= SMALL) & ~split[starts]
    in_small = np.repeat(small, sizes)
    for step in range(1, min(SMALL, len(group))):
        i = np.flatnonzero(in_small[:-step] & (group[:-step] == group[step:]))
        if not len(i):
            break
        i = i[np.einsum("ij,ij->i", x[i], x[i + step]) >= least]
        yield i, i + step
    for start, size in zip(starts[~small], sizes[~small]):
        rows = np.arange(start, start + size)
        left, right = rows, rows
        if split[start]:
            first = own[rows].min()
            left, right = rows[own[rows] == first], rows[own[rows] != first]
        for k in range(0, len(left), TILE):
            some, others = left[k : k + TILE], right if split[start] else right[k:]
            i, j = np.nonzero(x[some] @ x[others].T >= least)
            i, j = some[i], others[j]
            if not split[start]:
                i, j = i[i < j], j[i < j]
            yield i, j


def block_count(in_bucket: Column, block: int = BLOCK) -> Column:
    """Blocks of a bucket, and so the times each of its vectors is sent."""
    few = F.least(F.lit(COPIES), F.ceil(in_bucket / block))
    return F.greatest(few, F.ceil(in_bucket / (block * (WIDEST // BLOCK)))).cast("int")


def meetings(
    posted: DataFrame, crowded: int | None = None, block: int = BLOCK
) -> tuple[DataFrame, DataFrame]:
    """(node, bucket, own, low, high) of every block pair that a vector goes to, and ``posted``
    with the parts of the buckets of more than ``crowded`` vectors; None parts no bucket."""

    def counted(rows: DataFrame) -> DataFrame:
        found = memberships(rows).groupBy("bucket").agg(F.count("*").alias("in_bucket"))
        return staged(found.filter(F.col("in_bucket") > 1), "crowded")

    total = posted.agg(F.coalesce(F.sum(F.size("codes")), F.lit(0))).first()[0]
    full = counted(posted)
    large = None if crowded is None else full.filter(F.col("in_bucket") > crowded)
    if large is not None and not large.isEmpty():
        posted = staged(part(posted, large, total), "codes-parted")
        full = counted(posted)
    # A block of a bucket meets itself and every other block once.
    members = (
        join_keyed(memberships(posted), full, "bucket", "in_bucket", total)
        .withColumn("blocks", block_count(F.col("in_bucket"), block))
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("node", "bucket", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    )
    return members, posted


def links(
    posted: DataFrame, cosine: float = COSINE, crowded: int | None = None, block: int = BLOCK
) -> DataFrame:
    """Rows (node, n, other): ``n`` more links of a node, counting equal vectors, or a
    link to ``other`` in the forest of a group. With ``crowded`` some links of larger buckets are lost."""
    ship(posted.sparkSession)
    members, posted = meetings(posted, crowded, block)
    members = members.join(posted.select("node", "n", "vector", "codes", "parted", "parts"), "node")
    bucket = [F.col("bucket").getField(c).cast("string") for c in ("label", "width", "code", "part")]
    meeting = F.concat_ws("|", *bucket, "low", "high").alias("meeting")
    rows = (
        members.select(
            meeting,
            F.col("bucket.code").alias("code"),
            F.col("bucket.part").alias("part"),
            F.col("bucket.width").alias("width"),
            "own",
            (F.col("low") != F.col("high")).alias("split"),
            "node",
            "n",
            "vector",
            "codes",
            "parted",
            "parts",
        )
        .repartition("meeting")
        .sortWithinPartitions("meeting", "node")
    )

    def found(table: pa.Table) -> Iterator[pa.RecordBatch]:
        width = table["width"].to_numpy()
        for w in np.unique(width):
            here = table.filter(pa.array(width == w)).combine_chunks()
            x = _unit(_matrix(here["vector"].combine_chunks()))
            group = here["meeting"].combine_chunks().dictionary_encode().indices.to_numpy()
            code, part_no, node, weight = (here[c].to_numpy() for c in ("code", "part", "node", "n"))
            own, split = here["own"].to_numpy(), here["split"].to_numpy()
            posts = _filled(here["codes"], 0)
            parted, own_parts = _filled(here["parted"], False), _filled(here["parts"], -1)
            count = np.zeros(len(x), dtype=np.int64)
            ends = []
            for i, j in group_pairs(group, own, split, x, cosine):
                for k in range(0, len(i), PAIRS):
                    a, b = i[k : k + PAIRS], j[k : k + PAIRS]
                    if parted[a].any():
                        first, number = first_common(posts[a], posts[b], parted[a], own_parts[a], own_parts[b])
                    else:
                        first, number = first_common(posts[a], posts[b])
                    first_met = (first == code[a]) & (number == part_no[a])
                    a, b = a[first_met], b[first_met]
                    np.add.at(count, a, weight[b])
                    np.add.at(count, b, weight[a])
                    root = forest(a, b, len(x))
                    tied = np.flatnonzero(root != np.arange(len(x)))
                    ends.append((node[tied], node[root[tied]]))
            linked = np.flatnonzero(count)
            a = np.concatenate([node[:0], *(e[0] for e in ends)])
            b = np.concatenate([node[:0], *(e[1] for e in ends)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([node[linked], a]), pa.int64()),
                    pa.array(np.concatenate([count[linked], np.zeros(len(a), dtype=np.int64)]), pa.int64()),
                    pa.concat_arrays([pa.nulls(len(linked), pa.int64()), pa.array(b, pa.int64())]),
                ],
                names=["node", "n", "other"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []  # rows of the meeting that may go on
        for batch in slices(batches, 4096):
            last = batch.column(0)[-1].as_py()
            cut = batch.column(0).index(pa.scalar(last)).as_py()
            if cut or waiting and waiting[-1].column(0)[-1].as_py() != last:
                yield from found(pa.Table.from_batches([*waiting, batch.slice(0, cut)]))
                waiting = []
            waiting.append(batch.slice(cut))
        if waiting:
            yield from found(pa.Table.from_batches(waiting))

    return rows.mapInArrow(run, "node bigint, n bigint, other bigint")


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    cosine: float = COSINE,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    nodes = staged(distinct_vectors(vectors, id_col, vector_col, label_col), "vectors")
    posted = staged(post(nodes), "codes")
    found = staged(links(posted, cosine), "links")
    linked = found.groupBy("node").agg(F.sum("n").alias("n_others"))
    tied = found.filter(F.col("other").isNotNull())
    component = components(tied.select(F.col("node").alias("a"), F.col("other").alias("b")))
    least = component.join(nodes.select("node", "least_id"), "node")
    least = least.groupBy("component").agg(F.min("least_id").alias("component_least"))
    named = (
        nodes.join(component.join(least, "component"), "node", "left")
        .join(linked, "node", "left")
        .select(
            F.struct("label", "vector").alias("key"),
            "n",
            (F.coalesce("n_others", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component_least", "least_id").alias("component_id"),
        )
    )
    named = staged(named, "named")
    rows = vectors.select(
        F.col(id_col).alias("vec_id"),
        F.struct(F.col(label_col).alias("label"), F.col(vector_col).alias("vector")).alias("key"),
    )
    may_link = _may_link(F.col("key.label"), F.col("key.vector"))
    full = join_keyed(rows.filter(may_link), named, "key", "n", vectors.count())
    bare = rows.filter(~may_link).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return (
        full.select("vec_id", "n_links", "component_id")
        .unionByName(bare)
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )


ORACLE_SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len([e FOR e IN embedding IF e IS NULL OR NOT isfinite(e)]) = 0
    AND len([e FOR e IN embedding IF e <> 0]) > 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b
  ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reach AS (
  SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), found AS (
  SELECT x, min(y) AS y FROM reach GROUP BY x
), counts AS (
  SELECT x, count(*) AS n FROM links GROUP BY x
)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(f.y, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(f.y, vec_id)) AS kept
FROM embeddings LEFT JOIN found f ON f.x = vec_id LEFT JOIN counts c ON c.x = vec_id
"""
