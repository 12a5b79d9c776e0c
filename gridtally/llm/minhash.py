"""Near-duplicate texts by MinHash signatures, joined over an inverted index.

A text's set holds its distinct five-word shingles. Texts of equal sets form a
class. Each class is posted under every (coordinate, value) pair of its signature.
Pairs that only one class has are skipped, and so is a class that shares fewer than
``MATCHES`` pairs with others: it cannot collide often enough with any. Each class
keeps the prefix of its rarest shared pairs; two classes that agree in ``MATCHES`` of
the ``COORDINATES`` must meet in a pair of both prefixes. Candidates that collide
at least ``MATCHES`` times are confirmed on their full sets.

Lists are merged without listing all pairs of a group. First each class meets the
most central class of each of its lists. What this links becomes components, and a
list within one component is skipped. Classes of the other lists are matched by
their rarest shingles: two sets similar enough have one in common before either has
left more behind than it may lack, so a class whose edits are its own meets nobody.
Pairs of different components that pass must collide often enough as well. All these
rules leave out only pairs that cannot link or that are linked already, so the
components are those of all confirmed pairs. Tables of one row for each list are written
before they are joined with the postings: both sides of such a join are then shuffled,
and adaptive skew handling splits the postings of a hot list.

A pair of similarity 0.75 agrees in fewer than ``MATCHES`` coordinates with a chance
of about one in a hundred thousand.

Defined cases: a text without words, or null, has an empty set and links with
nothing. With fewer than five words the whole sequence is the one shingle. A row
with a null id takes part, but names no component. Repeated rows are copies. An empty
table gives an empty table; other columns are not read; texts are read whole. Sets
hold 64-bit hashes of shingles, classes 128-bit digests of sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.llm.groups import components, join_keyed
from gridtally.llm.tables import settled, ship, staged
from gridtally.llm.words import Scan, mix, text_chunks

WORDS = 5
COORDINATES = 96
MATCHES = 53
_FACTOR = mix(np.arange(1, COORDINATES + 1, dtype=np.uint64)) | np.uint64(1)
_SHIFT = mix(np.arange(1001, COORDINATES + 1001, dtype=np.uint64))


def shingle_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingles of all texts one after another, number by text)."""
    scan = Scan(texts, lower=True)
    hashes = scan.word_hashes()
    words = scan.per_doc(scan.word_doc)
    first, value = scan.runs(hashes, WORDS)
    many = scan.per_doc(scan.word_doc[first])
    ends, word_ends = np.cumsum(many), np.cumsum(words)
    sets = []
    for i in range(len(texts)):
        if many[i]:
            sets.append(np.unique(value[ends[i] - many[i] : ends[i]]))
        elif words[i]:
            whole = np.uint64(words[i])
            for h in hashes[word_ends[i] - words[i] : word_ends[i]]:
                whole = mix(np.array([whole ^ h]))[0]
            sets.append(np.array([whole]))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    return np.concatenate(sets), np.array([len(s) for s in sets])


def signatures(shingles: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One row of coordinates for each set that is not empty."""
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    out = np.empty((len(starts), COORDINATES), dtype=np.uint32)
    for k in range(COORDINATES):
        out[:, k] = np.minimum.reduceat(shingles * _FACTOR[k] + _SHIFT[k], starts) >> np.uint64(32)
    return out


def digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _split(shingles: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    return np.split(shingles, np.cumsum(sizes)[:-1])


def sign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, n_shingles, set_digest, signature) of every row."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches, 2):
            shingles, sizes = shingle_sets(texts)
            some = sizes > 0
            digests = [digest(s) if len(s) else None for s in _split(shingles, sizes)]
            ends = np.concatenate(([0], np.cumsum(some * COORDINATES)))
            values = signatures(shingles, sizes).view(np.int32).ravel()
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), lists],
                names=["doc_id", "text_hash", "n_shingles", "set_digest", "signature"],
            )

    return rows.mapInArrow(
        run, f"doc_id {kind}, text_hash bigint, n_shingles bigint, set_digest binary, signature array<int>"
    )


def _full_sets(docs: DataFrame, classes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, shingles) of the classes, from one text of each."""
    of = classes.select("node", "least_doc", "lead_hash", "set_digest")
    # By id and text: an id, or a missing one, may stand for many texts.
    rows = docs.select(
        F.col(id_col).alias("text_id"), F.xxhash64(text_col).alias("full_hash"), F.col(text_col).alias("full_text")
    ).join(of, F.col("text_id").eqNullSafe(F.col("least_doc")) & (F.col("full_hash") == F.col("lead_hash")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches, 2):
            shingles, sizes = shingle_sets(texts)
            # Two texts of one id may share a hash; the digest tells which one is meant.
            wanted = batch.column(1).to_pylist()
            parts = _split(shingles, sizes)
            good = [i for i, s in enumerate(parts) if len(s) and digest(s) == wanted[i]]
            ends = np.concatenate(([0], np.cumsum([len(parts[i]) for i in good]))).astype(np.int32)
            values = np.concatenate([parts[i] for i in good] or [shingles[:0]]).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(good, pa.int64())), lists], names=["node", "shingles"]
            )

    return (
        rows.select("node", "set_digest", "full_text")
        .mapInArrow(run, "node bigint, shingles array<bigint>")
        .dropDuplicates(["node"])
    )


def _confirm(pairs: DataFrame, posted: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that collide often enough and whose full sets are similar."""
    of = posted.select(F.col("node"), F.col("signature"))
    both = pairs.join(of.select(F.col("node").alias("a"), F.col("signature").alias("of_a")), "a").join(
        of.select(F.col("node").alias("b"), F.col("signature").alias("of_b")), "b"
    )
    equal = F.zip_with("of_a", "of_b", lambda x, y: (x == y).cast("int"))
    close = both.filter(F.aggregate(equal, F.lit(0), lambda s, x: s + x) >= MATCHES).select("a", "b")
    full = close.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b")), "b"
    )
    common = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - common
    return full.filter(100 * common >= 75 * union).select("a", "b")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _post(classes: DataFrame) -> DataFrame:
    """(node, n, signature, weight, prefix) of the classes that may collide often enough.

    ``weight`` is the number of postings in the lists of a class: a class in the
    middle of a group has the most. ``prefix`` holds the keys of its rarest lists.
    """
    postings = classes.select("node", F.posexplode("signature").alias("place", "value")).select(
        "node",
        F.shiftleft(F.col("place").cast("long"), 32)
        .bitwiseOR(F.col("value").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
        .alias("key"),
    )
    lists = staged(postings.groupBy("key").agg(F.count("*").alias("size")).filter(F.col("size") > 1), "lists")
    shared = (
        postings.join(lists, "key")
        .groupBy("node")
        .agg(
            F.sum("size").alias("weight"),
            F.sort_array(F.collect_list(F.struct("size", "key"))).alias("lists"),
        )
        .filter(F.size("lists") >= MATCHES)
    )
    prefix = F.expr(f"transform(slice(lists, 1, size(lists) - {MATCHES} + 1), x -> x.key)")
    return shared.select("node", "weight", prefix.alias("prefix")).join(
        classes.select("node", "n", "signature"), "node"
    )


def _links(
    docs: DataFrame, classes: DataFrame, posted: DataFrame, id_col: str, text_col: str
) -> DataFrame:
    """Confirmed pairs (a, b) of classes that connect all that are connected."""
    sets = staged(
        _full_sets(docs, classes.join(posted.select("node"), "node", "left_semi"), id_col, text_col),
        "sets",
    )
    listed = staged(posted.select("node", "n", "weight", F.explode("prefix").alias("key")), "listed")
    # Each class with the most central class of each of its lists.
    center = listed.groupBy("key").agg(
        F.max(F.struct("weight", "node")).alias("center"), F.count("*").alias("size")
    )
    center = staged(center.filter(F.col("size") > 1), "center")
    star = (
        listed.join(center, "key")
        .select(F.col("node").alias("a"), F.col("center.node").alias("b"))
        .filter(F.col("a") != F.col("b"))
    )
    first = staged(_confirm(_ordered(star), posted, sets), "star")
    named = settled(
        docs.sparkSession,
        "merged",
        lambda: posted.select("node")
        .join(components(first), "node", "left")
        .select("node", F.coalesce("component", "node").alias("component")),
    )
    # What a class shares with classes of lists that are open, rarest shingles first.
    open_nodes = _open(listed, named).select("node").distinct()
    shingles = sets.join(open_nodes, "node", "left_semi").select(
        "node", F.size("shingles").alias("n"), F.explode("shingles").alias("key")
    )
    common = staged(shingles.groupBy("key").agg(F.count("*").alias("size")).filter(F.col("size") > 1), "common")
    alone = F.col("n") - F.size("shared")
    # Before its first shingle in common with a similar class lies a quarter of a set at most.
    prefix = F.expr("slice(shared, 1, greatest(0, int(n / 4) + 1 - (n - size(shared))))")
    rare = (
        shingles.join(common, "key")
        .groupBy("node", "n")
        .agg(F.sort_array(F.collect_list(F.struct("size", "key"))).alias("shared"))
        .select("node", "n", alone.alias("alone"), F.posexplode(prefix).alias("place", "of"))
        .select("node", "n", (F.col("alone") + F.col("place")).alias("place"), F.col("of.key").alias("key"))
    )
    rare = staged(_open(staged(rare, "rare"), named), "open")
    left, right = rare.filter(F.col("component") != F.col("largest")).alias("x"), rare.alias("y")
    least = 3 * (F.col("x.n") + F.col("y.n"))
    rest = left.join(
        right,
        (F.col("x.key") == F.col("y.key"))
        & (F.col("x.component") != F.col("y.component"))
        & (7 * (F.col("x.n") - F.col("x.place")) >= least)
        & (7 * (F.col("y.n") - F.col("y.place")) >= least),
    ).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    return first.union(_confirm(_ordered(rest), posted, sets))


def _open(listed: DataFrame, named: DataFrame) -> DataFrame:
    """The rows of lists with several components, with the largest component of the list.

    Members of the largest one need not meet each other.
    """
    member = listed.join(named, "node")
    split = (
        member.groupBy("key", "component")
        .agg(F.count("*").alias("size"))
        .groupBy("key")
        .agg(F.max(F.struct("size", "component")).alias("most"), F.count("*").alias("parts"))
        .filter(F.col("parts") > 1)
        .select("key", F.col("most.component").alias("largest"))
    )
    split = staged(split, "split")
    return member.join(split, "key")


def _least_docs(component: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, component_id): the least id of a component's texts."""
    member = component.join(classes.select("node", "least_doc"), "node")
    least = member.groupBy("component").agg(F.min("least_doc").alias("component_id"))
    return component.join(least, "component").select("node", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, kept) of every row."""
    signed = staged(sign(docs, id_col, text_col), "signed")
    total = signed.count()
    classes = staged(
        signed.filter(F.col("n_shingles") > 0)
        .groupBy("set_digest")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("lead"),
            F.min("n_shingles").alias("n"),
            F.count("*").alias("n_docs"),
            F.min("signature").alias("signature"),
        )
        .select(
            "set_digest",
            F.col("lead.doc_id").alias("least_doc"),
            F.col("lead.text_hash").alias("lead_hash"),
            "n",
            "n_docs",
            "signature",
        )
        # Fixed once written.
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    spark = docs.sparkSession
    posted = settled(spark, "posted", lambda: _post(classes))
    links = settled(spark, "links", lambda: _links(docs, classes, posted, id_col, text_col))
    named = settled(
        spark,
        "named",
        lambda: classes.join(_least_docs(components(links), classes), "node", "left").select(
            "set_digest", "n_docs", F.coalesce("component_id", "least_doc").alias("component_id")
        ),
    )
    rows = signed.select("doc_id", "text_hash", "n_shingles", "set_digest")
    full = join_keyed(rows.filter(F.col("n_shingles") > 0), named, "set_digest", "n_docs", total)
    bare = rows.filter(F.col("n_shingles") == 0).withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "text_hash", "n_shingles", "component_id"]
    return (
        full.select(columns)
        .unionByName(bare.select(columns))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


ORACLE_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS shingles
  FROM words
), posts AS (
  SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM posts a JOIN posts b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach AS (
  SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), least_ids AS (
  SELECT x, min(y) AS y FROM reach GROUP BY x
)
SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, least(doc_id, coalesce(y, doc_id)) AS component_id,
       doc_id = least(doc_id, coalesce(y, doc_id)) AS kept
FROM sets LEFT JOIN least_ids ON x = doc_id
"""
