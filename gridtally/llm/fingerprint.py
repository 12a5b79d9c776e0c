"""Threshold-scaled sketches of documents.

A text's shingles are its runs of five words, ASCII letters in lower case; a text with
fewer words is one shingle. Every shingle has a 63-bit hash, and a sketch retains each
hash below a fixed fraction of all, ``1 / ONE_IN``, whatever the text's length. So the
sketch of a union is the union of the sketches, and the share of a small text's hashes
that a large text has too estimates how much of the one the other contains. A text
that has no hash below the threshold retains its least one, so that short texts can be
told apart; a union keeps such a hash only if it has none below the threshold either.

``sketches`` gives the sketch of every row, ``likeness`` and ``containment`` compare two
sketches, ``merged`` sums them up by group and ``contained_in`` looks documents up
in groups. ``successors`` meets every text with the one that follows it by descending
id: sorted ranges of the ids are one task each, and the first text of each range is
also sent to the range before it. Rows that repeat id and text very often follow
themselves; they are dealt out in blocks without being sorted.

Defined cases: a null text counts as empty. A text without words has the empty sketch,
which is like another empty one only and contained in any. Rows with a null id come
last; equal ids are ordered by a hash of the text. Repeated rows stay. An empty table
gives an empty table, other columns are not read. Texts are read whole, long ones in
pieces.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally.llm.groups import HOT_SHARE
from gridtally.llm.tables import ship, slices, staged
from gridtally.llm.words import CHUNK_BYTES, WHITE, Scan, mix, text_chunks

SHINGLE = 5
ONE_IN = 8
#: Copies of a row that one task repeats.
BLOCK = 10_000
#: Rows of a range, at least, and sampled ids by range.
CELL_ROWS = 1000
SAMPLE_KEYS = 100


def threshold(one_in: int = ONE_IN) -> int:
    return (1 << 63) // one_in


def _retained(value: np.ndarray, one_in: int) -> np.ndarray:
    """The sketch of some hashes: those below the threshold, else the least."""
    below = value[value < threshold(one_in)]
    return np.unique(below) if len(below) or not len(value) else value.min(keepdims=True)


def _whole(hashes: np.ndarray) -> np.ndarray:
    """The one shingle of fewer words than a shingle has."""
    if not len(hashes):
        return np.zeros(0, dtype=np.int64)
    value = mix(np.array([len(hashes)], dtype=np.uint64))
    for h in hashes:
        value = mix(value ^ h)
    return (value >> np.uint64(1)).astype(np.int64)


def _pieces(text: bytes, size: int) -> Iterator[bytes]:
    """The text in pieces of about ``size`` bytes that break no word."""
    start = 0
    while start < len(text):
        stop = start + size
        while stop < len(text) and not (WHITE[text[stop - 1]] or WHITE[text[stop]]):
            stop += 1
        yield text[start:stop]
        start = stop


def _long_sketch(text: bytes, one_in: int, size: int) -> np.ndarray:
    found, last = [], np.zeros(0, dtype=np.uint64)
    n_words = 0
    for piece in _pieces(text, size):
        words = Scan([piece], lower=True).word_hashes()
        n_words += len(words)
        last = np.concatenate((last, words))
        found.append(_retained(_shingles(last), one_in))
        last = last[-(SHINGLE - 1) :]
    return _whole(last) if n_words < SHINGLE else _retained(np.concatenate(found), one_in)


def _shingles(words: np.ndarray) -> np.ndarray:
    """The hashes of all runs of ``SHINGLE`` words."""
    n = len(words) - SHINGLE + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    value = np.zeros(n, dtype=np.uint64)
    for i in range(SHINGLE):
        value = mix(value ^ words[i : i + n])
    return (value >> np.uint64(1)).astype(np.int64)


def sketch_texts(texts: list[bytes], one_in: int = ONE_IN, size: int = CHUNK_BYTES) -> list[np.ndarray]:
    """The sorted hashes that each text's sketch retains."""
    if len(texts) == 1 and len(texts[0]) > size:
        return [_long_sketch(texts[0], one_in, size)]
    scan = Scan(texts, lower=True)
    words = scan.word_hashes()
    value = _shingles(words)
    end = np.cumsum(scan.per_doc(scan.word_doc))
    out, start = [], 0
    for stop in end.tolist():
        if stop - start < SHINGLE:
            out.append(_whole(words[start:stop]))
        else:
            out.append(_retained(value[start : stop - SHINGLE + 1], one_in))
        start = stop
    return out


def _chunked(texts: list[bytes], one_in: int) -> list[np.ndarray]:
    """``sketch_texts`` for any number of bytes, about ``CHUNK_BYTES`` at a time."""
    out, start, held = [], 0, 0
    for i, text in enumerate(texts):
        if i > start and held + len(text) > CHUNK_BYTES:
            out += sketch_texts(texts[start:i], one_in)
            start, held = i, 0
        held += len(text)
    return out + (sketch_texts(texts[start:], one_in) if start < len(texts) else [])


def _lists(sketches: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(s) for s in sketches]))).astype(np.int32)
    values = np.concatenate([np.zeros(0, dtype=np.int64), *sketches])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int64()))


def sketches(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", one_in: int = ONE_IN
) -> DataFrame:
    """(doc_id, sketch) of every row; no shuffle."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches, 1):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _lists(sketch_texts(texts, one_in))], names=["doc_id", "sketch"]
            )

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, sketch array<bigint>"
    )


def likeness(a: Column, b: Column) -> Column:
    """The share of common shingles of two texts, 0 to 1, from their sketches."""
    either = F.size(F.array_union(a, b))
    return F.when(either == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / either)


def containment(a: Column, b: Column, one_in: int = ONE_IN) -> Column:
    """The share of the shingles of ``a`` that ``b`` has too, from their sketches.

    Null if ``a`` retains no hash below the threshold and differs from ``b``: then the
    sketch of ``b`` does not tell.
    """
    share = F.size(F.array_intersect(a, b)) / F.size(a)
    return F.when((F.size(a) == 0) | (a == b), 1.0).when(F.array_min(a) < threshold(one_in), share)


def as_text(sketch: Column) -> Column:
    """The hashes in 16 hexadecimal digits each."""
    return F.concat_ws("", F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")))


def merged(rows: DataFrame, by: str, sketch_col: str = "sketch", one_in: int = ONE_IN) -> DataFrame:
    """(group, hash): the sketch of each group's texts together, one row for each hash.

    A large group's sketch is as large as its texts, so it is never gathered in a row.
    """
    hashes = rows.select(F.col(by).alias("group"), F.explode(sketch_col).alias("hash")).distinct()
    least = hashes.groupBy("group").agg(F.min("hash").alias("hash"))
    above = least.filter(F.col("hash") >= threshold(one_in))
    return hashes.filter(F.col("hash") < threshold(one_in)).unionByName(above)


def contained_in(rows: DataFrame, groups: DataFrame, one_in: int = ONE_IN) -> DataFrame:
    """(doc_id, group, containment) of each document in each group it shares a hash with.

    ``rows`` are sketches, ``groups`` comes from ``merged``. Documents without a hash below the
    threshold are left to ``containment``.
    """
    below = F.filter("sketch", lambda h: h < threshold(one_in))
    own = rows.select("doc_id", F.monotonically_increasing_id().alias("row"), below.alias("sketch"))
    hashes = own.select("doc_id", "row", F.size("sketch").alias("size"), F.explode("sketch").alias("hash"))
    met = hashes.join(groups, "hash").groupBy("row", "doc_id", "group", "size").agg(F.count("*").alias("common"))
    return met.select("doc_id", "group", (F.col("common") / F.col("size")).alias("containment"))


def _key(doc_id: object, text_hash: int) -> tuple:
    return doc_id is not None, 0 if doc_id is None else doc_id, text_hash


def _ranges(tally: DataFrame, total: int) -> tuple[list[tuple], dict[tuple, int]]:
    """(lowest keys of all ranges but the last, range that also gets the rows of a key).

    Ranges go by descending keys. The driver holds a sample and one key of each range.
    """
    parts = int(tally.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = max(1, min(parts, -(-total // CELL_ROWS)))
    bounds: list[tuple] = []
    if cells > 1:
        rate = min(1.0, SAMPLE_KEYS * cells / total)
        sample = sorted({_key(*r) for r in tally.select("doc_id", "text_hash").sample(rate, 0).collect()})
        bounds = sorted({sample[i * len(sample) // cells] for i in range(1, cells)} if sample else ())

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keys = zip(*(c.to_pylist() for c in batch.columns))
            cell = [_cell_of(bounds, _key(*r)) for r in keys]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell, pa.int32()), *batch.columns], names=["cell", "doc_id", "text_hash"]
            )

    kind = tally.schema["doc_id"].dataType.simpleString()
    first = F.max(F.struct("doc_id", "text_hash")).alias("first")
    found = (
        tally.select("doc_id", "text_hash")
        .mapInArrow(place, f"cell int, doc_id {kind}, text_hash bigint")
        .groupBy("cell")
        .agg(first)
        .orderBy("cell")
        .collect()
    )
    guests = {_key(*after["first"]): before["cell"] for before, after in zip(found, found[1:])}
    if found:
        guests[_key(*found[0]["first"])] = found[-1]["cell"]
    return bounds, guests


def _cell_of(bounds: list[tuple], key: tuple) -> int:
    return len(bounds) - bisect_right(bounds, key)


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as much of the beginning of the next."""
    last = len(text) // 3
    return text[: len(text) - last] + following[:last]


def _compared(rows: list[tuple], kind: pa.DataType, one_in: int) -> pa.RecordBatch:
    """Sketches of (id, text, next text, times) rows; equal texts are sketched once."""
    changed = [edited(text, after) for _, text, after, _ in rows]
    number = {t: i for i, t in enumerate(dict.fromkeys(t for r in rows for t in r[1:3]))}
    plain = _chunked([t.encode() for t in number], one_in)
    made = _chunked([t.encode() for t in changed], one_in)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows], kind),
            pa.array([len(r[1]) for r in rows], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
            _lists([plain[number[r[1]]] for r in rows]),
            _lists(made),
            _lists([plain[number[r[2]]] for r in rows]),
            pa.array([r[3] for r in rows], pa.int64()),
        ],
        names=["doc_id", "n_chars", "edited_sha256", "sketch", "edited_sketch", "next_sketch", "times"],
    )


def successors(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", one_in: int = ONE_IN
) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, sketch, edited_sketch, next_sketch) of every row.

    Texts follow one another by descending id, and the first one follows the last. Each
    text is sent to its range once, compressed. The driver holds a sample of the ids, one
    key of each range and fewer than 1 / ``HOT_SHARE`` keys of rows that repeat very often.
    """
    spark = docs.sparkSession
    ship(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    key = ["doc_id", "text_hash"]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    tally = staged(rows.groupBy(*key).agg(F.count("*").alias("times")), "successor-keys")
    total = tally.agg(F.coalesce(F.sum("times"), F.lit(0))).first()[0]
    often = tally.filter(F.col("times") > max(total * HOT_SHARE, 1))
    hot = {_key(r["doc_id"], r["text_hash"]) for r in often.collect()}
    bounds, guests = _ranges(tally, total)
    shared = spark.sparkContext.broadcast((bounds, guests, hot))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, guests, hot = shared.value
        for batch in slices(batches):
            ids, texts, hashes, chosen = (c.to_pylist() for c in batch.columns)
            to, packed = [], {}
            for i, (doc_id, text_hash, only) in enumerate(zip(ids, hashes, chosen)):
                place = _key(doc_id, text_hash)
                if place in hot and not only:
                    continue
                packed[i] = zlib.compress(texts[i].encode(), 1)
                to.append((i, _cell_of(bounds, place), True))
                if place in guests:
                    to.append((i, guests[place], False))
            row = pa.array([t[0] for t in to], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([t[1] for t in to], pa.int32()),
                    pa.array([t[2] for t in to], pa.bool_()),
                    batch.column(0).take(row),
                    batch.column(2).take(row),
                    pa.array([packed[t[0]] for t in to], pa.binary()),
                ],
                names=["cell", "own", "doc_id", "text_hash", "packed"],
            )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # own rows in descending order, then the first row of the range behind them
        here, done, ready, held = None, False, [], 0
        for batch in slices(batches):
            for own, doc_id, packed in zip(*(batch.column(c).to_pylist() for c in (1, 2, 4))):
                if done:
                    continue
                text = zlib.decompress(packed).decode()
                if here is not None:
                    ready.append((*here, text, 1))
                    held += len(here[1]) + len(text)
                here, done = (doc_id, text), not own
                if held > CHUNK_BYTES:
                    yield _compared(ready, batch.schema.field("doc_id").type, one_in)
                    ready, held = [], 0
            if ready:
                yield _compared(ready, batch.schema.field("doc_id").type, one_in)
                ready, held = [], 0

    def repeat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            doc_id, text, times = (c.to_pylist()[0] for c in batch.columns)
            yield _compared([(doc_id, text, text, times)], batch.schema.field("doc_id").type, one_in)

    result = (
        f"doc_id {kind}, n_chars bigint, edited_sha256 string, sketch array<bigint>, "
        "edited_sketch array<bigint>, next_sketch array<bigint>, times bigint"
    )
    sent = rows.withColumn("only", F.lit(False))
    if hot:
        names = F.broadcast(often.select(F.col("doc_id").alias("hot_id"), F.col("text_hash").alias("hot_hash"), "times"))
        same = F.col("doc_id").eqNullSafe(F.col("hot_id")) & (F.col("text_hash") == F.col("hot_hash"))
        one_each = rows.join(names, same).groupBy(*key, "times").agg(F.first("text").alias("text"))
        one_each = staged(one_each, "successor-repeats")
        sent = sent.unionByName(one_each.select(*key, "text", F.lit(True).alias("only")))
    dealt = (
        sent.mapInArrow(deal, f"cell int, own boolean, doc_id {kind}, text_hash bigint, packed binary")
        .repartitionById(len(bounds) + 1, "cell")
        .sortWithinPartitions(F.desc("own"), F.desc_nulls_last("doc_id"), F.desc("text_hash"))
    )
    out = dealt.mapInArrow(meet, result).drop("times")
    if hot:
        left = F.col("times") - 1
        # all copies but one follow themselves: blocks of copies, dealt to all tasks
        starts = F.explode(F.sequence(F.lit(0).cast("bigint"), left - 1, F.lit(BLOCK).cast("bigint")))
        blocks = one_each.withColumn("start", starts).withColumn("times", F.least(left - F.col("start"), F.lit(BLOCK)))
        blocks = blocks.repartition("doc_id", "text_hash", "start").select("doc_id", "text", "times")
        copies = blocks.mapInArrow(repeat, result)
        each = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times"))).alias("copy")
        out = out.unionByName(copies.select(*out.columns, each).drop("copy"))
    return out
