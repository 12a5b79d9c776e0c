"""Language identification: known words first, then ever shorter character n-grams.

A word that the training texts hold often enough scores by its log frequency in
each language. Any other word scores by its known character n-grams of the
greatest length that has any, from ``LONGEST`` down to one. A text's language is
the one with the greatest sum; ties go to the least code.

Words and n-grams are counted by their whole 64-bit hash over all training rows, so a
word that was not seen is taken for unseen however large the corpus is. The model is a
table with one row for each known word and each n-gram. What reaches the driver and
the tasks is its head, the rows that were seen most often, in at most ``HEAD_BYTES``
whatever the corpus. If that is the whole model, texts are scored where they are. If
not, tasks score the words of the head; the distinct other words are joined with the
model's words, and those it lacks with its n-grams, length by length, and the sums
go back to the texts. Both ways give the same scores up to rounding.

Defined cases: text that is null or has no letter gives ``und`` and score 0, and so
does any text if nothing was learned. Rows with a null language or a null id teach
nothing. Repeated rows repeat their result, an empty table gives an empty table,
other columns are not read, texts of any length are read whole. One row for each
language reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from gridtally.llm.tables import ship, slices, staged
from gridtally.llm.words import LETTER, Scan, text_chunks

LONGEST = 5
#: A word is known if it was seen so often in all languages together.
KNOWN_COUNT = 3
SMOOTHING = 0.5
#: The score of a text counts its words as this many at most.
SURE_WORDS = 10
#: Bytes of text that are looked at together; a longer text is alone.
TEXT_BYTES = 1 << 19
#: A task sends on the words that it has counted when they take so many bytes.
HELD_BYTES = 48 << 20
#: What Python takes to hold a word beside the word's own bytes, about.
ENTRY_BYTES = 256
#: A task sends on the n-grams that it has counted when there are so many.
HELD_GRAMS = 1 << 19
#: Distinct words whose n-grams are made at a time, in bytes.
GRAM_BYTES = 1 << 18
#: Bytes of the model's rows that the driver and each task hold at most.
HEAD_BYTES = 64 << 20
UNKNOWN = "und"
SPACE = 32


def gram_hashes(points: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(n, hash of the n code points from each one on), for n of 1 and up."""
    value = points.astype(np.uint64)
    for n in range(1, min(LONGEST, len(points)) + 1):
        if n > 1:
            value = value[:-1] * np.uint64(0x9E3779B97F4A7C15) + points[n - 1 :]
            value ^= value >> np.uint64(29)
        yield n, (value + np.uint64(n)) * np.uint64(0xBF58476D1CE4E5B9)


def within_words(space: np.ndarray, n: int) -> np.ndarray:
    """Whether the n characters from each one on lie in one word, its borders included."""
    size = len(space) - n + 1
    good = ~space[:size] if n < 3 else ~space[1 : size + 1]
    for i in range(2, n - 1):
        good &= ~space[i : size + i]
    return good | ~space[1 : size + 1] if n == 2 else good


def points_of(text: bytes) -> np.ndarray:
    return np.frombuffer(text.decode(errors="replace").encode("utf-32-le"), dtype="<u4")


def grams_of(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hash, number of its word) of the n-grams of all words, for n of 1 and up."""
    points = points_of(b" " + b" ".join(words) + b" ")
    space = points == SPACE
    word = np.cumsum(space) - 1
    for n, value in gram_hashes(points):
        good = within_words(space, n)
        yield value[good], word[: len(value)][good]


def parts_of(words: list[bytes], size: int = GRAM_BYTES) -> Iterator[slice]:
    """Slices of about ``size`` bytes; a longer word is alone."""
    start = held = 0
    for i, word in enumerate(words):
        if held and held + len(word) > size:
            yield slice(start, i)
            start, held = i, 0
        held += len(word) + 1
    if start < len(words):
        yield slice(start, len(words))


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and their sums."""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), dtype=bool), keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def gram_counts(words: list[bytes], n: np.ndarray, before: tuple | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(hash, count) of the n-grams of words that occur ``n`` times each, with those counted before."""
    found = before or (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    for part in parts_of(words):
        pieces = [found, *(summed(value, n[part][word]) for value, word in grams_of(words[part]))]
        found = summed(*(np.concatenate(x) for x in zip(*pieces)))
    return found


def _sent(lang: str, is_word: bool, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for start in range(0, len(keys), 100_000):
        part = slice(start, start + 100_000)
        size = len(keys[part])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * size, pa.string()),
                pa.array([is_word] * size, pa.bool_()),
                pa.array(keys[part].view(np.int64), pa.int64()),
                pa.array(counts[part], pa.int64()),
            ],
            names=["lang", "is_word", "key", "n"],
        )


def task_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(language, whether it is a word, hash, count) of the words and n-grams of rows (text, language).

    Few are held at a time, however many there are; one that was sent on before may come again.
    """
    held: dict[str, dict[int, list]] = {}  # language, hash of the word: [word, count]
    grams: dict[str, tuple[np.ndarray, np.ndarray]] = {}  # language: hashes and counts of the n-grams of sent words
    size = 0

    def send_words() -> Iterator[pa.RecordBatch]:
        nonlocal size
        while held:
            lang, found = held.popitem()
            words = [w for w, _ in found.values()]
            n = np.array([c for _, c in found.values()], dtype=np.int64)
            own = np.fromiter(found, dtype=np.uint64, count=len(found))
            found.clear()
            yield from _sent(lang, True, own, n)
            grams[lang] = gram_counts(words, n, grams.get(lang))
        size = 0

    def send_grams() -> Iterator[pa.RecordBatch]:
        while grams:
            lang, counted = grams.popitem()
            yield from _sent(lang, False, *counted)

    for batch, texts in text_chunks(batches, 0, TEXT_BYTES):
        scan = Scan(texts, lower=True, letters=True)
        number: dict[str, int] = {}
        lang = np.array([number.setdefault(x, len(number)) for x in batch.column(1).to_pylist()])
        hashes, of = scan.word_hashes(), lang[scan.word_doc]
        data = scan.data.tobytes()
        for name, x in number.items():
            at = np.flatnonzero(of == x)
            found = held.setdefault(name, {})
            distinct, one, n = np.unique(hashes[at], return_index=True, return_counts=True)
            for key, i, c in zip(distinct.tolist(), at[one].tolist(), n.tolist()):
                entry = found.get(key)
                if entry is None:
                    word = data[scan.word_start[i] : scan.word_end[i]]
                    found[key] = [word, c]
                    size += len(word) + ENTRY_BYTES
                else:
                    entry[1] += c
        if size > HELD_BYTES:
            yield from send_words()
            if sum(len(keys) for keys, _ in grams.values()) > HELD_GRAMS:
                yield from send_grams()
    yield from send_words()
    yield from send_grams()


@dataclass(frozen=True)
class Model:
    """What was learned: ``table`` (is_word, key, total, scores) and its head in numpy."""

    langs: list[str]
    table: DataFrame
    words: tuple[np.ndarray, np.ndarray]
    grams: tuple[np.ndarray, np.ndarray]
    whole: bool  # whether the head is the whole table


def learn(docs: DataFrame, use: Column, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Log frequencies by hash and language from the rows where ``use`` is true."""
    ship(docs.sparkSession)
    rows = docs.filter(use & F.col(lang_col).isNotNull()).select(text_col, lang_col)

    counted = staged(
        rows.mapInArrow(task_counts, "lang string, is_word boolean, key bigint, n bigint")
        .groupBy("lang", "is_word", "key")
        .agg(F.sum("n").alias("n")),
        "languages",
    )
    seen = {(r[0], r[1]): r[2] for r in counted.groupBy("lang", "is_word").agg(F.sum("n")).collect()}
    by_key = counted.groupBy("is_word", "key").agg(
        F.sum("n").alias("total"), F.collect_list(F.struct("lang", "n")).alias("by_lang")
    )
    distinct = {r[0]: r[1] for r in counted.groupBy("is_word").agg(F.count_distinct("key")).collect()}
    langs = sorted({x for x, _ in seen})
    known = by_key.filter(~F.col("is_word") | (F.col("total") >= KNOWN_COUNT))
    # Sums of what was seen, with the smoothing, by kind: n-grams, words.
    whole = np.array(
        [[seen.get((x, w), 0) + SMOOTHING * distinct.get(w, 0) for x in langs] for w in (False, True)], dtype=np.float64
    ).reshape(2, len(langs))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 100_000):
            lists = batch.column(3)
            row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).to_numpy())
            flat = lists.flatten()
            which = flat.field("lang").dictionary_encode()
            to = np.array([langs.index(x) for x in which.dictionary.to_pylist()], dtype=np.int64)
            out = np.zeros((batch.num_rows, len(langs)), dtype=np.float32)
            out[row, to[which.indices.to_numpy()]] = flat.field("n").to_numpy()
            out += SMOOTHING
            out /= whole[batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)].astype(np.float32)
            ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(langs))
            scores = pa.ListArray.from_arrays(ends, pa.array(np.log(out, out=out).ravel()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], scores], names=["is_word", "key", "total", "scores"]
            )

    table = staged(
        known.select("is_word", "key", "total", "by_lang").mapInArrow(
            score, "is_word boolean, key bigint, total bigint, scores array<float>"
        ),
        "language-model",
    )
    # Rows by how often they were seen, in steps of about a fifth: few lines, whatever the corpus.
    step = F.floor(F.log2("total") * 4).cast("int").alias("step")
    sizes = {r["step"]: r["count"] for r in table.groupBy(step).count().collect()}
    left = HEAD_BYTES // (8 + 4 * max(len(langs), 1))
    least, all_in = None, True
    for at in sorted(sizes, reverse=True):
        left -= sizes[at]
        if left < 0:
            all_in = False
            break
        least = at
    head = table.filter(F.lit(False) if least is None else step >= least).select("is_word", "key", "scores").toArrow()

    def part(is_word: bool) -> tuple[np.ndarray, np.ndarray]:
        rows = head.filter(pc.equal(head["is_word"], is_word)).combine_chunks()
        keys = rows["key"].to_numpy().view(np.uint64)
        values = rows["scores"].combine_chunks().flatten().to_numpy(zero_copy_only=False) if len(keys) else np.zeros(0)
        order = np.argsort(keys)
        return keys[order], values.astype(np.float32).reshape(len(keys), len(langs))[order]

    return Model(langs, table, part(True), part(False), all_in)


def looked_up(keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, whether it is known) of each hash asked for; ``keys`` are sorted."""
    if not len(keys):
        return np.zeros(len(asked), dtype=np.int64), np.zeros(len(asked), dtype=bool)
    row = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return row, keys[row] == asked


#: What a task finds out about a text beside its columns.
MEASURES = [
    StructField("total", ArrayType(DoubleType())),
    StructField("n", LongType()),
    StructField("lettered", BooleanType()),
    StructField("cold", ArrayType(StructType().add("key", LongType()).add("word", BinaryType()).add("n", LongType()))),
]


def predict(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, lang_pred, score) of every row."""
    named = _identified(docs.select(F.struct(id_col).alias("doc"), F.col(text_col).alias("text")), model)
    return named.select(f"doc.`{id_col}`", "lang_pred", "score")


def keep(docs: DataFrame, model: Model, least_score: float, text_col: str = "text") -> DataFrame:
    """The rows whose language is known with at least this score; all columns stay."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    named = _identified(docs.select(whole), model, text_col)
    return named.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score)).select("doc.*")


def _measure(texts: list[bytes], langs: list[str], words: tuple, grams: tuple, whole: bool) -> tuple:
    """(sums by language, words, whether there is a letter, unresolved words) of each text."""
    scan = Scan(texts, lower=True, letters=True)
    distinct, one, back = np.unique(scan.word_hashes(), return_index=True, return_inverse=True)
    rows = np.zeros((len(distinct), len(langs)))
    place, known = looked_up(words[0], distinct)
    rows[known] = words[1][place[known]]
    unseen = np.flatnonzero(~known)
    cold: list[list[dict]] = [[] for _ in texts]
    if len(unseen) and langs:
        data = scan.data.tobytes()
        spelled = [data[scan.word_start[i] : scan.word_end[i]] for i in one[unseen]]
        if whole:
            for part in parts_of(spelled):
                rows[unseen[part]] = fall_back(spelled[part], *grams)
        else:
            number = np.cumsum(~known) - 1
            at = np.flatnonzero(~known[back])
            pairs, n = np.unique(scan.word_doc[at] * len(unseen) + number[back[at]], return_counts=True)
            keys = distinct[unseen].view(np.int64).tolist()
            for pair, often in zip(pairs.tolist(), n.tolist()):
                k = pair % len(unseen)
                cold[pair // len(unseen)].append({"key": keys[k], "word": spelled[k], "n": often})
    points = rows[back]
    total = np.stack(
        [np.bincount(scan.word_doc, weights=points[:, j], minlength=len(texts)) for j in range(len(langs))]
        or [np.zeros(len(texts))],
        axis=1,
    )
    lettered = scan.per_doc(scan.word_doc, _ascii_words(scan)) > 0
    for i in np.flatnonzero(~lettered):
        lettered[i] = any(c.isalpha() for c in texts[i].decode())
    return total, scan.per_doc(scan.word_doc), lettered, cold


def _verdict(total: np.ndarray, n: np.ndarray, lettered: np.ndarray, langs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(language, score) from the sums of the words' scores."""
    mean = total / np.maximum(n, 1)[:, None]
    sure = np.exp((mean - mean.max(axis=1, keepdims=True)) * np.minimum(n, SURE_WORDS)[:, None])
    best = np.where((n > 0) & lettered & bool(langs), total.argmax(axis=1), len(langs))
    score = np.where(best == len(langs), 0.0, sure.max(axis=1) / sure.sum(axis=1))
    return np.array([*langs, UNKNOWN], dtype=object)[best], score


def _named(doc: pa.Array, names: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [doc, pa.array(names, pa.string()), pa.array(score, pa.float64())], names=["doc", "lang_pred", "score"]
    )


def _with_text(batches: Iterator[pa.RecordBatch], text_col: str | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = batch.column(1) if text_col is None else batch.column(0).field(text_col)
        yield pa.RecordBatch.from_arrays([batch.column(0), text], names=["doc", "text"])


def _identified(docs: DataFrame, model: Model, text_col: str | None = None) -> DataFrame:
    """(doc, lang_pred, score) of rows (doc, text), or of rows (doc) with the text in them."""
    spark = docs.sparkSession
    ship(spark)
    langs, whole = model.langs, model.whole
    shared = spark.sparkContext.broadcast((model.words, model.grams))
    doc = [docs.schema["doc"]]
    result = StructType(doc + [StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, grams = shared.value
        for batch, texts in text_chunks(_with_text(batches, text_col), 1, TEXT_BYTES):
            total, n, lettered, _ = _measure(texts, langs, words, grams, True)
            yield _named(batch.column(0), *_verdict(total, n, lettered, langs))

    if whole:
        return docs.mapInArrow(run, result)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, grams = shared.value
        kind = pa.list_(pa.struct([("key", pa.int64()), ("word", pa.binary()), ("n", pa.int64())]))
        for batch, texts in text_chunks(_with_text(batches, text_col), 1, TEXT_BYTES):
            total, n, lettered, cold = _measure(texts, langs, words, grams, False)
            sums = pa.array(list(total), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sums, pa.array(n, pa.int64()), pa.array(lettered), pa.array(cold, kind)],
                names=["doc", "total", "n", "lettered", "cold"],
            )

    measures = StructType(doc + MEASURES)
    measured = docs.mapInArrow(measure, measures)
    measured = staged(measured.withColumn("row", F.monotonically_increasing_id()), "measured")
    met = measured.select("row", F.inline("cold"))
    scores = _cold_scores(met.groupBy("key").agg(F.first("word").alias("word")), model)
    weighted = [F.sum(F.col("n") * F.col("scores")[j]) for j in range(len(langs))]
    more = met.select("row", "key", "n").join(scores, "key").groupBy("row").agg(F.array(*weighted).alias("more"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            total, rest = (np.array(batch.column(c).to_pylist(), dtype=np.float64) for c in (1, 4))
            n = batch.column(2).to_numpy()
            yield _named(
                batch.column(0), *_verdict(total + rest, n, batch.column(3).to_numpy(zero_copy_only=False), langs)
            )

    none = F.array(*[F.lit(0.0)] * len(langs))
    joined = measured.drop("cold").join(more, "row", "left")
    return joined.select("doc", "total", "n", "lettered", F.coalesce("more", none).alias("more")).mapInArrow(finish, result)


def _cold_scores(asked: DataFrame, model: Model) -> DataFrame:
    """(key, scores) of words outside the model's head: as words, else by their n-grams."""
    known = model.table.filter("is_word").select("key", "scores")
    looked = staged(asked.join(known, "key", "left"), "asked")
    found = looked.filter(F.col("scores").isNotNull()).select("key", F.col("scores").cast("array<double>").alias("scores"))
    open_ = looked.filter(F.col("scores").isNull()).select("key", "word")
    table = model.table.filter(~F.col("is_word")).select(
        F.col("key").alias("gram"), F.col("scores").cast("array<double>").alias("scores")
    )

    def grams_with(length: int) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, 4096):
                keys, words = batch.column(0).to_numpy(), batch.column(1).to_pylist()
                for part in parts_of(words):
                    for n, (value, word) in enumerate(grams_of(words[part]), 1):
                        if n == length:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(keys[part][word]), pa.array(value.view(np.int64))], names=["key", "gram"]
                            )

        return run

    for length in range(LONGEST, 0, -1):
        grams = open_.mapInArrow(grams_with(length), "key bigint, gram bigint").groupBy("key", "gram").agg(
            F.count("*").alias("times")
        )
        mean = [F.sum(F.col("times") * F.col("scores")[j]) / F.sum("times") for j in range(len(model.langs))]
        scored = staged(grams.join(table, "gram").groupBy("key").agg(F.array(*mean).alias("scores")), "by-grams")
        found = found.unionByName(scored)
        if length > 1:
            open_ = staged(open_.join(scored, "key", "left_anti"), "open-words")
            if open_.isEmpty():
                break
    return found


def _ascii_words(scan: Scan) -> np.ndarray:
    """Whether each word begins or ends with an ASCII letter."""
    return (scan.data[scan.word_start] < 128) | (scan.data[scan.word_end - 1] < 128)


def fall_back(words: list[bytes], keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The mean score of each word's known n-grams of the greatest length that has any."""
    out = np.zeros((len(words), table.shape[1]))
    open_ = np.ones(len(words), dtype=bool)
    for value, word in reversed(list(grams_of(words))):
        left = open_[word]
        value, word = value[left], word[left]
        row, known = looked_up(keys, value)
        row, word = row[known], word[known]
        n = np.bincount(word, minlength=len(words))
        found = n > 0
        for j in range(table.shape[1]):
            total = np.bincount(word, weights=table[row, j], minlength=len(words))
            out[found, j] = total[found] / n[found]
        open_ &= ~found
    return out
