"""Toxic passages: maximum-scoring segments of word log-odds.

A token's score is its log-odds between toxic and clean labelled texts with a
Dirichlet prior from the whole corpus, drawn towards nothing by its standard error,
less a constant drift, so that ordinary text scores below nothing. Tokens are runs
of letters, A-Z in lower case; a token takes the clearest log-odds of itself and of
its beginnings of ``STEMS`` bytes, so that unseen forms of a stem count too. A linear
scan finds all maximal segments of a text. By extreme-value statistics a segment of
score S in a text of n tokens has the value x = lambda S - ln(K n), and is
significant if x > 0: fewer than one such segment is expected by chance. Lambda and
K are fitted to the greatest segments of clean texts by their moments. A text's
score is a logistic function of its greatest x and of the sum of its significant x.

Tokens and beginnings are counted by hash in ``2**BITS`` places. The prior counts
those of all texts. Class counts and calibration use
a bounded sample: about ``SAMPLE`` labelled texts of each class by the hash of their id,
weighted by the true class sizes.

Defined cases: null or empty text is scored like any text without a segment. Without
labelled rows of both classes every score is 0. Null labels and null ids teach
nothing. Repeated rows repeat their result, an empty table gives an empty table,
other columns are not read, texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally.llm.tables import sampled_labels, ship
from gridtally.llm.words import Scan, mix, text_chunks

BITS = 20
SAMPLE = 20_000
#: The prior weighs as much as this share of the toxic texts' tokens.
PRIOR_SHARE = 0.05
ERRORS = 3.0
DRIFT = 1.0
STEMS = (4, 5, 6, 7)
EULER = 0.5772156649015329


def places(scan: Scan) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(which tokens, place) for the tokens and then for each length of beginning."""
    start, end = scan.word_start, scan.word_end
    every = np.arange(len(start))
    for length in (0, *STEMS):
        which = np.flatnonzero(end - start > length) if length else every
        value = scan.hashes(start[which], start[which] + length if length else end)
        value = mix(value + np.uint64(length))
        yield which, (value >> np.uint64(64 - BITS)).astype(np.int64)


def token_scores(scan: Scan, odds: np.ndarray) -> np.ndarray:
    best = np.zeros(len(scan.word_start))
    for which, place in places(scan):
        own = odds[place]
        better = np.abs(own) > np.abs(best[which])
        best[which[better]] = own[better]
    return best - DRIFT


def segments(score: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, end, sum) in order, in linear time.

    Only positive scores are visited: a segment begins and ends with one. Each is
    joined with the nearest candidate of a smaller sum before it, as long as that
    makes both better.
    """
    total = np.concatenate(([0.0], np.cumsum(score)))
    found: list[tuple[int, int, float, float]] = []  # first, end, sum before, sum up to the end
    back: list[int] = []  # the last candidate with a smaller sum before it
    positive = np.flatnonzero(score > 0)
    for i, low, high in zip(positive.tolist(), total[positive].tolist(), total[positive + 1].tolist()):
        first, end = i, i + 1
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= low:
                j = back[j]
            if j < 0 or found[j][3] >= high:
                found.append((first, end, low, high))
                back.append(j)
                break
            first, low = found[j][0], found[j][2]
            del found[j:], back[j:]
    return [(first, end, high - low) for first, end, low, high in found]


def _count(docs: DataFrame, sample: DataFrame, id_col: str, text_col: str) -> np.ndarray:
    """Words by place in all texts, in the clean and in the toxic ones of the sample."""
    rows = docs.select(id_col, text_col).join(
        F.broadcast(sample), F.col(id_col) == F.col("train_id"), "left"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, 1 << BITS), dtype=np.int64)
        for batch, texts in text_chunks(batches, 0):
            scan = Scan(texts, lower=True, letters=True)
            label = batch.column(1).fill_null(-1).to_numpy(zero_copy_only=False)[scan.word_doc]
            for which, place in places(scan):
                total[0] += np.bincount(place, minlength=1 << BITS)
                for y in (0, 1):
                    own = place[label[which] == y]
                    if len(own):
                        total[1 + y] += np.bincount(own, minlength=1 << BITS)
        seen = np.flatnonzero(total[0])
        for start in range(0, len(seen), 100_000):
            part = seen[start : start + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int64()), *(pa.array(t[part], pa.int64()) for t in total)],
                names=["place", "corpus", "clean", "toxic"],
            )

    classes = ["corpus", "clean", "toxic"]
    counted = (
        rows.select(text_col, "label")
        .mapInArrow(run, "place bigint, corpus bigint, clean bigint, toxic bigint")
        .groupBy("place")
        .agg(*(F.sum(c).alias(c) for c in classes))
        .toArrow()
    )
    total = np.zeros((3, 1 << BITS))
    for i, c in enumerate(classes):
        total[i, counted["place"].to_numpy()] = counted[c].to_numpy()
    return total


def token_odds(total: np.ndarray) -> np.ndarray:
    """Log-odds by place, drawn towards nothing by their standard error."""
    corpus, clean, toxic = total
    prior = PRIOR_SHARE * toxic.sum() * (corpus + 0.01) / (corpus + 0.01).sum()
    a, b = toxic + prior, clean + prior
    odds = np.log(a / (a.sum() - a)) - np.log(b / (b.sum() - b))
    error = np.sqrt(1 / a + 1 / b)
    return np.sign(odds) * np.maximum(np.abs(odds) - ERRORS * error, 0)


def extreme_values(top: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """(lambda, ln K) for which lambda * top - ln(K n) has the mean and the variance
    of a standard Gumbel distribution."""
    if len(top) < 2 or not np.var(top) > 0:
        return 1.0, 0.0
    size = np.log(n)
    a, b = np.var(top), np.mean((top - top.mean()) * (size - size.mean()))
    c = np.var(size) - np.pi**2 / 6
    root = b * b - a * c
    rate = (b + np.sqrt(root)) / a if root > 0 else 0.0
    if not rate > 0:
        rate = np.pi / np.sqrt(6 * a)
    return float(rate), float(np.mean(rate * top - size) - EULER)


def _text_values(texts: list[bytes], model: dict) -> tuple[np.ndarray, ...]:
    """By text: tokens, greatest segment, sum and number of significant values."""
    scan = Scan(texts, lower=True, letters=True)
    score = token_scores(scan, model["odds"])
    n = scan.per_doc(scan.word_doc)
    ends = np.cumsum(n)
    top, extra = np.zeros(len(texts)), np.zeros(len(texts))
    hits = np.zeros(len(texts), dtype=np.int64)
    for i in np.unique(scan.word_doc[score > 0]):
        found = segments(score[ends[i] - n[i] : ends[i]])
        value = np.array([s for _, _, s in found])
        top[i] = value.max()
        x = model["rate"] * value - model["log_k"] - np.log(n[i])
        extra[i], hits[i] = x[x > 0].sum(), (x > 0).sum()
    return n, top, extra, hits


def _measures(n: np.ndarray, top: np.ndarray, extra: np.ndarray, model: dict) -> np.ndarray:
    x = np.where(top > 0, model["rate"] * top - model["log_k"] - np.log(np.maximum(n, 1)), -12.0)
    return np.stack([np.ones(len(n)), np.maximum(x, -12.0), np.log1p(extra)], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Penalised Newton steps."""
    beta = np.zeros(x.shape[1])
    pull = np.diag([1e-6, *[1.0] * (x.shape[1] - 1)])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (y - p)) - pull @ beta
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + pull
        beta = beta + np.clip(np.linalg.solve(curve, slope), -4, 4)
    return beta


def learn(
    docs: DataFrame,
    labels: DataFrame,
    use: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> dict:
    """Token log-odds, extreme-value constants and the logistic weights.

    ``use`` tells by a label row's id whether it may teach.
    """
    ship(docs.sparkSession)
    sample, sizes = sampled_labels(labels, id_col, label_col, SAMPLE, use)
    model: dict = {"odds": np.zeros(1 << BITS, dtype=np.float32), "rate": 1.0, "log_k": 0.0, "beta": None}
    if not (sizes.get(0) and sizes.get(1)):
        return model
    model["odds"] = token_odds(_count(docs, sample, id_col, text_col)).astype(np.float32)
    rows = docs.select(id_col, text_col).join(
        F.broadcast(sample), F.col(id_col) == F.col("train_id"), "inner"
    )
    first = _values(rows.select("label", text_col), model)  # about twice SAMPLE rows
    n, top, label = first["n"], first["top"], first["label"]
    null = (label == 0) & (top > 0)
    model["rate"], model["log_k"] = extreme_values(top[null], n[null])
    again = _values(rows.select("label", text_col), model)
    x = _measures(again["n"], again["top"], again["extra"], model)
    weight = np.array([sizes[y] / max((label == y).sum(), 1) for y in (0, 1)])
    weight = weight[again["label"]]
    model["beta"] = _logistic(x, again["label"], weight / weight.mean())
    return model


def _values(rows: DataFrame, model: dict) -> dict[str, np.ndarray]:
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(model)
    label, _ = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches, 1):
            n, top, extra, _ = _text_values(texts, shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(top), pa.array(extra)],
                names=["label", "n", "top", "extra"],
            )

    found = rows.mapInArrow(run, "label int, n bigint, top double, extra double").toArrow()
    return {c: found[c].to_numpy() for c in found.column_names}


def assess(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, passages): probability and number of significant passages of every row."""
    spark = docs.sparkSession
    ship(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches, 1):
            n, top, extra, hits = _text_values(texts, shared.value)
            if shared.value["beta"] is None:
                score = np.zeros(len(texts))
            else:
                z = _measures(n, top, extra, shared.value) @ shared.value["beta"]
                score = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score, pa.float64()), pa.array(hits, pa.int64())],
                names=[id_col, "score", "passages"],
            )

    schema = f"`{id_col}` {kind}, score double, passages bigint"
    return docs.select(id_col, text_col).mapInArrow(run, schema)
