"""Quality rules from line labels: a linear-chain conditional random field.

Each line with a word gets features of its form; a linear-chain conditional
random field scores content against boilerplate, and Viterbi decoding labels all
lines of a text together. A text is retained if the words of its content lines
are at least a given share of all its words. Base rules count words, symbols,
repeated lines and repeated passages over the whole text.

The field is fitted on a bounded sample: about ``TRAIN_DOCS`` labelled texts of each
class by the hash of their id, of which those with at most ``TRAIN_LINES`` lines. The lines of a
text take its label. Everything else covers all rows.

Defined cases: null or empty text has no words and fails the base rules. Without
labelled rows all lines count as content. Null labels and null ids teach nothing.
Repeated rows repeat their result, an empty table gives an empty table, other
columns are not read, texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.llm.tables import sampled_labels, ship
from gridtally.llm.words import Scan, repeated, text_chunks

TRAIN_DOCS = 1000
TRAIN_LINES = 32
TRAIN_STEPS = 80
CONTENT_SHARE = 0.5
MIN_WORDS = 20
WINDOW = 8
REPEAT_PERCENT = 30


def _marks(chars: str) -> np.ndarray:
    table = np.zeros(256, dtype=np.int64)
    table[[ord(c) for c in chars]] = 1
    return table


SYMBOLS = _marks("#*$%&|<>")
PIPES = _marks("|")
SHOUTS = _marks("!")
DIGITS = _marks("0123456789")
UPPER = _marks("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
LETTERS = UPPER | _marks("abcdefghijklmnopqrstuvwxyz")
LETTERS[0xC0:] = 1  # the first byte of a longer character
FIRST_BYTES = np.ones(256, dtype=np.int64)
FIRST_BYTES[0x80:0xC0] = 0


def line_features(scan: Scan) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, text number, words) of every line with a word."""

    def in_lines(table: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(table[scan.data])))
        return total[scan.line_end] - total[scan.line_start]

    before_end = np.searchsorted(scan.word_start, scan.line_end)
    words = before_end - np.searchsorted(scan.word_start, scan.line_start)
    _, again = repeated(scan.line_doc, scan.hashes(scan.line_start, scan.line_end))
    used = words > 0
    hashes = scan.word_hashes()
    as_before = np.concatenate(([0, 0], np.cumsum(hashes[1:] == hashes[:-1])))[: len(hashes) + 1]
    first = before_end[used] - words[used]
    stutter = as_before[before_end[used]] - as_before[np.minimum(first + 1, len(hashes))]
    n = words[used]
    chars = np.maximum(in_lines(FIRST_BYTES)[used], 1)
    letters = np.maximum(in_lines(LETTERS)[used], 1)
    symbols, pipes, shouts = (in_lines(t)[used] for t in (SYMBOLS, PIPES, SHOUTS))
    features = np.stack(
        [
            np.ones(len(n)),
            n < 4,
            (n >= 4) & (n < 10),
            n >= 30,
            symbols > 0,
            symbols > 0.05 * chars,
            pipes > 0.2 * n,
            shouts > 0.3 * n,
            in_lines(UPPER)[used] > 0.5 * letters,
            in_lines(DIGITS)[used] > 0.2 * chars,
            letters < 0.6 * chars,
            chars > 10 * n,
            again[used],
            stutter > 0.4 * n,
        ],
        axis=1,
    ).astype(np.float64)
    return features, scan.line_doc[used], n


N_FEATURES = 14


def fit(sequences: list[tuple[np.ndarray, int]]) -> dict[str, np.ndarray]:
    """Weights of the field from (features by line, label of all lines).

    Gradient steps on the penalised likelihood; label 1 is content.
    """
    weight = np.zeros((N_FEATURES, 2))
    step_weight = np.zeros((2, 2))
    if not sequences:
        return {"line": weight, "step": step_weight}
    n, longest = len(sequences), max(len(f) for f, _ in sequences)
    x = np.zeros((n, longest, N_FEATURES))
    here = np.zeros((n, longest), dtype=bool)
    for i, (features, _) in enumerate(sequences):
        x[i, : len(features)], here[i, : len(features)] = features, True
    label = np.array([y for _, y in sequences])
    seen = np.zeros((n, longest, 2))
    seen[np.arange(n), :, label] = 1
    seen *= here[..., None]
    pairs = np.maximum(here.sum(axis=1) - 1, 0)
    seen_step = np.zeros((2, 2))
    for y in (0, 1):
        seen_step[y, y] = pairs[label == y].sum()
    moment = [np.zeros_like(weight), np.zeros_like(step_weight)]
    speed = [np.zeros_like(weight), np.zeros_like(step_weight)]
    lines = here.sum()
    for t in range(1, TRAIN_STEPS + 1):
        score = np.where(here[..., None], x @ weight, 0.0)
        forward, backward = np.zeros_like(score), np.zeros_like(score)
        forward[:, 0] = score[:, 0]
        for k in range(1, longest):
            come = np.logaddexp.reduce(forward[:, k - 1, :, None] + step_weight, axis=1) + score[:, k]
            forward[:, k] = np.where(here[:, k, None], come, forward[:, k - 1])
        for k in range(longest - 2, -1, -1):
            go = np.logaddexp.reduce(step_weight + (score + backward)[:, k + 1, None, :], axis=2)
            backward[:, k] = np.where(here[:, k + 1, None], go, 0.0)
        total = np.logaddexp.reduce(forward[:, -1], axis=1)
        expected = np.exp(forward + backward - total[:, None, None]) * here[..., None]
        both = (
            forward[:, :-1, :, None]
            + step_weight
            + (score + backward)[:, 1:, None, :]
            - total[:, None, None, None]
        )
        expected_step = (np.exp(both) * here[:, 1:, None, None]).sum(axis=(0, 1))
        slopes = [
            np.einsum("nlf,nly->fy", x, seen - expected) / lines - 0.001 * weight,
            (seen_step - expected_step) / lines - 0.01 * step_weight,
        ]
        for i, value in enumerate((weight, step_weight)):
            moment[i] = 0.9 * moment[i] + 0.1 * slopes[i]
            speed[i] = 0.99 * speed[i] + 0.01 * slopes[i] ** 2
            value += 0.1 * (moment[i] / (1 - 0.9**t)) / (np.sqrt(speed[i] / (1 - 0.99**t)) + 1e-8)
    return {"line": weight, "step": step_weight}


def viterbi(score: np.ndarray, doc: np.ndarray, step: np.ndarray) -> np.ndarray:
    """The best label of every line; ``doc`` is ascending, ties go to content."""
    if not len(score):
        return np.zeros(0, dtype=np.int64)
    _, first, count = np.unique(doc, return_index=True, return_counts=True)
    order = np.argsort(-count, kind="stable")
    first, count = first[order], count[order]
    best = score.copy()
    came = np.zeros(score.shape, dtype=np.int8)
    for k in range(1, count[0]):
        at = first[: np.searchsorted(-count, -k, side="left")] + k
        ways = best[at - 1][:, :, None] + step
        came[at] = np.where(ways[:, 1] >= ways[:, 0], 1, 0)
        best[at] = ways.max(axis=1) + score[at]
    label = np.where(best[:, 1] >= best[:, 0], 1, 0)
    for k in range(count[0] - 2, -1, -1):
        at = first[: np.searchsorted(-count, -(k + 1), side="left")] + k
        label[at] = came[at + 1, label[at + 1]]
    return label


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> dict[str, np.ndarray]:
    """The field fitted on the bounded sample described above."""
    ship(docs.sparkSession)
    sample, _ = sampled_labels(labels, id_col, label_col, TRAIN_DOCS)
    rows = docs.select(id_col, text_col).join(
        F.broadcast(sample), F.col(id_col) == F.col("train_id"), "inner"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches, 0):
            features, doc, _ = line_features(Scan(texts))
            lines = np.bincount(doc, minlength=len(texts))
            ends = np.cumsum(lines)
            fits = np.flatnonzero((lines > 0) & (lines <= TRAIN_LINES))
            packed = [
                np.packbits(features[ends[i] - lines[i] : ends[i]].astype(bool), axis=1).tobytes()
                for i in fits
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).take(pa.array(fits)), pa.array(packed, pa.binary())],
                names=["label", "lines"],
            )

    found = rows.select(text_col, "label").mapInArrow(run, "label int, lines binary").collect()
    width = (N_FEATURES + 7) // 8
    sequences = [
        (
            np.unpackbits(np.frombuffer(r["lines"], dtype=np.uint8).reshape(-1, width), axis=1)[
                :, :N_FEATURES
            ].astype(float),
            r["label"],
        )
        for r in sorted(found, key=lambda r: (r["label"], bytes(r["lines"])))
    ]
    return fit(sequences)


def assess(
    docs: DataFrame,
    model: dict[str, np.ndarray],
    id_col: str = "doc_id",
    text_col: str = "text",
    content_share: float = CONTENT_SHARE,
) -> DataFrame:
    """Counts, base verdict, content words and final verdict of every row."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches, 1):
            scan = Scan(texts)
            words = scan.per_doc(scan.word_doc)
            points = np.concatenate(([0], np.cumsum(FIRST_BYTES[scan.data])))
            word_chars = scan.per_doc(scan.word_doc, points[scan.word_end] - points[scan.word_start])
            total = np.concatenate(([0], np.cumsum(SYMBOLS[scan.data])))
            symbols = np.diff(total[scan.doc_end], prepend=0)
            features, line_doc, line_words = line_features(scan)
            repeats = scan.per_doc(line_doc, features[:, 12])
            first, value = scan.runs(scan.word_hashes(), WINDOW)
            often, _ = repeated(scan.word_doc[first], value)
            cover = np.zeros(len(scan.word_start) + 1, dtype=np.int64)
            cover[first[often]] += 1
            cover[first[often] + WINDOW] -= 1
            repeat_words = scan.per_doc(scan.word_doc, np.cumsum(cover)[:-1] > 0)
            label = viterbi(features @ model["line"], line_doc, model["step"])
            content = scan.per_doc(line_doc, line_words * label)
            failed = (words < MIN_WORDS) | (100 * repeat_words > REPEAT_PERCENT * words)
            kept = ~failed & (content >= content_share * words)
            counts = [words, word_chars, symbols, repeats, repeat_words, content]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(failed), pa.array(kept)],
                names=[id_col, *columns, "content_words", "base_failed", "kept"],
            )

    longs = ", ".join(f"{c} bigint" for c in [*columns, "content_words"])
    schema = f"`{id_col}` {kind}, {longs}, base_failed boolean, kept boolean"
    return docs.select(id_col, text_col).mapInArrow(run, schema)
