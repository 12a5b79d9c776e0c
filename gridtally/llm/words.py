"""Words, lines and their hashes over many texts at once, in numpy.

A word is a run of characters other than space and the controls 9 to 13. These
bytes never occur inside a UTF-8 sequence, so the scan works on bytes. Equal runs
of bytes have equal 64-bit hashes; the hashes are the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are scanned at a time; a longer text is scanned alone.
CHUNK_BYTES = 2 << 20
#: Powers are kept for so many places; those of farther places are products of two.
_BLOCK = 1 << 16
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of letters: those of ASCII, and all of characters beyond it.
LETTER = np.zeros(256, dtype=bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that all their bits depend on all bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64))


def _powers(base: np.uint64, size: int) -> np.ndarray:
    """The first powers of the base modulo 2**64, from that of 0."""
    up = np.full(size, base)
    up[0] = 1
    return np.cumprod(up)


_UP, _DOWN = _powers(_BASE, _BLOCK), _powers(_INVERSE, _BLOCK)
_UP_BLOCK, _DOWN_BLOCK = (np.uint64(pow(int(x), _BLOCK, 1 << 64)) for x in (_BASE, _INVERSE))


def text_chunks(
    batches: Iterable[pa.RecordBatch], column: int, limit: int = CHUNK_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Consecutive rows of about ``limit`` bytes with their texts as UTF-8; null gives none."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            part = batch.slice(start, stop - start)
            yield part, [(t or "").encode() for t in part.column(column).to_pylist()]
            start = stop


class Scan:
    """The words and lines of some texts; with ``letters``, words are runs of letters.

    ``word_doc``, ``word_start``, ``word_end`` and ``line_doc``, ``line_start``,
    ``line_end`` are aligned arrays of text numbers and byte places.
    """

    def __init__(self, texts: list[bytes], lower: bool = False, letters: bool = False):
        self.n_docs = len(texts)
        # A line feed after each text ends its last word and line.
        self.data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        if lower:
            self.data = LOWER[self.data]
        sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
        self.doc_end = np.cumsum(sizes) - 1
        inside = LETTER[self.data] if letters else ~WHITE[self.data]
        white = ~inside
        self.word_start = np.flatnonzero(inside & np.concatenate(([True], white[:-1])))
        self.word_end = np.flatnonzero(white & np.concatenate(([False], inside[:-1])))
        self.word_doc = np.searchsorted(self.doc_end, self.word_start, side="right")
        self.line_end = np.flatnonzero(self.data == 10)
        self.line_start = np.concatenate(([0], self.line_end[:-1] + 1))
        self.line_doc = np.searchsorted(self.doc_end, self.line_end, side="left")
        blocks = len(self.data) // _BLOCK + 1
        self._inverse = _powers(_DOWN_BLOCK, blocks)
        self._sum = np.zeros(len(self.data) + 1, dtype=np.uint64)
        for i, power in enumerate(_powers(_UP_BLOCK, blocks)):
            part = _BYTE_VALUE[self.data[i * _BLOCK : (i + 1) * _BLOCK]]
            part *= _UP[: len(part)]
            part *= power
            after = self._sum[i * _BLOCK + 1 : i * _BLOCK + 1 + len(part)]
            np.cumsum(part, out=after)
            after += self._sum[i * _BLOCK]

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The hashes of the byte ranges, wherever they lie."""
        inverse = _DOWN[start % _BLOCK] * self._inverse[start // _BLOCK]
        return mix((self._sum[end] - self._sum[start]) * inverse)

    def word_hashes(self) -> np.ndarray:
        return self.hashes(self.word_start, self.word_end)

    def per_doc(self, doc: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
        """Counts, or sums of whole numbers, by text."""
        if weight is None:
            return np.bincount(doc, minlength=self.n_docs)
        return np.rint(np.bincount(doc, weights=weight, minlength=self.n_docs)).astype(np.int64)

    def runs(self, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every run of ``length`` words within one text."""
        n = len(hashes) - length + 1
        if n <= 0:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        value = np.zeros(n, dtype=np.uint64)
        for i in range(length):
            value = value * _BASE + hashes[i : i + n]
        first = np.flatnonzero(self.word_doc[:n] == self.word_doc[length - 1 :])
        return first, mix(value[first])


def repeated(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For items of texts: whether the value occurs twice or more in its text, and
    whether it occurred there before."""
    key = mix(value ^ mix(doc.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    same = np.zeros(len(key) + 1, dtype=bool)
    same[1:-1] = key[order][1:] == key[order][:-1]
    often = np.empty(len(key), dtype=bool)
    before = np.empty(len(key), dtype=bool)
    before[order] = same[:-1]
    often[order] = same[:-1] | same[1:]
    return often, before
