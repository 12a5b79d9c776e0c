"""Texts turned into fill-in-the-middle samples, and back.

A text is cut into units: a word with the white space before it, or the white space
at the end. Two cuts drawn from a hash of the id part it into prefix, middle and
suffix, which are written in another order behind markers. ``transform`` gives every
row's sample, ``restored`` the text of a sample.

A text is never split into a list of its units. Blocks of ``BLOCK`` bytes are counted,
piece by piece: how many units end in a block, and how many code points begin in it.
Both counts lie in Fenwick trees. Going down the tree by halving steps finds the block
of a cut and what lies before it; the boundary is then found inside that one block.

Defined cases: a null text counts as empty, and an empty text is a plain sample. A
null id is hashed as the empty text. Repeated rows repeat their result, an empty
table gives an empty table, other columns are not read. A text that contains a
marker stays plain, so every sample can be undone. Texts are read whole, whatever
their length; beside the text itself a task holds one piece and the counts of blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally.llm.tables import ship, slices
from gridtally.llm.words import WHITE

BLOCK = 1024
#: Blocks that are counted at a time.
PIECE = 1024 * BLOCK
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"


def _unit_ends(data: np.ndarray, start: int, stop: int) -> np.ndarray:
    """Which bytes of the range are the last of their unit."""
    white = WHITE[data[start : stop + 1]]
    if stop < len(data):
        return ~white[:-1] & white[1:]
    ends = ~white
    ends[:-1] &= white[1:]
    ends[-1] = True
    return ends


def _begins(data: np.ndarray) -> np.ndarray:
    """Which bytes begin a code point."""
    return (data & 0xC0) != 0x80


def _fenwick(counts: np.ndarray) -> np.ndarray:
    """Node i holds the sum of the last (i & -i) counts up to the i-th."""
    upto = np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum(counts)))
    node = np.arange(len(upto))
    return upto - upto[node - (node & -node)]


class CutTree:
    """Counts of units and code points by block of a text in UTF-8."""

    def __init__(self, text: bytes, block: int = BLOCK, piece: int = PIECE):
        self.block = block
        self.data = np.frombuffer(text, dtype=np.uint8)
        units, points = [], []
        for start in range(0, len(self.data), piece):
            stop = min(start + piece, len(self.data))
            edges = np.arange(0, stop - start, block)
            ends = _unit_ends(self.data, start, stop)
            units.append(np.add.reduceat(ends, edges, dtype=np.int64))
            points.append(np.add.reduceat(_begins(self.data[start:stop]), edges, dtype=np.int64))
        none = np.zeros(0, dtype=np.int64)
        counts = np.concatenate([none, *units])
        self.blocks = len(counts)
        self.n = int(counts.sum())
        self.units = _fenwick(counts)
        self.points = _fenwick(np.concatenate([none, *points]))

    def cut(self, k: int) -> tuple[int, int]:
        """(bytes, code points) of the first ``k`` units."""
        if k == 0:
            return 0, 0
        at = points = 0
        step = 1 << self.blocks.bit_length()
        while step := step >> 1:
            if at + step <= self.blocks and self.units[at + step] < k:
                at += step
                k -= int(self.units[at])
                points += int(self.points[at])
        start = at * self.block
        ends = _unit_ends(self.data, start, min(start + self.block, len(self.data)))
        inside = int(np.flatnonzero(ends)[k - 1]) + 1
        return start + inside, points + int(_begins(self.data[start : start + inside]).sum())


@dataclass(frozen=True)
class Sample:
    n: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    output: str


def draws(seed: int, doc_id: object) -> list[int]:
    """Four numbers below 2**32 from the seed and the id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def sample(
    doc_id: object, text: str | None, seed: int = 42, rate: int = 50, spm_rate: int = 80, block: int = BLOCK
) -> Sample:
    """The sample of one text; the rates are percentages, of samples and of SPM among them."""
    data = (text or "").encode()
    tree = CutTree(data, block)
    one, two, chance, order = draws(seed, doc_id)
    marked = any(m.encode() in data for m in (PREFIX, SUFFIX, MIDDLE))
    if not data or marked or chance % 100 >= rate:
        return Sample(tree.n, PLAIN, None, None, text or "")
    first, second = sorted((one % (tree.n + 1), two % (tree.n + 1)))
    (a, a_chars), (b, b_chars) = tree.cut(first), tree.cut(second)
    prefix, middle, suffix = (part.decode() for part in (data[:a], data[a:b], data[b:]))
    if order % 100 < spm_rate:
        form, output = SPM, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    else:
        form, output = PSM, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return Sample(tree.n, form, a_chars, b_chars - a_chars, output)


def transform(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 42,
    rate: int = 50,
    spm_rate: int = 80,
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row; no shuffle.

    ``n`` counts the units; the numbers of code points are null for a plain sample.
    """
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, texts = (c.to_pylist() for c in batch.columns)
            made = [sample(i, t, seed, rate, spm_rate) for i, t in zip(ids, texts)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([s.n for s in made], pa.int64()),
                    pa.array([s.form for s in made], pa.string()),
                    pa.array([s.prefix_chars for s in made], pa.int64()),
                    pa.array([s.middle_chars for s in made], pa.int64()),
                    pa.array([s.output for s in made], pa.string()),
                ],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    )


def restored(output: Column, form: Column) -> Column:
    """The text of a sample; no text of a sample with markers contains one itself."""
    body = F.substr(output, F.lit(len(PREFIX) + 1))

    def parts(second: str) -> tuple[Column, Column, Column]:
        behind = F.substring_index(body, second, -1)
        return (
            F.substring_index(body, second, 1),
            F.substring_index(behind, MIDDLE, 1),
            F.substring_index(behind, MIDDLE, -1),
        )

    prefix, suffix, middle = parts(SUFFIX)
    spm_suffix, spm_prefix, spm_middle = parts(PREFIX)
    return (
        F.when(form == PSM, F.concat(prefix, middle, suffix))
        .when(form == SPM, F.concat(spm_prefix, spm_middle, spm_suffix))
        .otherwise(output)
    )


ORACLE_SQL = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
         sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
  FROM documents
), draws AS (
  SELECT *, CAST(len(units) AS BIGINT) AS n,
         CAST('0x' || substr(digest, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(digest, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(digest, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(digest, 25, 8) AS BIGINT) AS h4
  FROM units
), cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM draws
), parts AS (
  SELECT *, coalesce(array_to_string(units[1:a], ''), '') AS prefix,
         coalesce(array_to_string(units[a + 1:b], ''), '') AS middle,
         coalesce(array_to_string(units[b + 1:n], ''), '') AS suffix
  FROM cuts
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(prefix || middle || suffix) AS restored_sha256
FROM parts
"""
