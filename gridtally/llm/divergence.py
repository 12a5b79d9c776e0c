"""How the sources of each language differ in their words.

``audit`` compares the word shares of every (language, source) group with those of the
other sources of the language, and with the language itself.

Words are counted in slices of texts and summed by group and word. Each language keeps
the words of at least ``least_docs`` of its documents. The comparison of all groups
over all words is a cube of (group block, group block, word block) cells. A task owns
a cell: it gets the counts of two blocks of groups for one block of words, at most
about ``GROUPS`` by ``WORDS`` numbers each, so a cell's size does not depend on how
large a language or a source is. A slice of counts is sent to the cells of its
group block and word block. Cells give partial divergences of their pairs of groups
and, on the diagonal, their leading words; sums and ranks along the word axis finish.

Shares are whole numbers: 1 + floor(scale * (count + prior) / (total + prior * words)),
also for words that a group does not have. Products beyond 64 bits are computed exactly.

Defined cases: null text, language and source count as empty. A group without kept
words has the share of no count for each, and a language without any gives divergences
of 0. A word is a run of ASCII letters and characters beyond ASCII; only A to Z are
lower-cased. Repeated rows count as often as they occur; an empty table gives an
empty table; other columns are not read. Texts are read whole, long ones in pieces.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridtally.llm.groups import join_keyed
from gridtally.llm.tables import ship, staged
from gridtally.llm.words import LETTER, LOWER, text_chunks

#: Groups and words of a block, about: blocks are dealt by hash.
GROUPS = 64
WORDS = 4096
#: Bytes of text that are counted together; longer texts are counted in such pieces.
CHUNK_BYTES = 8 << 20
COUNTS = "lang string, source string, term string, n bigint, n_docs bigint"
FOUND = "lang string, source string, part string, item string, value bigint"


def terms_of(texts: list[bytes]) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
    """(distinct words, word number and text number of every word of the texts)."""
    data = LOWER[np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)]
    inside = LETTER[data]
    start = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    if inside[0]:
        start = np.concatenate((np.zeros(1, dtype=start.dtype), start))
    end = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    offsets = np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum(end - start))).astype(np.int32)
    letters = np.ascontiguousarray(data[inside])
    words = pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(letters))
    coded = words.dictionary_encode()
    doc_end = np.cumsum([len(t) + 1 for t in texts])
    doc = np.searchsorted(doc_end, start, side="right")
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), doc


def _pieces(text: bytes, size: int) -> Iterator[bytes]:
    """The text in pieces of about ``size`` bytes that break no word."""
    start = 0
    while start < len(text):
        stop = start + size
        while stop < len(text) and LETTER[text[stop - 1]] and LETTER[text[stop]]:
            stop += 1
        yield text[start:stop]
        start = stop


def _counted(texts: list[bytes], group: np.ndarray, size: int) -> tuple:
    """(words, group number, word number, occurrences, texts) of what the texts hold."""
    if len(texts) == 1 and len(texts[0]) > size:
        tally: Counter = Counter()
        for piece in _pieces(texts[0], size):
            terms, term, _ = terms_of([piece])
            tally.update(dict(zip(terms.to_pylist(), np.bincount(term, minlength=len(terms)).tolist())))
        n = np.fromiter(tally.values(), dtype=np.int64, count=len(tally))
        number = np.arange(len(tally))
        return pa.array(tally, pa.string()), np.full(len(n), group[0]), number, n, np.ones_like(n)
    terms, term, doc = terms_of(texts)
    width = max(len(terms), 1)
    in_doc, n = np.unique(doc * width + term, return_counts=True)
    key, place = np.unique(group[in_doc // width] * width + in_doc % width, return_inverse=True)
    total = np.rint(np.bincount(place, weights=n, minlength=len(key))).astype(np.int64)
    return terms, key // width, key % width, total, np.bincount(place, minlength=len(key))


def term_counts(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source"
) -> DataFrame:
    """(lang, source, term, n, n_docs): occurrences of a word in a group, and its texts there."""
    ship(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches, 0, CHUNK_BYTES):
            names = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()))
            groups = {name: i for i, name in enumerate(dict.fromkeys(names))}
            member = np.array([groups[name] for name in names], dtype=np.int64)
            terms, group, term, n, n_docs = _counted(texts, member, CHUNK_BYTES)
            langs, sources = (pa.array(x, pa.string()) for x in zip(*groups))
            of = pa.array(group)
            yield pa.RecordBatch.from_arrays(
                [langs.take(of), sources.take(of), terms.take(pa.array(term)), pa.array(n), pa.array(n_docs)],
                names=["lang", "source", "term", "n", "n_docs"],
            )

    return (
        _named(docs, text_col, lang_col, source_col)
        .mapInArrow(count, COUNTS)
        .groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))
    )


def _named(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    columns = {"text": text_col, "lang": lang_col, "source": source_col}
    return docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(name) for name, c in columns.items()])


def shares(counts: np.ndarray, total: int, words: int, scale: int, prior: int) -> np.ndarray:
    """1 + floor(scale * (count + prior) / (total + prior * words)) of whole numbers, exactly."""
    whole = total + prior * words
    if not len(counts):
        return counts.astype(np.int64)
    if max(scale * (int(counts.max()) + prior), whole) < 1 << 63:
        return 1 + scale * (counts + prior) // whole
    return np.array([1 + scale * (int(c) + prior) // whole for c in counts], dtype=np.int64)


def _table(rows: list[tuple]) -> pa.Table:
    kinds = [pa.string()] * 4 + [pa.int64()]
    columns = list(zip(*rows)) or [()] * 5
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["lang", "source", "part", "item", "value"])


def _cell(cell: pa.Table, scale: int, prior: int, top: int) -> pa.Table:
    """Partial divergences of the pairs of a cell, and its leading words by group."""
    col = {name: cell.column(name).to_pylist() for name in ("kind", "source", "term", "block")}
    num = {name: cell.column(name).to_numpy() for name in ("place", "n", "words", "lang_n")}
    kind = np.array(col["kind"])
    lang, a, b = (cell.column(name)[0].as_py() for name in ("lang", "a", "b"))
    word_rows = np.flatnonzero(kind == "word")
    terms = [""] * len(word_rows)
    of_lang = np.zeros(len(word_rows), dtype=np.int64)
    for row in word_rows:
        terms[int(num["place"][row])] = col["term"][row]
        of_lang[int(num["place"][row])] = num["n"][row]

    if "group" not in kind:
        return _table([])
    group_rows = sorted(np.flatnonzero(kind == "group").tolist(), key=lambda r: col["source"][r])
    names = [col["source"][r] for r in group_rows]
    number = {name: i for i, name in enumerate(names)}
    block = np.array([col["block"][r] for r in group_rows])
    count = np.zeros((len(names), len(terms)), dtype=np.int64)
    rows = np.flatnonzero(kind == "count")
    of = np.array([number[col["source"][r]] for r in rows], dtype=np.int64)
    count[of, num["place"][rows].astype(np.int64)] = num["n"][rows].astype(np.int64)
    first = group_rows[0]
    words, lang_n = int(num["words"][first]), int(num["lang_n"][first])
    share = np.stack([shares(count[i], int(num["n"][r]), words, scale, prior) for i, r in enumerate(group_rows)])

    out: list[tuple] = []
    for i, name in enumerate(names):
        # a cell of one block compares each pair once, one of two blocks only across
        others = np.arange(i + 1, len(names)) if a == b else np.flatnonzero(block == b)
        if a != b and block[i] != a:
            continue
        apart = np.abs(share[others] - share[i]).sum(axis=1).tolist()
        for j, value in zip(others.tolist(), apart):
            out.append((lang, name, "pair", names[j], value))
            out.append((lang, names[j], "pair", name, value))
    if a == b and terms:
        usual = shares(of_lang, lang_n, words, scale, prior)
        for i, name in enumerate(names):
            more = share[i] - usual
            found = np.flatnonzero((count[i] > 0) & (more > 0))
            # places of words follow their order, so ties come in it too
            lead = found[np.argsort(-more[found], kind="stable")[:top]]
            out.extend((lang, name, "term", terms[t], int(more[t])) for t in lead)
    return _table(out)


def audit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least_docs: int = 30,
    scale: int = 1_000_000_000,
    prior: int = 5,
    top: int = 50,
) -> DataFrame:
    """(lang, source, part, item, value, rank) of every group.

    Part ``pair`` has each other source of the language with the sum of differences of
    shares, part ``term`` the ``top`` words whose share exceeds that of the language most.
    """
    # Every step below reads written tables, so a lost executor repeats one step.
    counts = staged(term_counts(docs, text_col, lang_col, source_col), "term-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))
    kept = staged(kept.filter(F.col("n_docs") >= least_docs).drop("n_docs"), "terms")
    groups = staged(_named(docs, text_col, lang_col, source_col).select("lang", "source").distinct(), "groups")
    sizes = groups.groupBy("lang").agg(F.count("*").alias("sources"))
    totals = kept.groupBy("lang").agg(F.count("*").alias("words"), F.sum("n").alias("lang_n"))
    none = F.lit(0).cast("long")
    langs = sizes.join(totals, "lang", "left").select(
        "lang",
        "sources",
        F.coalesce("words", none).alias("words"),
        F.coalesce("lang_n", none).alias("lang_n"),
        F.ceil(F.col("sources") / GROUPS).cast("int").alias("group_blocks"),
        F.greatest(F.ceil(F.coalesce("words", none) / WORDS), F.lit(1)).cast("int").alias("word_blocks"),
    )
    langs = staged(langs, "languages")

    # Words numbered in their order within blocks of bounded size.
    plan = langs.select("lang", "words", "group_blocks", "word_blocks")
    words = join_keyed(kept, plan, "lang", "words", kept.count())
    words = words.withColumn("word_block", F.pmod(F.xxhash64("term"), "word_blocks").cast("int"))
    place = F.row_number().over(Window.partitionBy("lang", "word_block").orderBy("term")) - 1
    words = staged(words.withColumn("place", place), "words")

    found = words.select("lang", "term", "group_blocks", "word_block", "place")
    found = staged(counts.join(found, ["lang", "term"]), "kept-counts")
    own = found.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    named = join_keyed(groups, langs, "lang", "sources", groups.count()).join(own, ["lang", "source"], "left")

    empty = {"source": "string", "term": "string", "place": "int", "block": "int", "words": "bigint", "lang_n": "bigint"}

    def cells(rows: DataFrame, kind: str, block: str | None) -> DataFrame:
        """The rows, each in every cell that needs it."""
        last = F.col("group_blocks") - 1
        if block is None:
            rows = rows.withColumn("a", F.explode(F.sequence(F.lit(0), last)))
            rows = rows.withColumn("b", F.explode(F.sequence(F.col("a"), last)))
        else:
            rows = rows.withColumn("block", F.pmod(F.xxhash64(block), "group_blocks").cast("int"))
            rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), last)))
            rows = rows.withColumns({"a": F.least("block", "other"), "b": F.greatest("block", "other")})
        there = set(rows.columns)
        return rows.select(
            "lang", "a", "b", "word_block", F.lit(kind).alias("kind"), "n",
            *[F.col(c) if c in there else F.lit(None).cast(t).alias(c) for c, t in empty.items()],
        )

    all_blocks = F.explode(F.sequence(F.lit(0), F.col("word_blocks") - 1)).alias("word_block")
    placed = named.select("lang", "source", F.coalesce("n", none).alias("n"), "words", "lang_n", "group_blocks", all_blocks)
    dealt = (
        cells(placed, "group", "source")
        .unionByName(cells(words.drop("words"), "word", None))
        .unionByName(cells(found.drop("term", "n_docs"), "count", "source"))
    )
    parts = dealt.groupBy("lang", "a", "b", "word_block").applyInArrow(
        lambda cell: _cell(cell, scale, prior, top), FOUND
    )
    whole = parts.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = whole.withColumn("rank", F.row_number().over(order))
    return ranked.filter((F.col("part") == "pair") | (F.col("rank") <= top))


ORACLE_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
), terms AS (
  SELECT d, lang, source, unnest(words) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS n FROM terms GROUP BY lang, term HAVING count(DISTINCT d) >= 30
), langs AS (
  SELECT lang, count(*) AS v, CAST(sum(n) AS HUGEINT) AS total FROM kept GROUP BY lang
), names AS (
  SELECT DISTINCT lang, source FROM docs
), counts AS (
  SELECT t.lang, t.source, t.term, count(*) AS n FROM terms t JOIN kept k ON t.lang = k.lang AND t.term = k.term
  GROUP BY t.lang, t.source, t.term
), totals AS (
  SELECT lang, source, CAST(sum(n) AS HUGEINT) AS total FROM counts GROUP BY lang, source
), shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         CAST(1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(t.total, 0) + 5 * l.v) AS BIGINT) AS p,
         CAST(1 + (1000000000::HUGEINT * (k.n + 5)) // (l.total + 5 * l.v) AS BIGINT) AS usual
  FROM names g JOIN kept k ON g.lang = k.lang JOIN langs l ON g.lang = l.lang
  LEFT JOIN totals t ON g.lang = t.lang AND g.source = t.source
  LEFT JOIN counts c ON g.lang = c.lang AND g.source = c.source AND k.term = c.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(p.value, 0) AS BIGINT) AS value
  FROM names a JOIN names b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON a.lang = p.lang AND a.source = p.source AND b.source = p.item
  UNION ALL
  SELECT lang, source, 'term', term, p - usual FROM shares WHERE n > 0 AND p > usual
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM parts
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
