"""Byte-pair encoding by backtracking over longest matches, and decoding by offsets.

``encode`` gives every row of a table the token ids of its whole text, ``decode``
the text of its ids. An Aho-Corasick pass finds all vocabulary entries in a
piece of text. The encoder takes the longest one at each place if it may follow
the token before it, else shorter ones, and steps back from a place from which
nothing leads on. Whether two tokens may stand side by side is decided by undoing
their merges at the border, latest first; the answers fill a table. A place is
given up once at most, so the time is linear in the text, and the result is that
of applying the merges in order.

Decoding looks up each id's bytes in one block by a table of offsets.

Defined cases: null text encodes as empty text, no ids. Repeated rows repeat their
result, an empty table gives an empty table, other columns are not read. Texts of
any length are encoded whole. Strings of special tokens become their ids, as the
vocabulary file demands. Bytes that are no UTF-8 decode to U+FFFD.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from gridtally.llm.tables import ship, slices

# Fixed value: the pattern that splits text for this kind of vocabulary.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words, pieces and token pairs remembered by a worker; a full table is emptied.
MEMO_WORDS = 500_000
MEMO_PIECES = 300_000
MEMO_PAIRS = 200_000
#: Longer pieces are not remembered.
MEMO_LENGTH = 64


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def load_vocabulary(path: str) -> dict:
    """Token bytes, merges and special tokens of a byte-level tokenizer file.

    Its size is that of the file; it is the only thing that is broadcast.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    symbol = byte_symbols()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ids = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
    token_bytes = [b""] * (1 + max([*ids.values(), *special.values()]))
    for text, i in ids.items():
        token_bytes[i] = bytes(symbol[c] for c in text)
    for text, i in special.items():
        token_bytes[i] = text.encode()
    merges = []
    for merge in spec["model"]["merges"]:
        left, right = merge if isinstance(merge, list) else merge.split(" ")
        merges.append((ids[left], ids[right], ids[left + right]))
    return {"tokens": token_bytes, "merges": merges, "special": special}


def pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Encoder:
    """The tables of one vocabulary, kept by a worker for all its tasks."""

    def __init__(self, vocabulary: dict):
        tokens = vocabulary["tokens"]
        self.size = [len(t) for t in tokens]
        self.rank = [-1] * len(tokens)
        self.halves: list[tuple[int, int] | None] = [None] * len(tokens)
        self.merge_rank = {}
        for rank, (left, right, whole) in enumerate(vocabulary["merges"]):
            self.merge_rank[left, right] = rank
            self.rank[whole], self.halves[whole] = rank, (left, right)
        special = set(vocabulary["special"].values())
        index = {token: i for i, token in enumerate(tokens) if token and i not in special}
        #: The longest token that is a proper prefix of each token, or -1.
        self.shorter = [
            next((index[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in index), -1) for t in tokens
        ]
        self.words = ahocorasick.Automaton()
        for token, i in index.items():
            self.words.add_word(token.decode("latin-1"), i)
        self.words.make_automaton()
        self.special = vocabulary["special"]
        names = sorted(self.special, key=len, reverse=True)
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.split = regex.compile(SPLIT)
        self.pairs: dict[tuple[int, int], bool] = {}
        self.pieces: dict[str, bytes] = {}
        self.words_seen: dict[str, bytes] = {}

    def may_follow(self, left: int, right: int) -> bool:
        """Whether the merges leave these two tokens as they are."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= MEMO_PAIRS:
                self.pairs.clear()
            known = self.pairs[left, right] = self._stay_apart(left, right)
        return known

    def _stay_apart(self, left: int, right: int) -> bool:
        before = len(self.merge_rank)
        while True:
            if self.merge_rank.get((left, right), before) < before:
                return False  # these parts would have been merged before the whole came about
            if self.rank[left] > self.rank[right]:
                # Among equal merges the left one is done first.
                before, left = self.rank[left], self.halves[left][1]
            elif self.halves[right] is not None:
                before, right = self.rank[right] + 1, self.halves[right][0]
            else:
                return True

    def piece_ids(self, piece: bytes) -> list[int]:
        """The ids of a piece that the merges see as a whole."""
        n = len(piece)
        longest = [-1] * (n + 1)  # the longest token from each place
        size, shorter, pairs = self.size, self.shorter, self.pairs
        for end, token in self.words.iter(piece.decode("latin-1")):
            longest[end + 1 - size[token]] = token
        ids: list[int] = []
        given_up = bytearray(n + 1)
        place, last, token = 0, -1, longest[0]
        while place < n:
            while token >= 0:
                if not given_up[place + size[token]]:
                    if last < 0 or pairs.get((last, token)) or self.may_follow(last, token):
                        break
                token = shorter[token]
            if token >= 0:
                ids.append(token)
                place += size[token]
                last, token = token, longest[place]
            else:
                given_up[place] = 1
                if not ids:
                    raise ValueError("the vocabulary lacks a byte of the text")
                token = ids.pop()
                place -= size[token]
                last, token = ids[-1] if ids else -1, shorter[token]
        return ids

    def _pieces(self, text: str) -> bytes:
        """The ids of text that the pattern splits into pieces."""
        known = self.pieces
        parts = []
        for piece in self.split.findall(text):
            ids = known.get(piece)
            if ids is None:
                ids = pack(self.piece_ids(piece.encode()))
                if len(piece) <= MEMO_LENGTH:
                    if len(known) >= MEMO_PIECES:
                        known.clear()
                    known[piece] = ids
            parts.append(ids)
        return b"".join(parts)

    def _plain(self, text: str) -> bytes:
        """The ids of text without special tokens.

        A single space between other characters always begins a piece, so words
        between such spaces are coded, and remembered, one by one.
        """
        first, *words = text.split(" ")
        parts = list(map(self.words_seen.get, words))
        if None in parts:
            for i, ids in enumerate(parts):
                if ids is None:
                    word = words[i]
                    if not word or word[0].isspace() or word[-1].isspace():
                        return self._pieces(text)
                    parts[i] = ids = self._pieces(" " + word)
                    if len(word) <= MEMO_LENGTH and "\n" not in word:
                        if len(self.words_seen) >= MEMO_WORDS:
                            self.words_seen.clear()
                        self.words_seen[word] = ids
        if first and first[-1].isspace() and words:
            return self._pieces(text)
        return self._pieces(first) + b"".join(parts)

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if self.at_special is None or not self.at_special.search(text):
            return self._plain(text)
        parts = []
        for i, part in enumerate(self.at_special.split(text)):
            parts.append(pack([self.special[part]]) if i % 2 else self._plain(part))
        return b"".join(parts)


class Decoder:
    """All token bytes in one block, with the offset of each id."""

    def __init__(self, vocabulary: dict):
        tokens = vocabulary["tokens"]
        self.block = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.offsets = np.zeros(len(tokens) + 1, dtype=np.int64)
        np.cumsum([len(t) for t in tokens], out=self.offsets[1:])

    def decode(self, ids: np.ndarray) -> str:
        start = self.offsets[ids]
        size = self.offsets[ids + 1] - start
        place = np.cumsum(size) - size
        at = np.repeat(start - place, size) + np.arange(int(size.sum()))
        return self.block[at].tobytes().decode("utf-8", errors="replace")


_encoders: dict[str, Encoder] = {}
_decoders: dict[str, Decoder] = {}


def _kept(cache: dict, kind, key: str, vocabulary) -> Encoder | Decoder:
    """One set of tables per worker; another vocabulary replaces it."""
    if key not in cache:
        cache.clear()
        cache[key] = kind(vocabulary.value)
    return cache[key]


def _type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every row; ``path`` names the tokenizer file on the driver."""
    spark = docs.sparkSession
    ship(spark)
    vocabulary = spark.sparkContext.broadcast(load_vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _kept(_encoders, Encoder, path, vocabulary)
        for batch in slices(batches):
            coded = [encoder.encode(t or "") for t in batch.column(1).to_pylist()]
            flat = np.frombuffer(b"".join(coded), dtype="<u4").astype(np.int32)
            ends = np.cumsum([0] + [len(c) // 4 for c in coded])
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=[id_col, "ids"])

    schema = f"`{id_col}` {_type(docs, id_col)}, ids array<int>"
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def decode(
    coded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids"
) -> DataFrame:
    """(id, ids, text): the text of every row's ids, special tokens included."""
    spark = coded.sparkSession
    ship(spark)
    vocabulary = spark.sparkContext.broadcast(load_vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _kept(_decoders, Decoder, path, vocabulary)
        for batch in slices(batches):
            lists = batch.column(1)
            texts = [
                decoder.decode(lists[i].values.to_numpy(zero_copy_only=False)) if lists[i].is_valid else ""
                for i in range(batch.num_rows)
            ]
            text = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, text], names=[id_col, "ids", "text"])

    schema = f"`{id_col}` {_type(coded, id_col)}, ids array<int>, text string"
    return coded.select(id_col, ids_col).mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row: encoded and decoded again in one pass.

    The ids are digested as little-endian unsigned 32-bit integers, the text in UTF-8.
    """
    spark = docs.sparkSession
    ship(spark)
    vocabulary = spark.sparkContext.broadcast(load_vocabulary(path))
    names = ["n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _kept(_encoders, Encoder, path, vocabulary)
        decoder = _kept(_decoders, Decoder, path, vocabulary)
        for batch in slices(batches):
            coded = [encoder.encode(t or "") for t in batch.column(1).to_pylist()]
            texts = (decoder.decode(np.frombuffer(c, dtype="<u4")) for c in coded)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(c) // 4 for c in coded], pa.int64()),
                    pa.array([hashlib.sha256(c).hexdigest() for c in coded]),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts]),
                ],
                names=[id_col, *names],
            )

    schema = f"`{id_col}` {_type(docs, id_col)}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return docs.select(id_col, text_col).mapInArrow(run, schema)
