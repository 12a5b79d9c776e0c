"""Secrets in texts, with multipart credentials linked within scopes.

Base spans are assignments, access identifiers and long hexadecimal runs. Three
more kinds are weak by themselves: names in identifier settings, tokens that look
random, and endpoints. A scope is a stretch of text without an empty line. The value of
a setting (what follows a colon or an equals sign) joins complementary parts of its
scope at any distance; a part in running text joins those with at most ``REACH`` code
points between their intervals.
A weak identifier is reported if a secret joins it, a random token if an identifier
joins it, an endpoint if an identifier and a secret join it. For each role the
nearest interval before and after decides, so the join is a search in sorted
intervals and never lists pairs.

Places count code points, the end is exclusive. Defined cases: null text is empty
and has no spans. Repeated rows repeat their result, an empty table gives an empty
table, other columns are kept by ``redact`` and not read by ``find``. Ties in the
start go by the order of ``KINDS``. Texts of any length are read whole.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.llm.tables import ship, slices

#: How far a part that is not the value of a setting reaches.
REACH = 200
ENTROPY = 3.5
KINDS = ["assign", "access", "hex", "identifier", "token", "endpoint"]
BASE = KINDS[:3]
MASK = "[secret]"

# The forms of the base spans.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_VALUE = 12
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
# The least lengths are part of the patterns: a run that is too short gives no match.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")

NAMED = re.compile(
    r"""(?<![A-Za-z0-9])(?:access[_-]?key(?:[_-]?id)?|client[_-]?id|account[_-]?id|user(?:[_-]?name)?|login)"""
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@-]{4,})""",
    re.IGNORECASE | re.ASCII,
)
NAMED_WORDS = ("access", "client", "account", "user", "login")
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}", re.ASCII)
ENDPOINT = re.compile(
    r"""[A-Za-z][A-Za-z0-9+.-]{1,20}://[^\s"'<>]+"""
    r"""|(?<![A-Za-z0-9])(?:endpoint|host(?:name)?|server|region)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.:/-]{3,}""",
    re.IGNORECASE | re.ASCII,
)

URI = re.compile(r"[A-Za-z][A-Za-z0-9+.-]{1,20}://")

Span = tuple[int, int, str]


def is_setting(text: str, start: int) -> bool:
    """Whether what begins here is the value of a setting, however many blanks lie before it."""
    while start and text[start - 1] in " \t\r\n\"'":
        start -= 1
    return start > 0 and text[start - 1] in ":="


def base_spans(text: str, lower: str) -> list[Span]:
    found = []
    if any(word in lower for word in ASSIGN_WORDS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= ASSIGN_VALUE:
                found.append((m.start(), m.end(), "assign"))
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


def looks_random(token: str) -> bool:
    """Letters of both cases and digits, evenly mixed."""
    if not (re.search("[a-z]", token) and re.search("[A-Z]", token) and re.search("[0-9]", token)):
        return False
    n = len(token)
    return -sum(c / n * math.log2(c / n) for c in Counter(token).values()) >= ENTROPY


class Role:
    """The disjoint or nested intervals of one role, sorted, for searches by distance."""

    def __init__(self, spans: list[Span]):
        self.starts, self.ends = [], []
        for start, end, _ in sorted(spans):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def joins(self, span: Span, scopes: list[int], setting: bool) -> bool:
        """Whether an interval lies in the same scope, and within reach but for settings."""
        start, end, _ = span
        i = bisect_left(self.starts, start)
        for k in (i - 1, i):
            if 0 <= k < len(self.starts):
                gap = max(self.starts[k] - end, start - self.ends[k])
                same = bisect_left(scopes, start + 1) == bisect_left(scopes, self.starts[k] + 1)
                if same and (setting or gap <= REACH):
                    return True
        return False


def linked_spans(text: str, lower: str, base: list[Span]) -> list[Span]:
    """Weak parts that complementary parts join."""
    names = []
    if any(word in lower for word in NAMED_WORDS):
        names = [(m.start(), m.end(), "identifier") for m in NAMED.finditer(text)]
    strong_ids = [s for s in base if s[2] == "access"]
    if not names and not strong_ids:
        return []
    scopes = [m.start() for m in re.finditer(r"\n[ \t\r]*\n", text)]
    ids = Role(names + strong_ids)
    secrets = [s for s in base if s[2] != "access"]
    taken = Role(base + names)
    tokens = []
    for m in TOKEN.finditer(text):
        span = (m.start(), m.end(), "token")
        i = bisect_left(taken.starts, span[1]) - 1
        if (i < 0 or taken.ends[i] <= span[0]) and looks_random(m[0]):
            if ids.joins(span, scopes, is_setting(text, span[0])):
                tokens.append(span)
    keys = Role(secrets + tokens)
    found = tokens + [s for s in names if keys.joins(s, scopes, True)]
    for m in ENDPOINT.finditer(text):
        span = (m.start(), m.end(), "endpoint")
        setting = not URI.match(m[0]) or is_setting(text, span[0])
        if ids.joins(span, scopes, setting) and keys.joins(span, scopes, setting):
            found.append(span)
    return found


def spans_of(text: str | None) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), each by start and kind."""
    text = text or ""
    lower = text.lower()
    base = base_spans(text, lower)
    order = lambda s: (s[0], KINDS.index(s[2]), s[1])
    return sorted(base, key=order), sorted(base + linked_spans(text, lower, base), key=order)


def _join(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts by base kind, the digest of the base spans and all spans of every row."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts = {k: [] for k in BASE}
            digest, spans = [], []
            for text in batch.column(1).to_pylist():
                base, every = spans_of(text)
                for k in BASE:
                    counts[k].append(sum(s[2] == k for s in base))
                digest.append(hashlib.sha256(_join(base).encode()).hexdigest())
                spans.append(_join(every))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(counts[k], pa.int64()) for k in BASE), pa.array(digest), pa.array(spans)],
                names=[id_col, *(f"n_{k}" for k in BASE), "base_sha256", "spans"],
            )

    longs = ", ".join(f"n_{k} bigint" for k in BASE)
    schema = f"`{id_col}` {kind}, {longs}, base_sha256 string, spans string"
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def masked(text: str | None) -> str | None:
    """The text with every secret part replaced; endpoints stay."""
    if text is None:
        return None
    _, every = spans_of(text)
    hidden = Role([s for s in every if s[2] != "endpoint"])
    parts, done = [], 0
    for start, end in zip(hidden.starts, hidden.ends):
        parts += [text[done:start], MASK]
        done = end
    return "".join([*parts, text[done:]])


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with their secrets masked; all columns stay in order."""
    ship(docs.sparkSession)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [masked(t) for t in batch.column(place).to_pylist()]
            yield batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))

    return docs.mapInArrow(run, docs.schema)


def redacted_documents(docs: DataFrame) -> DataFrame:
    """``redact`` with the character count brought up to date."""
    return redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)
