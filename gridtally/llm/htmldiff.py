"""Main text of pages by differencing each page against the one with the nearest URL.

Pages are sorted by host and URL path, and each is paired with the page before it, or
after it if there is none. Their lines of text are aligned by a longest common
subsequence, and a page loses the lines it shares: what neighbours repeat is template.

Differencing alone gives wrong results in three cases, which the page's own marking
settles. Lines inside the article element are never template: copies and quoted
passages share them. Lines inside elements marked as menu, header, footer, sidebar,
notice, advert, form or comments go even if no neighbour repeats them. The element's
name or role marks it, or a class or id all of whose words name boilerplate or layout.
A class or id does not mark html, body, main and article, nor an inline element, nor
what holds an article element outside of any other, nor what holds most of the text, in
an article or on a page without one. Inline elements never part a line. And a neighbour that shares nearly all of a page's text is a copy; the other neighbour
is asked. All
other lines are decided by differencing, also on pages that have an article element.
Only a page without a neighbour to ask loses the lines outside its article element.

The sorted pages are cut into ranges of about equal count, whatever their hosts, and
the last and first page of each range go to the next and previous range as well. So
no host meets in one task and every page meets its nearest URL: the ranges, which come
from a sample of the keys, decide no result.

Defined cases: null html is empty, empty pages give empty text. A null URL counts as an
empty host and path. Ties in the path go by page id. Repeated rows are copies. An
empty table gives an empty table, other columns are not read, pages of any length are
read whole.
"""

from __future__ import annotations

import html
import re
import zlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.llm.tables import ship, slices

#: A neighbour with at least this share of equal text is a copy.
COPY_SHARE = 0.9
#: Pages of a range at least, on average.
CELL_PAGES = 64
#: Keys sampled for each range.
SAMPLE_KEYS = 60
#: Bits of alignment table that are kept at a time.
TABLE_BITS = 1 << 28

RAW = "script|style|template|noscript|iframe|textarea|title|svg|math|select|object|canvas"
TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"""
    r"""|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*+)>"""
    r"""|<[/!?a-zA-Z][^>]*(?:>|\Z)|(?P<text>[^<]+|<)""",
    re.DOTALL | re.IGNORECASE,
)
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp"
    " small span strike strong sub sup time tt u var wbr".split()
)
#: Void elements that end a line; the others neither show nor part text.
BREAKS = set("br hr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = set("nav aside footer form button dialog menu fieldset".split())
ROLES = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
NAMES = set(
    "ad ads adv advert advertisement adbox sponsor sponsored promo promotion banner cookie cookies consent gdpr"
    " notice notification alert sidebar side rail menu nav navbar navigation breadcrumb breadcrumbs topbar footer"
    " header masthead comment comments disqus reply replies respond share sharing social related recommended"
    " newsletter subscribe signup login popup modal overlay widget pagination pager toc skip".split()
)
#: Words that say where or how something is shown; they go with one of ``NAMES``.
LAYOUT = set(
    "site page main top bottom left right global primary secondary box block wrapper wrap container list section area"
    " bar item items inner outer panel pane region column col row content unit slot space zone group button buttons"
    " link links icon icons form field message text title small large big fixed sticky mobile desktop".split()
)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.IGNORECASE)
#: Elements that hold the content whatever their classes and ids.
CONTENT = set("html body main article".split())
INSIDE, OUTSIDE, MARKED = "A", "B", "C"

Line = tuple[str, str]


def _by_tag(name: str, attrs: str, in_article: bool) -> bool:
    """Whether the element's name or role marks it."""
    if name in DROPPED or name == "header" and not in_article:
        return True
    return name not in CONTENT and any(
        kind.lower() == "role" and ROLES & set(value.strip("\"'").lower().split())
        for kind, value in ATTRIBUTE.findall(attrs)
    )


def _unmistakable(word: str) -> bool:
    """Whether a class or id names boilerplate and nothing else: ``cookie-banner``, not ``share-of-market``."""
    parts = [p for p in re.split(r"[-_]+", word) if p and not p.isdigit()]
    return any(p in NAMES for p in parts) and all(p in NAMES or p in LAYOUT for p in parts)


def _by_name(name: str, attrs: str, in_article: bool) -> bool:
    """Whether a class or id marks the element."""
    if name in CONTENT:
        return False
    for kind, value in ATTRIBUTE.findall(attrs):
        if kind.lower() == "role":
            continue
        for word in value.strip("\"'").lower().split():
            if _unmistakable(word) and not (in_article and word == "header"):
                return True
    return False


def _is_article(name: str, attrs: str) -> bool:
    return name in ("article", "main") or name != "body" and 'role="main"' in attrs.lower()


def _wrappers(tokens: list[re.Match]) -> tuple[set[int], set[int], bool]:
    """The tokens that open an element which holds an article element, those that open
    one with most of the text, and whether the page has an article element."""
    stack: list[list] = []  # [name, token, articles before, text before, whether it is closed]
    by_name: dict[str, list] = {}
    articles = size = 0
    spans: list[tuple[int, int, int]] = []  # (token, articles, text)

    def end(entry: list) -> None:
        entry[4] = True
        spans.append((entry[1], articles - entry[2], size - entry[3]))

    for k, token in enumerate(tokens):
        if token["text"] is not None:
            size += len(token["text"].strip())
            continue
        if token["name"] is None:
            continue
        name = token["name"].lower()
        if name in VOID or token["attrs"].endswith("/"):
            continue
        same = by_name.setdefault(name, [])
        if same and (token["close"] or name == "p"):
            entry = same.pop()
            end(entry)
            if name in CONTENT:  # what is still open in it ends with it
                while (inner := stack.pop()) is not entry:
                    if not inner[4]:
                        end(by_name[inner[0]].pop())
        if not token["close"]:
            entry = [name, k, articles, size, False]
            articles += _is_article(name, token["attrs"])
            if _is_article(name, token["attrs"]):
                entry[2] = articles
            stack.append(entry)
            same.append(entry)
    for entry in stack:
        if not entry[4]:
            end(entry)
    return {k for k, held, _ in spans if held}, {k for k, _, text in spans if 2 * text > size}, articles > 0


def lines_of(page: str | None) -> list[Line]:
    """(region, text) of each block of text, in page order."""
    tokens = list(TOKEN.finditer(page or ""))
    wrappers = None  # found when the first name is met
    found: list[Line] = []
    parts: list[str] = []
    article: list[str] = []  # open article elements
    skipped, depth, region = "", 0, OUTSIDE

    def end_line() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                found.append((region, text))
            parts.clear()

    def is_boilerplate(k: int, name: str, attrs: str) -> bool:
        nonlocal wrappers
        if _by_tag(name, attrs, bool(article)):
            return True
        if not _by_name(name, attrs, bool(article)):
            return False
        if wrappers is None:
            wrappers = _wrappers(tokens)
        holding, most, has_article = wrappers
        # Articles in an article are comments; an advert may be longer than the article beside it.
        return not (k in holding and "article" not in article or k in most and (article or not has_article))

    for k, token in enumerate(tokens):
        if token["text"] is not None:
            parts.append(token["text"])
            continue
        if token["name"] is None:
            continue
        name, closes = token["name"].lower(), bool(token["close"])
        if name in INLINE or name in VOID and name not in BREAKS:
            continue
        end_line()
        if name in VOID or token["attrs"].endswith("/"):
            continue
        if skipped:
            if name == skipped:
                depth += -1 if closes else 1
                if name == "p" and not closes:
                    depth = 0  # paragraphs do not nest
            if depth <= 0 or closes and article and name == article[-1]:
                skipped = ""
            if skipped or closes and not (article and name == article[-1]):
                region = MARKED if skipped else INSIDE if article else OUTSIDE
                continue
        if closes:
            if article and name == article[-1]:
                article.pop()
        elif is_boilerplate(k, name, token["attrs"]):
            skipped, depth = name, 1
        elif _is_article(name, token["attrs"]) or article and name == article[-1]:
            article.append(name)
        region = MARKED if skipped else INSIDE if article else OUTSIDE
    end_line()
    return found


def _lengths(a: list, b: list) -> tuple[list[int], list[int]]:
    """Bit rows of the alignment of all beginnings of ``a``, and common lengths by
    beginning of ``b`` for all of ``a``. A clear bit is a step up."""
    place: dict = {}
    for j, x in enumerate(b):
        place[x] = place.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row, rows = full, []
    for x in a:
        up = row & place.get(x, 0)
        row = ((row + up) | (row - up)) & full
        rows.append(row)
    steps = [0]
    for j in range(len(b)):
        steps.append(steps[-1] + (not row >> j & 1))
    return rows, steps


def common_lines(a: list, b: list) -> list[int]:
    """The places in ``a`` of one longest common subsequence with ``b``.

    The alignment goes row by row in the bits of whole numbers; a table that would be
    too large is halved at the place where the two halves have the most in common.
    """
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    found = [*range(start), *range(len(a) - end, len(a))]
    x, y = a[start : len(a) - end], b[start : len(b) - end]
    if not x or not y:
        return found
    if len(x) * len(y) > TABLE_BITS and len(x) > 1:
        half = len(x) // 2
        _, left = _lengths(x[:half], y)
        _, right = _lengths(x[half:][::-1], y[::-1])
        cut = max(range(len(y) + 1), key=lambda j: left[j] + right[len(y) - j])
        inner = common_lines(x[:half], y[:cut]) + [half + i for i in common_lines(x[half:], y[cut:])]
    else:
        rows, _ = _lengths(x, y)
        inner, i, j = [], len(x), len(y)
        while i and j:
            if rows[i - 1] >> (j - 1) & 1:
                j -= 1
            else:
                i -= 1
                if not i or rows[i - 1] >> (j - 1) & 1:
                    inner.append(i)
                    j -= 1
    return sorted(found + [start + i for i in inner])


def shared_with(lines: list[Line], neighbour: list[Line] | None) -> set[int] | None:
    """The lines shared with a neighbour; None if there is none or it is a copy."""
    if neighbour is None:
        return None
    common = common_lines([t for _, t in lines], [t for _, t in neighbour])
    size = sum(len(t) for _, t in lines)
    other = sum(len(t) for _, t in neighbour)
    if size and sum(len(lines[i][1]) for i in common) >= COPY_SHARE * max(size, other):
        return None
    return set(common)


def main_text(lines: list[Line], before: list[Line] | None, after: list[Line] | None) -> str:
    shared = shared_with(lines, before)
    if shared is None:
        shared = shared_with(lines, after)
    if shared is None:
        # Nothing to difference against: the marking alone decides.
        keep = INSIDE if any(r == INSIDE for r, _ in lines) else OUTSIDE
        return " ".join(t for r, t in lines if r == keep)
    return " ".join(t for i, (r, t) in enumerate(lines) if r == INSIDE or r == OUTSIDE and i not in shared)


def _pack(lines: list[Line]) -> bytes:
    return zlib.compress("\n".join(r + t for r, t in lines).encode("utf-8", "surrogatepass"), 3)


def _unpack(data: bytes) -> list[Line]:
    text = zlib.decompress(data).decode("utf-8", "surrogatepass")
    return [(x[0], x[1:]) for x in text.split("\n")] if text else []


def _key(host: str, path: str, page: object) -> tuple:
    """Sorts as Spark does: text by code points, a null id first."""
    return host, path, page is not None, 0 if page is None else page


def _ranges(keys: DataFrame) -> tuple[list[tuple], dict[tuple, list[int]]]:
    """(first keys of all ranges but one, further ranges of the keys at their borders).

    The driver holds a sample and two keys of each range, not more.
    """
    n = keys.count()
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = max(1, min(parts, -(-n // CELL_PAGES)))
    if cells == 1:
        return [], {}
    sample = sorted({_key(*r) for r in keys.sample(min(1.0, SAMPLE_KEYS * cells / n), 0).collect()})
    bounds = sorted({sample[i * len(sample) // cells] for i in range(1, cells)} if sample else ())

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            cell = [bisect_right(bounds, _key(*r)) for r in zip(*(c.to_pylist() for c in batch.columns))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell, pa.int32()), *batch.columns], names=["cell", *batch.schema.names]
            )

    kind = keys.schema["page_id"].dataType.simpleString()
    key = F.struct("host", "path", "page_id")
    ends = (
        keys.mapInArrow(place, f"cell int, host string, path string, page_id {kind}")
        .groupBy("cell")
        .agg(F.min(key).alias("first"), F.max(key).alias("last"))
        .collect()
    )
    guests = defaultdict(list)
    ends.sort(key=lambda r: r["cell"])
    for a, b in zip(ends, ends[1:]):
        if a["last"]["host"] == b["first"]["host"]:
            guests[_key(*a["last"])].append(b["cell"])
            guests[_key(*b["first"])].append(a["cell"])
    return bounds, dict(guests)


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """(page_id, url, text, n_chars) of every row."""
    spark = pages.sparkSession
    ship(spark)
    kind = pages.schema[id_col].dataType.simpleString()
    url = F.coalesce(F.col(url_col), F.lit(""))
    place = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)([^?#]*)"
    rows = pages.select(
        F.lower(F.regexp_extract(url, place, 1)).alias("host"),
        F.regexp_extract(url, place, 2).alias("path"),
        F.col(id_col).alias("page_id"),
        F.col(url_col).alias("url"),
        F.col(html_col).alias("html"),
    )
    bounds, guests = _ranges(rows.select("host", "path", "page_id"))
    shared = spark.sparkContext.broadcast((bounds, guests))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, guests = shared.value
        for batch in slices(batches):
            keys = [_key(*r) for r in zip(*(c.to_pylist() for c in batch.columns[:3]))]
            packed = [_pack(lines_of(h)) for h in batch.column(4).to_pylist()]
            # (row, range, whether it is the row's own)
            to = [(i, bisect_right(bounds, k), True) for i, k in enumerate(keys)]
            to += [(i, cell, False) for i, k in enumerate(keys) for cell in guests.get(k, ())]
            row, cell, own = zip(*to) if to else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(cell, pa.int32()),
                    pa.array(own, pa.bool_()),
                    *(c.take(pa.array(row, pa.int64())) for c in batch.columns[:4]),
                    pa.array([packed[i] for i in row], pa.binary()),
                ],
                names=["cell", "own", *batch.schema.names[:4], "packed"],
            )

    parsed = (
        rows.mapInArrow(
            parse, f"cell int, own boolean, host string, path string, page_id {kind}, url string, packed binary"
        )
        .repartitionById(len(bounds) + 1, "cell")
        .sortWithinPartitions("host", "path", "page_id", "packed")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = here = None  # (host, id, url, lines, own)
        out: list[tuple] = []

        def done(row, prev, follow):
            near = [x[3] if x and x[0] == row[0] else None for x in (prev, follow)]
            text = main_text(row[3], *near)
            return row[1], row[2], text, len(text)

        for batch in slices(batches):
            for _, own, host, _, page, url, packed in zip(*(c.to_pylist() for c in batch.columns)):
                row = (host, page, url, _unpack(packed), own)
                if here and here[4]:
                    out.append(done(here, before, row))
                before, here = here, row
                if len(out) >= 256:
                    yield _result(out, batch.schema.field(4).type)
                    out = []
            last = batch.schema.field(4).type
        if here and here[4]:
            out.append(done(here, before, None))
        if out:
            yield _result(out, last)

    return parsed.mapInArrow(compare, f"page_id {kind}, url string, text string, n_chars bigint")


def _result(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    kinds = [id_type, pa.string(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["page_id", "url", "text", "n_chars"]
    )
