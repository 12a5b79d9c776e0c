"""WARC archives: one gzip member per record, written by tasks and read by byte ranges.

``write`` makes archives of a page table. Of pages with equal payloads the one with
the largest id is a response record, the others are revisit records without a
payload. Each task attempt writes files of its own name; the returned table lists
those of the attempts that counted, so lost or repeated attempts leave no trace.

``read`` splits the files into byte ranges. A task looks for the gzip magic from the
start of its range, takes a place for a member if the beginning of a WARC header can be
decoded there, and reads every record that begins inside its range, to its end; headers
may be of any length. The check sum of each member is verified; a record that cannot be
read to its end is an error, and so is a file that holds not as many records as its row
says.

Archives go through Arrow file systems by URI, so any store they know will do.

Defined cases: a null payload is empty. A null id counts as smaller than any other
and is written as no id. Rows that repeat the largest id of their payload are all
responses. Payloads of less than ``least_bytes`` are all responses. A null address
has no header; line ends in one are percent-encoded. An empty table gives no file and
no record; other columns are not read. A payload that is itself an archive, stored
without compression, could be taken for records; text in UTF-8 holds no gzip magic.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.llm.groups import HOT_SHARE
from gridtally.llm.tables import ship, slices, staged

MAGIC = b"\x1f\x8b\x08"
#: Bytes of a file that one task scans.
SPLIT_BYTES = 16 << 20
#: More ranges than this share tasks.
MOST_TASKS = 50_000
#: A file is closed once it is longer.
FILE_BYTES = 256 << 20
READ_BYTES = 1 << 20
PIECE_BYTES = 64 << 10
#: The first line of a record, ten bytes.
VERSION = re.compile(rb"WARC/1\.[0-9]\r\n")
VERSION_BYTES = 10
DATE = "2024-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def with_records(
    pages: DataFrame, id_col: str = "page_id", html_col: str = "html", least_bytes: int = 0
) -> DataFrame:
    """The pages with ``refers_to``: the id of the response for revisits, else null.

    Only digests are grouped. Payloads of many pages are few; they are broadcast, and
    their pages are spread over all tasks of the other join.
    """
    payload = F.coalesce(F.col(html_col).cast("binary"), F.lit(b""))
    key = F.concat(F.sha1(payload), F.lit(":"), F.octet_length(payload).cast("string"))
    keyed = pages.withColumn("payload_key", key)
    counted = (
        keyed.filter(F.octet_length(payload) >= least_bytes)
        .groupBy("payload_key")
        .agg(F.max(id_col).alias("largest"), F.count("*").alias("n"))
        .filter(F.col("n") > 1)
    )
    counted = staged(counted, "payloads")
    is_hot = F.col("n") > F.greatest(F.lit(1.0), F.lit(pages.count() * HOT_SHARE))
    hot = counted.filter(is_hot).select("payload_key", F.col("largest").alias("hot_largest"))
    cold = counted.filter(~is_hot).select(F.col("payload_key").alias("cold_key"), "largest")
    rows = keyed.join(F.broadcast(hot), "payload_key", "left")
    own = F.concat(F.lit("row:"), F.xxhash64(id_col).cast("string"))
    rows = rows.withColumn("own_key", F.when(F.col("hot_largest").isNull(), F.col("payload_key")).otherwise(own))
    rows = rows.join(cold, F.col("own_key") == F.col("cold_key"), "left")
    largest = F.coalesce("hot_largest", "largest")
    refers = F.when(~largest.eqNullSafe(F.col(id_col)), largest)
    return rows.select(*(F.col(c) for c in pages.columns), refers.alias("refers_to"))


def record(page_id: object, url: str | None, payload: bytes, refers_to: object, date: str = DATE) -> bytes:
    """One WARC record, not compressed."""
    block = b"" if refers_to is not None else HTTP + payload
    kind = "response" if refers_to is None else "revisit"
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if refers_to is not None:
        fields.append(("WARC-Refers-To", f"<urn:page:{refers_to}>"))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_bytes: int = 0,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write the archives below ``folder``; returns (file, bytes, records), already written."""
    ship(pages.sparkSession)
    rows = with_records(pages.select(id_col, url_col, html_col), id_col, html_col, least_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        context = TaskContext.get()
        out, name, size, records, done = None, None, 0, 0, []
        for batch in slices(batches):
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    tag = f"{context.partitionId()}-{context.taskAttemptId()}-{uuid.uuid4().hex}"
                    name, size, records = f"part-{tag}.warc.gz", 0, 0
                    out = store.open_output_stream(posixpath.join(root, name), compression=None)
                data = member(record(page_id, url, (html or "").encode(), refers_to))
                out.write(data)
                size, records = size + len(data), records + 1
                if size > file_bytes:
                    out.close()
                    done.append((name, size, records))
                    out = None
        if out is not None:
            out.close()
            done.append((name, size, records))
        files, sizes, counts = zip(*done) if done else ((), (), ())
        uris = [f"{folder.rstrip('/')}/{f}" for f in files]
        yield pa.RecordBatch.from_arrays(
            [pa.array(uris, pa.string()), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
            names=["file", "bytes", "records"],
        )

    listed = rows.select(id_col, url_col, html_col, "refers_to")
    return staged(listed.mapInArrow(run, "file string, bytes bigint, records bigint"), "archives")


def _header(head: bytes) -> dict[str, str] | None:
    """The fields of a WARC header, names in lower case; None if it is none."""
    lines = head.split(b"\r\n")
    if not lines[0].startswith(b"WARC/1."):
        return None
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return fields if fields.get("content-length", "").isdigit() and "warc-type" in fields else None


class Reader:
    """Members of one file, from any place in it."""

    def __init__(self, file):
        self.file = file
        self.size = file.size()
        self.start, self.buffer = 0, b""

    def _read(self, at: int, size: int) -> bytes:
        """Bytes of the file, read ahead so that short records cost no reads of their own."""
        end = min(at + size, self.size)
        if at < self.start or end > self.start + len(self.buffer):
            self.file.seek(at)
            self.start, self.buffer = at, self.file.read(max(size, READ_BYTES))
        return self.buffer[at - self.start : at - self.start + size]

    def member_at(self, at: int) -> tuple[dict[str, str], bytes, int] | None:
        """(header, block, place after the member) if a record begins here."""
        unpack = zlib.decompressobj(31)
        got, place, fields, start = bytearray(), at, None, 0
        begun = False  # whether this is a record
        while not unpack.eof:
            # Little is read until the first line shows that this is a record.
            piece = self._read(place, PIECE_BYTES if begun else 4096)
            if not piece:
                if begun:
                    raise ValueError(f"the record at byte {at} is cut off")
                return None
            try:
                more = unpack.decompress(piece)
            except zlib.error:
                if begun:
                    raise ValueError(f"the record at byte {at} is damaged") from None
                return None
            searched = max(len(got) - 3, 0)
            got += more
            place += len(piece) - len(unpack.unused_data)
            if not begun and len(got) >= VERSION_BYTES:
                begun = VERSION.match(got) is not None
                if not begun:
                    return None
            if begun and fields is None:
                start = got.find(b"\r\n\r\n", searched) + 4
                if start >= 4:
                    fields = _header(bytes(got[: start - 4]))
                    if fields is None:
                        raise ValueError(f"the record at byte {at} has a damaged header")
        if fields is None:
            if begun:
                raise ValueError(f"the record at byte {at} has no end of its header")
            return None
        length = int(fields["content-length"])
        if len(got) < start + length:
            raise ValueError(f"the record at byte {at} is shorter than its header says")
        return fields, bytes(got[start : start + length]), place

    def records(self, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
        """(place, header, block) of the records that begin in [start, end)."""
        at, end = start, min(end, self.size)
        while at < end:
            if self._read(at, len(MAGIC)) != MAGIC:
                # Not right behind a record: look for the next possible beginning.
                window = self._read(at, min(READ_BYTES, end - at + len(MAGIC) - 1))
                hit = window.find(MAGIC)
                if hit < 0:
                    at += max(len(window) - len(MAGIC) + 1, 1)
                    continue
                at += hit
            found = self.member_at(at)
            if found is None:
                at += 1
                continue
            fields, block, after = found
            yield at, fields, block
            at = after


def _page(urn: str | None) -> str | None:
    return urn[len("<urn:page:") : -1] or None if urn and urn.startswith("<urn:page:") else None


def read(files: DataFrame, split_bytes: int = SPLIT_BYTES, with_payload: bool = False) -> DataFrame:
    """One row per record of the files (file, bytes).

    ``payload_bytes`` and ``payload_digest`` of a response are taken from what was
    read and checked against the header; those of a revisit are in its header. If the
    files have ``records``, the rows are stored and counted; with payloads, which may be
    too large to store, ``compare_counts`` is left to the caller.
    """
    ship(files.sparkSession)
    starts = F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))
    ranges = files.filter(F.col("bytes") > 0).select("file", F.explode(starts).alias("start"))
    # The rows are tiny, the work behind them is not: their number of tasks is set here.
    n_ranges = files.agg(F.sum(F.ceil(F.col("bytes") / split_bytes))).first()[0] or 1
    ranges = ranges.repartition(min(int(n_ranges), MOST_TASKS))
    names = ["file", "place", "record_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string(), pa.binary()]
        for batch in slices(batches):
            for uri, start in zip(*(c.to_pylist() for c in batch.columns)):
                store, path = fs.FileSystem.from_uri(uri)
                with store.open_input_file(path) as file:
                    rows = []
                    for place, fields, block in Reader(file).records(start, start + split_bytes):
                        rows.append((uri, place, *_record_row(fields, block, with_payload)))
                        if len(rows) == 256:
                            yield _batch(rows, names, kinds)
                            rows = []
                    if rows:
                        yield _batch(rows, names, kinds)

    schema = (
        "file string, place bigint, record_id string, url string, record_type string, refers_to string,"
        " payload_bytes bigint, payload_digest string, payload binary"
    )
    found = ranges.mapInArrow(run, schema)
    if with_payload:
        return found
    found = found.drop("payload")
    if "records" not in files.columns:
        return found
    found = staged(found, "records")
    compare_counts(files, found)
    return found


def compare_counts(files: DataFrame, found: DataFrame) -> None:
    """Raise an error if a file (file, records) has more or fewer rows in ``found``."""
    counted = found.groupBy("file").agg(F.count("*").alias("rows"))
    both = files.select("file", "records").join(counted, "file", "full").fillna(0, ["records", "rows"])
    for row in both.filter(F.col("records") != F.col("rows")).take(1):
        raise ValueError(f"{row['file']} has {row['records']} records, but {row['rows']} were read")


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def _record_row(fields: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    kind = fields["warc-type"]
    said = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "revisit":
        payload, size, digest = None, int(fields.get("x-payload-length", 0)), said
    else:
        head, _, body = block.partition(b"\r\n\r\n")
        payload = body if head.startswith(b"HTTP/") else block
        size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if said and said != digest:
            raise ValueError(f"payload digest {digest} is not {said}")
    return (
        _page(fields.get("warc-record-id")),
        fields.get("warc-target-uri"),
        kind,
        _page(fields.get("warc-refers-to")),
        size,
        digest,
        payload if with_payload else None,
    )


ORACLE_SQL = """
WITH digests AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages
), groups AS (
  SELECT *, strlen(payload) AS payload_bytes, max(page_id) OVER (PARTITION BY hex, strlen(payload)) AS largest FROM digests
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(1 + ((CAST('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS INTEGER)
                    >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> largest THEN largest END AS refers_to
FROM groups
"""
