import base64
import gzip
import hashlib
import io
import random

import pyarrow as pa
import pytest
from compare import connect, differences

from gridtally.llm import queries, warc

SF = "/root/testdata/sf0.001"


def test_query_equals_sql(spark):
    df = queries.QUERIES["op4_warc"](spark, SF)
    assert differences(connect(SF), df, queries.ORACLES["op4_warc"]) is None


def test_every_split_finds_every_record_once():
    rng = random.Random(5)
    payloads = [rng.randbytes(rng.choice([0, 10, 500, 5000])) for _ in range(60)]
    # Bytes that look like the start of a member but are none.
    hidden = [warc.MAGIC, gzip.compress(b"no record"), gzip.compress(b"WARC/1.1 but no header")]
    payloads += [rng.randbytes(40_000) + h + rng.randbytes(40_000) for h in hidden] + [b"a" * 300_000]
    data = b"".join(warc.member(warc.record(i, f"http://x/{i}", p, None)) for i, p in enumerate(payloads))
    assert data.count(warc.MAGIC) > len(payloads)
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == len(payloads)
    for split in (7, 64, 1000, 30_000, len(data) + 5, 1 << 60):
        reader = warc.Reader(pa.PythonFile(io.BytesIO(data), mode="r"))
        found = [r for s in range(0, len(data), split) for r in reader.records(s, s + split)]
        assert [f["warc-record-id"] for _, f, _ in found] == [f"<urn:page:{i}>" for i in range(len(payloads))]
        assert [b[len(warc.HTTP) :] for _, _, b in found] == payloads


def test_damage_is_an_error():
    data = warc.member(warc.record(1, None, bytes(range(256)) * 200, None))
    for broken in (data[:-20], data[: len(data) // 2] + b"\0\0\0" + data[len(data) // 2 + 3 :]):
        reader = warc.Reader(pa.PythonFile(io.BytesIO(broken), mode="r"))
        try:
            found = list(reader.records(0, len(broken)))
        except ValueError:
            continue
        assert not found


def by_hand(rows, least_bytes=0):
    out = []
    for page, url, html in rows:
        same = [r[0] for r in rows if (r[2] or "") == (html or "") and r[0] is not None]
        size = len((html or "").encode())
        several = sum((r[2] or "") == (html or "") for r in rows) > 1 and size >= least_bytes
        refers = max(same) if same and several and max(same) != page else None
        digest = base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()
        out.append((page, url, size, digest, "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


def test_rows(spark, tmp_path):
    rows = [(i, f"http://h/{i}", "same page" if i % 3 else f"é{i}" * i) for i in range(40)]
    rows += [(100, None, None), (101, "http://a\r\nb", ""), (None, "u", "same page"), (None, "v", "alone"), (102, "w", "long " * 50_000)]
    rows += [(39, "http://h/39b", "x"), (38, "http://h/38", "same page"), (38, "http://h/38", "same page")]
    pages = spark.createDataFrame([(*r, 1, 2) for r in rows], "page_id long, url string, html string, n int, largest int")
    for least in (0, 5):
        files = warc.write(pages.repartition(3), str(tmp_path / f"a{least}"), least_bytes=least, file_bytes=2000)
        assert files.count() > 3
        found = warc.read(files, split_bytes=700, with_payload=True).collect()
        to_int = lambda x: None if x is None else int(x)
        got = [
            (to_int(r.record_id), r.url and r.url.replace("%0D%0A", "\r\n"), r.payload_bytes, r.payload_digest, r.record_type, to_int(r.refers_to))
            for r in found
        ]
        assert sorted(got, key=repr) == by_hand(rows, least)
    empty = warc.write(pages.limit(0), str(tmp_path / "none"))
    assert warc.read(empty).count() == 0


def test_headers_of_any_length(spark, tmp_path):
    rng = random.Random(2)
    urls = ["data:," + rng.randbytes(size).hex() for size in (30_000, 40_000, 400_000)] + ["http://x/" + "a" * 2_000_000, "u"]
    pages = spark.createDataFrame([(i, u, f"page {i}") for i, u in enumerate(urls)], "page_id long, url string, html string")
    files = warc.write(pages.repartition(2), str(tmp_path / "long"))
    for split in (1 << 12, 1 << 24):
        found = warc.read(files, split_bytes=split)
        assert {(int(r.record_id), r.url) for r in found.collect()} == set(enumerate(urls)) and found.count() == len(urls)
    data = warc.member(warc.record(1, urls[2], b"page", None))
    with pytest.raises(ValueError):
        list(warc.Reader(pa.PythonFile(io.BytesIO(data[:200_000]), mode="r")).records(0, 200_000))


def test_missing_records_are_an_error(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"page {i}") for i in range(5)], "page_id long, url string, html string")
    files = warc.write(pages.coalesce(1), str(tmp_path / "five"))
    with pytest.raises(ValueError, match="6 records, but 5"):
        warc.read(files.withColumn("records", files.records + 1))
