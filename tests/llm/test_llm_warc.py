"""WARC archives: round trip, revisits and damage."""

import base64
import gzip
import hashlib
import io

import pytest
from conftest import SF_SMALL

from quillprice.llm.queries import op3_warc
from quillprice.llm.warc import read_archive, read_archives, record, write_archives

PAGES = "page_id long, url string, html string, payload string, sha string"


def sha(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def expected(pages, min_bytes=0):
    first = {}
    for page_id, html in pages:
        if page_id is not None:
            first[html or ""] = min(first.get(html or "", page_id), page_id)
    out = []
    for page_id, html in pages:
        data = (html or "").encode()
        own = len(data) < min_bytes or page_id == first.get(html or "")
        out.append((page_id, len(data), sha(data), "response" if own else "revisit",
                    None if own else first[html or ""]))
    return sorted(out, key=str)


def test_query_equals_plain_version(spark):
    import duckdb
    pages = duckdb.sql(f"SELECT page_id, html FROM '{SF_SMALL}/pages.parquet'").fetchall()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
           for r in op3_warc(spark, SF_SMALL).collect()]
    assert sorted(got, key=str) == expected(pages)


@pytest.mark.parametrize("min_bytes", [0, 4])
def test_round_trip_with_copies_nulls_and_long_payloads(spark, min_bytes):
    long = "é<p>" * 200_000
    pages = [(5, "same page"), (3, "same page"), (9, "same page"), (3, "same page"), (1, None), (2, ""), (4, "abc"),
             (6, "abc"), (7, long), (8, long), (None, "same page"), (10, "x\r\n\r\nWARC/1.1\r\n")]
    rows = [(i, None if i == 4 else "http://e.org/a b\n" if i == 6 else f"http://e.org/{i}", h, "clash", "clash")
            for i, h in pages]
    df = spark.createDataFrame(rows, PAGES).repartition(3)
    manifest = write_archives(df, min_bytes=min_bytes, archive_bytes=200)
    assert manifest.count() > 3                       # more than one archive for a task
    got = read_archives(manifest, keep_payload=True).collect()
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got],
                  key=str) == expected(pages, min_bytes)
    assert all(sha(bytes(r.payload)) == r.payload_digest for r in got if r.record_type == "response")
    assert all(not r.payload for r in got if r.record_type == "revisit")
    urls = {r.page_id: r.url for r in got}
    assert urls[4] is None and urls[6] == "http://e.org/a%20b%0A"


def test_empty_table(spark):
    assert read_archives(write_archives(spark.createDataFrame([], PAGES))).count() == 0


def archive(payload=b"hello " * 1000):
    return record(1, "http://e.org", payload, sha(payload), len(payload))


def test_each_record_is_a_gzip_member():
    data = archive() + archive(b"")
    fields, _, size, digest, _ = next(read_archive(io.BytesIO(data)))
    assert (fields["warc-type"], size, digest) == ("response", 6000, sha(b"hello " * 1000))
    assert len(list(read_archive(io.BytesIO(data)))) == 2
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == 2


@pytest.mark.parametrize("change", [
    lambda t: t.replace(b"hello", b"hullo", 1), lambda t: t.replace(b"sha1:", b"sha1:A", 1), lambda t: t[:-10],
    lambda t: t + b"more", lambda t: b"NOPE" + t, lambda t: t.replace(b"Content-Length: 6000", b"Content-Length: 6001")])
def test_damage_is_noticed(change):
    plain = gzip.decompress(archive())
    with pytest.raises(ValueError):
        list(read_archive(io.BytesIO(gzip.compress(change(plain)))))


def test_a_cut_archive_is_noticed():
    with pytest.raises(ValueError):
        list(read_archive(io.BytesIO(archive()[:-20])))


def test_a_url_of_any_length_is_read_back():
    url = "data:" + "a\r\nb" * 600_000
    data = record(7, url, b"x", sha(b"x"), 1) + archive(b"")
    (fields, *_), (other, *_) = read_archive(io.BytesIO(data))
    assert fields["warc-target-uri"] == url.replace("\r", "%0D").replace("\n", "%0A") and other["warc-type"] == "response"
