"""WARC archives: a writer, and a sequential reader that verifies what it reads.

Writer. Each page becomes one WARC/1.1 record in a gzip member of its own. Of the
pages with equal payloads (same SHA-1 and length) of at least ``min_bytes`` the
one with the smallest page_id is a response with the payload; the others are
revisit records that refer to it and hold the HTTP head only. Tasks write their
archives to the given shared folder under names that no other attempt uses; the
stored manifest lists those of the attempts that counted.

Reader. An archive is read from front to back in small pieces. Every gzip member
is decompressed incrementally, its record is framed by Content-Length, block and
payload digests are computed on the way and compared, and the member must end
with its record. Memory does not grow with the archive; a payload is held only
if it is asked for. Damage raises ``ValueError`` with the place.

Null html is an empty payload; null or odd urls leave out or percent-encode the
target; they may be of any length. A null page_id is the largest; pages that repeat the smallest page_id of
a payload are all responses. An empty table gives no archives and no rows.
Other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillprice.llm.common import shared_uri
from quillprice.session import materialize

DATE = "2024-01-01T00:00:00Z"
ARCHIVE_BYTES = 64 << 20
MIN_BYTES = 0
LEVEL = 6
_PIECE = 64 << 10
_END = b"\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _member(data: list[bytes]) -> bytes:
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return b"".join([*(z.compress(x) for x in data), z.flush()])


def _head(fields: list[tuple[str, str]]) -> bytes:
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in fields), "\r\n"]).encode("utf-8", "replace")


def _clean_uri(url: str) -> str:
    return "".join(f"%{ord(c):02X}" if ord(c) <= 32 or ord(c) == 127 else c for c in url)


def record(page_id, url, payload: bytes | None, digest: str, size: int, refers_to=None, date: str = DATE) -> bytes:
    """One record as a gzip member: a response with ``payload``, or a revisit without."""
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n").encode()
    own = hashlib.sha1(block)
    own.update(payload or b"")
    fields = [("WARC-Type", "response" if payload is not None else "revisit"),
              ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"), ("WARC-Date", date),
              ("Content-Type", "application/http; msgtype=response"),
              ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{_base32(own.digest())}")]
    if url:
        fields.append(("WARC-Target-URI", _clean_uri(url)))
    if payload is None:
        fields += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", _PROFILE)]
    fields.append(("Content-Length", str(len(block) + len(payload or b""))))
    return _member([_head(fields), block, payload or b"", _END])


def write_archives(pages: DataFrame, folder: str | None = None, min_bytes: int = MIN_BYTES,
                   archive_bytes: int = ARCHIVE_BYTES, date: str = DATE) -> DataFrame:
    """Write all pages; the stored manifest (path, records) of the archives."""
    folder = folder or shared_uri(pages.sparkSession, "warc")
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("payload"), F.sha1(payload.cast("binary")).alias("sha"),
                        F.octet_length(payload).alias("size"))
    first = materialize(rows.groupBy(F.col("sha").alias("__sha"), F.col("size").alias("__size"))
                            .agg(F.min("page_id").alias("__first")), "warc-first")
    answer = F.col("page_id").eqNullSafe(F.col("__first")) | (F.col("size") < min_bytes)
    # A payload that very many pages share is one key of this join: both sides are plain
    # tables, so the skew join can split it.
    joined = (rows.join(first, (rows["sha"] == first["__sha"]) & (rows["size"] == first["__size"]))
                  .select("page_id", "url", F.when(answer, F.col("payload")).alias("payload"), "sha", "size",
                          F.when(~answer, F.col("__first")).alias("refers_to")))

    def write(batches):
        where, base = pafs.FileSystem.from_uri(folder)
        where.create_dir(base, recursive=True)
        out, name, records, size, done = None, "", 0, 0, []
        for batch in batches:
            columns = [batch.column(n) for n in ("page_id", "url", "payload", "sha", "size", "refers_to")]
            for start in range(0, batch.num_rows, 256):
                for page_id, url, body, sha, length, refers in zip(
                        *(c.slice(start, 256).to_pylist() for c in columns)):
                    if out is None:
                        name, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = where.open_output_stream(f"{base}/{name}", compression=None)
                    data = record(page_id, url, None if body is None else body.encode("utf-8", "surrogatepass"),
                                  _base32(bytes.fromhex(sha)), length, refers, date)
                    out.write(data)
                    records, size = records + 1, size + len(data)
                    if size >= archive_bytes:
                        out.close()
                        out = None
                        done.append((f"{folder}/{name}", records))
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", records))
        if done:
            paths, counts = zip(*done)
            yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(counts, pa.int64())], ["path", "records"])

    return materialize(joined.mapInArrow(write, "path string, records long"), "warc-manifest")


class _Member:
    """The decompressed bytes of one gzip member, piece by piece."""

    def __init__(self, stream, raw: bytes):
        self.stream, self.raw, self.z, self.plain = stream, raw, zlib.decompressobj(31), b""

    def _more(self) -> bool:
        while not self.z.eof:
            self.raw = self.z.unconsumed_tail or self.raw or self.stream.read(_PIECE)
            if not self.raw:
                raise ValueError("archive ends inside a gzip member")
            got = self.z.decompress(self.raw, _PIECE)
            self.raw = b""
            if got:
                self.plain += got
                return True
        return False

    def until(self, end: bytes) -> bytes:
        """Up to and with ``end``, however long; each piece is searched once."""
        held = bytearray(self.plain)
        at = held.find(end)
        while at < 0:
            searched = max(0, len(held) - len(end) + 1)
            if not self._more_alone():
                raise ValueError("no end of a header block")
            held += self.plain
            at = held.find(end, searched)
        self.plain = bytes(held[at + len(end):])
        return bytes(held[:at + len(end)])

    def _more_alone(self) -> bool:
        """As ``_more``, in place of what is held."""
        self.plain = b""
        return self._more()

    def exactly(self, end: bytes) -> bool:
        """Whether the next bytes are ``end``."""
        return b"".join(self.pieces(len(end))) == end

    def pieces(self, n: int):
        """The next ``n`` bytes."""
        while n:
            if not self.plain and not self._more():
                raise ValueError(f"a record is {n} bytes shorter than its Content-Length")
            part, self.plain = self.plain[:n], self.plain[n:]
            n -= len(part)
            yield part

    def rest(self) -> bytes:
        """What follows in the stream; the member must be at its end."""
        if self.plain or self._more():
            raise ValueError("a gzip member goes on after its record")
        return self.z.unused_data


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:]) if k}


def read_archive(stream, keep_payload: bool = False):
    """Yield (fields, http fields, payload bytes held by the record, digest of them, payload or None)."""
    raw = b""
    while raw := raw or stream.read(_PIECE):
        member = _Member(stream, raw)
        head = member.until(_END)
        if not head.startswith(b"WARC/1."):
            raise ValueError("a record does not begin with its version")
        fields = _fields(head)
        left = int(fields["content-length"])
        block, payload, kept, size = hashlib.sha1(), hashlib.sha1(), [], 0
        http = {}
        if fields.get("content-type", "").startswith("application/http"):
            inner = member.until(_END)
            left -= len(inner)
            block.update(inner)
            http = _fields(inner)
        for part in member.pieces(left):
            block.update(part)
            payload.update(part)
            size += len(part)
            if keep_payload:
                kept.append(part)
        if not member.exactly(_END):
            raise ValueError("a record is longer than its Content-Length")
        raw = member.rest()
        digest = _base32(payload.digest())
        if fields.get("warc-block-digest", "") not in ("", f"sha1:{_base32(block.digest())}"):
            raise ValueError(f"block digest of {fields.get('warc-record-id')} does not hold")
        if fields["warc-type"] == "response":
            if fields.get("warc-payload-digest", "") not in ("", f"sha1:{digest}"):
                raise ValueError(f"payload digest of {fields.get('warc-record-id')} does not hold")
            if "content-length" in http and int(http["content-length"]) != size:
                raise ValueError(f"payload length of {fields.get('warc-record-id')} does not hold")
        yield fields, http, size, digest, b"".join(kept) if keep_payload else None


def _page_id(urn: str | None):
    value = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(value) if value else None


def read_archives(manifest: DataFrame, keep_payload: bool = False) -> DataFrame:
    """One row per record: page_id, url, payload_bytes, payload_digest, record_type, refers_to[, payload].

    A revisit's length and digest are those of the payload that it refers to, from its own head.
    """
    spark = manifest.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                        *([("payload", pa.binary())] if keep_payload else [])])

    def read(batches):
        rows, held = [], 0
        for batch in batches:
            for path in batch.column("path").to_pylist():
                where, name = pafs.FileSystem.from_uri(path)
                with where.open_input_stream(name, compression=None) as stream:
                    for fields, http, size, digest, payload in read_archive(stream, keep_payload):
                        kind = fields["warc-type"]
                        if kind not in ("response", "revisit"):
                            continue
                        if kind == "revisit":
                            size = int(http.get("content-length", 0))
                            digest = fields["warc-payload-digest"].removeprefix("sha1:")
                        row = (_page_id(fields["warc-record-id"]), fields.get("warc-target-uri"), size, digest, kind,
                               _page_id(fields["warc-refers-to"]) if kind == "revisit" else None)
                        rows.append((*row, payload) if keep_payload else row)
                        held += len(payload or b"")
                        if len(rows) >= 5_000 or held > 16 << 20:
                            yield _batch(rows, schema)
                            rows, held = [], 0
        if rows:
            yield _batch(rows, schema)

    spec = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return manifest.repartition(tasks).mapInArrow(read, spec + (", payload binary" if keep_payload else ""))


def _batch(rows, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
