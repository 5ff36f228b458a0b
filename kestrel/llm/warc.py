"""Operator 5: web archive records as a chunked record table.

An archive is a table of rows (``record_id``, ``chunk``, ``last``, ``data``,
``digest``).  A record is its WARC/1.1 header, its block (an HTTP header and the
payload) and the closing blank lines; joined in order of ``chunk`` its rows are
those bytes, and the records of a partition in a row are a WARC file.  A payload
over ``chunk_bytes`` continues in further rows.  ``digest`` is the SHA-1 of the
payload up to the end of the row: the writer carries it from chunk to chunk, the
reader does the same and compares at every row, so both hold one chunk and a
running digest, and damage shows in the chunk that has it.  (The html of a page
comes as one cell of the pages table; that cell is read whole by its task.)

Payloads that occur in several records are stored once: the smallest id is the
``response``, the others are ``revisit`` records without payload that name the
digest, as ``identical-payload-digest`` revisits do; their HTTP header still
states the length.  A record's id is a UUID (version 8, whose bits are free) of
the page id and the row's number, so repeated rows have ids of their own.
"""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import bounded_batches, stored

CHUNK_BYTES = 64 << 10
_SCHEMA = "record_id string, chunk int, last boolean, data binary, digest binary"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format


def record_id(page: int | None, number: int) -> str:
    """UUID of a row: 64 bits of the page id, one for a null id, 57 of the row's
    number, around the fixed bits of version and variant."""
    bits = ((page or 0) & (1 << 64) - 1) << 58 | (page is None) << 57 | number & (1 << 57) - 1
    high, mid, low = bits >> 74, bits >> 62 & 0xFFF, bits & (1 << 62) - 1
    return f"<urn:uuid:{uuid.UUID(int=high << 80 | 8 << 76 | mid << 64 | 2 << 62 | low)}>"


def page_of(name: str) -> int | None:
    """The page id in a record's id."""
    x = uuid.UUID(name.removeprefix("<urn:uuid:").removesuffix(">")).int
    bits = (x >> 80) << 74 | (x >> 64 & 0xFFF) << 62 | x & (1 << 62) - 1
    page = bits >> 58
    return None if bits >> 57 & 1 else page - (page >> 63 << 64)


def _clean(x: str | None) -> str:
    return " ".join((x or "").split())


def _header(page: int | None, url: str | None, kind: str, digest: str, size: int, refers: tuple | None,
            number: int, date: str) -> bytes:
    """The WARC header and, as the beginning of the block, the HTTP header."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {size}\r\n\r\n"
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page, number)}", f"WARC-Date: {date}",
             f"WARC-Target-URI: {_clean(url)}", f"WARC-Payload-Digest: sha1:{digest}"]
    if kind == "revisit":
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {record_id(*refers)}"]
    lines += ["Content-Type: application/http;msgtype=response",
              f"Content-Length: {len(http) + (size if kind == 'response' else 0)}"]
    return ("\r\n".join(lines) + "\r\n\r\n" + http).encode()


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 min_bytes: int = 0) -> DataFrame:
    """``pages`` with the kind of record each becomes: ``kind`` and, of a revisit,
    ``refers`` (``page``, ``number`` of its response).

    Equal payloads of at least ``min_bytes`` make one response, the smallest id
    (a null id counts as the largest), and revisits.  Repeated rows of the
    smallest id are all responses."""
    bounded_batches(pages.sparkSession)
    src = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).cast("string").alias("url"),
                       F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"),
                       F.monotonically_increasing_id().alias("number"))
    keyed = src.withColumn("sha", F.unhex(F.sha1(F.encode("html", "UTF-8")))).withColumn("size", F.octet_length("html"))
    first = stored(keyed.select("sha", "size", "page", "number").where(F.col("size") >= min_bytes)
                   .groupBy("sha", "size")
                   .agg(F.min(F.struct(F.col("page").isNull(), "page", "number")).alias("f"), F.count("*").alias("k"))
                   .where("k > 1").select("sha", "size", F.col("f.page").alias("first"), F.col("f.number").alias("first_number"),
                                          F.lit(True).alias("known")), "warc-copies")
    return (keyed.join(first, ["sha", "size"], "left")
            .withColumn("copy", F.expr("known is not null and not (first <=> page)"))
            .select("page", "url", "number", "size", "sha",
                    F.when(F.col("copy"), F.lit("revisit")).otherwise("response").alias("kind"),
                    F.when(F.col("copy"), F.struct(F.col("first").alias("page"), F.col("first_number").alias("number"))).alias("refers"),
                    F.when(~F.col("copy"), F.col("html")).otherwise("").alias("html")))


def write_records(plan: DataFrame, chunk_bytes: int = CHUNK_BYTES, date: str | None = None) -> DataFrame:
    """The chunk rows of the archive; ``date`` is the WARC-Date of all records
    (pages have none of their own), now if it isn't given."""
    date = date or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        for b in batches:
            for page, url, number, size, sha, kind, refers, html in zip(*(c.to_pylist() for c in b.columns[:7]),
                                                                        b.column(7)):
                refers = (refers["page"], refers["number"]) if refers else None
                head = _header(page, url, kind, base64.b32encode(sha).decode(), size, refers, number, date)
                body, digest = memoryview(html.as_buffer()), hashlib.sha1()
                name = f"{number}"
                cuts = range(0, max(len(body), 1), chunk_bytes)
                for i, at in enumerate(cuts):
                    last, part = i == len(cuts) - 1, body[at:at + chunk_bytes]
                    digest.update(part)
                    data = (head if i == 0 else b"") + bytes(part) + (b"\r\n\r\n" if last else b"")
                    rows.append((name, i, last, data, digest.digest()))
                    held += len(data)
                    if held > 4 << 20:
                        yield _batch(rows)
                        rows, held = [], 0
        if rows:
            yield _batch(rows)

    return plan.select("page", "url", "number", "size", "sha", "kind", "refers", "html").mapInArrow(run, _SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["record_id", "chunk", "last", "data", "digest"]
    types = [pa.string(), pa.int32(), pa.bool_(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def _fields(lines: list[str]) -> dict[str, str]:
    return dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)


class _Reader:
    """One record, chunk by chunk: its header fields, and the length and digest of
    the payload that has come so far.  The closing blank lines of the last chunk
    are not payload."""

    def __init__(self) -> None:
        self.fields: dict[str, str] = {}
        self.sha, self.size = hashlib.sha1(), 0

    def add(self, chunk: int, last: bool, data: bytes, digest: bytes) -> None:
        if chunk == 0:
            head, _, data = data.partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            if not lines[0].startswith("WARC/"):
                raise ValueError("a record doesn't begin with a WARC version line")
            self.fields = _fields(lines[1:])
            http, _, data = data.partition(b"\r\n\r\n")
            self.http, self.block = _fields(http.decode().split("\r\n")[1:]), len(http) + 4
        if last:
            if data[-4:] != b"\r\n\r\n":
                raise ValueError(f"record {self.fields['WARC-Record-ID']} is cut short")
            data = data[:-4]
        self.sha.update(data)
        self.size += len(data)
        if self.sha.digest() != digest:
            raise ValueError(f"chunk {chunk} of record {self.fields['WARC-Record-ID']} doesn't have its digest")

    def close(self) -> tuple:
        """(page, type, payload bytes, digest, refers to), checked."""
        f = self.fields
        if self.block + self.size != int(f["Content-Length"]):
            raise ValueError(f"record {f['WARC-Record-ID']} is cut short")
        stated, size = f["WARC-Payload-Digest"].removeprefix("sha1:"), int(self.http["Content-Length"])
        if f["WARC-Type"] != "revisit" and (self.size, base64.b32encode(self.sha.digest()).decode()) != (size, stated):
            raise ValueError(f"record {f['WARC-Record-ID']} doesn't have its digest")
        refers = f.get("WARC-Refers-To")
        return page_of(f["WARC-Record-ID"]), size, stated, f["WARC-Type"], page_of(refers) if refers else None


_READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records whose chunks come in order, one after the other."""
    now: _Reader | None = None
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    names = [x.split()[0] for x in _READ.split(", ")]
    for b in batches:
        rows = []
        for chunk, last, data, digest in zip(*(b.column(c) for c in ("chunk", "last", "data", "digest"))):
            if chunk.as_py() == 0:
                now = _Reader()
            now.add(chunk.as_py(), last.as_py(), data.as_py(), digest.as_py())
            if last.as_py():
                rows.append(now.close())
                now = None
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
    if now is not None:
        raise ValueError("the last record of a partition has no end")


def read_records(archive: DataFrame) -> DataFrame:
    """One row per record of a chunk table: ``page_id``, ``payload_bytes``,
    ``payload_digest``, ``record_type``, ``refers_to``.  Lengths and digests are
    taken from the chunks and checked against their digests and the header.  Records of one row
    are read where they lie; only the rows of longer ones are brought together."""
    cols = ["record_id", "chunk", "last", "data", "digest"]
    short = archive.where("chunk = 0 and last").select(*cols).mapInArrow(_read, _READ)
    long = (archive.where("not (chunk = 0 and last)").select(*cols)
            .repartition("record_id").sortWithinPartitions("record_id", "chunk").mapInArrow(_read, _READ))
    return short.unionByName(long)


def roundtrip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              min_bytes: int = 0, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Write the archive to the shared folder and read it back.

    Null html is an empty payload; a null id is kept as null; repeated rows make
    a record each; an empty table gives no rows; other columns are ignored."""
    plan = plan_records(pages, id_col, url_col, html_col, min_bytes)
    return read_records(stored(write_records(plan, chunk_bytes), "warc"))
