"""Legacy archive conversion: ARC files of versions 1 and 2 to WARC records.

An ARC record is a header line and as many bytes as the line declares. Version 1 lines have five fields (address,
IP, date, type, length), version 2 lines ten (address, IP, date, type, result code, checksum, location, offset, file
name, length); the number of fields tells them apart, so files may mix them. The first record of a file, whose
address starts with ``filedesc:``, describes it and becomes ``warcinfo``. A record whose bytes start with an HTTP status
line becomes ``response``, one of a ``dns:`` address ``resource`` with its own type, any other ``resource``.

WARC fields are synthesised from the record alone, so a repeated conversion gives the same ones: the identifier
is a version-5 UUID of address, date and block digest, the date that of the ARC line in ISO form, the digests SHA-1 in
base32 of the block and, for responses, of the payload behind the HTTP header.

Addresses may hold spaces: fields are split off from the right. Years of two digits, dates of 8 to 14
digits and lengths that overrun the file are accepted; a record is then ``truncated``. Where no header line stands, the
reader goes to the next line that is one, and the record that follows counts the bytes it skipped. A file compressed
as one or more gzip members is read through: of a damaged member what inflates before the error is kept, a record cut there
is ``truncated``, and reading goes on at the next member; bytes passed over, there or between members, count as skipped by the
record that follows. Damage that only the checksum at a member's end shows leaves the block as it inflates. A null or empty file has no records; a file of junk alone has none.
Header lines, addresses and records may be of any length. Repeated files and records are converted each time, to equal identifiers;
a null path stays null. Columns other than path and content are left out.
"""

from __future__ import annotations

import base64
import contextlib
import datetime
import gzip
import hashlib
import re
import uuid
import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tidy

_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_V1 = re.compile(rb"^(?P<url>[A-Za-z][A-Za-z0-9+.-]*:.*?) (?P<ip>[0-9A-Fa-f.:]+) (?P<date>[0-9]{8,14}) (?P<type>\S+) (?P<length>[0-9]+)$")
_V2 = re.compile(
    rb"^(?P<url>[A-Za-z][A-Za-z0-9+.-]*:.*?) (?P<ip>[0-9A-Fa-f.:]+) (?P<date>[0-9]{8,14}) (?P<type>\S+) (?P<code>[0-9-]+) (?P<sum>\S+) (?P<location>\S+) (?P<offset>[0-9-]+) (?P<file>\S+) (?P<length>[0-9]+)$"
)
_STATUS = re.compile(rb"HTTP/[0-9]+(?:\.[0-9]+)? +([0-9]{3})")
SCHEMA = (
    "path string, offset long, arc_version int, skipped long, truncated boolean, warc_type string, record_id string, target_uri string, ip_address string, warc_date string, "
    "content_type string, content_length long, block_digest string, payload_digest string, http_status int, block binary"
)


@dataclass
class Record:
    offset: int
    version: int
    skipped: int
    truncated: bool
    url: bytes
    ip: bytes
    date: bytes
    type: bytes
    block: bytes


_MEMBER = b"\x1f\x8b\x08"


def gunzip(data: bytes) -> tuple[bytes, list[tuple[int, int, bool]]]:
    """All members of a gzip file, and its gaps: place in the inflated bytes, bytes passed over, whether data is lost there."""
    if data[:2] != b"\x1f\x8b":
        return data, []
    out, size, gaps, at, step = [], 0, [], 0, 1 << 16

    def skip(lost: bool) -> int:
        later = data.find(_MEMBER, at)
        later = len(data) if later < 0 else later
        gaps.append((size, later - at, lost))
        return later

    while at < len(data):
        if data[at : at + 3] != _MEMBER:
            at = skip(False)
            continue
        start, member, broken, parts = at, zlib.decompressobj(31), False, []
        while not member.eof and not broken and at < len(data):
            chunk, before = data[at : at + step], member.copy()
            try:
                parts.append(member.decompress(chunk))
                at += len(chunk)
            except zlib.error:  # again byte by byte, up to the error
                broken = True
                with contextlib.suppress(zlib.error):
                    for k in range(len(chunk)):
                        parts.append(before.decompress(chunk[k : k + 1]))
                        at += 1
        inner = None if member.eof else _inner(data, start + 1, at)
        if inner is not None:  # a stored block that was cut short took the next members for its own bytes
            parts, at = [zlib.decompressobj(31).decompress(data[start:inner])], inner
        out += parts
        size += sum(map(len, parts))
        if inner is not None:
            gaps.append((size, 0, True))
        else:
            at = skip(True) if broken else at - len(member.unused_data)
    return b"".join(out), gaps


def _inner(data: bytes, at: int, end: int) -> int | None:
    """The first place of a range where a member stands that starts with a record's header line."""
    while (at := data.find(_MEMBER, at, end)) >= 0:
        with contextlib.suppress(zlib.error):
            member, line, place = zlib.decompressobj(31), b"", at
            while b"\n" not in line and not member.eof and place < end:
                line += member.decompress(data[place : place + (1 << 16)])
                place += 1 << 16
            line = line.split(b"\n")[0].rstrip(b"\r")
            if _V2.match(line) or _V1.match(line):
                return at
        at += 1
    return None


def records(data: bytes, gaps: list[tuple[int, int, bool]] | tuple = ()) -> Iterator[Record]:
    at, skipped, gaps = 0, 0, deque(gaps)
    while at < len(data):
        stop = next((place for place, _, lost in gaps if lost and place > at), len(data))
        end = data.find(b"\n", at, stop)
        end = stop if end < 0 else end
        line = data[at:end].rstrip(b"\r")
        m = _V2.match(line) or _V1.match(line)
        if not m:
            skipped += min(end + 1, stop) - at if line.strip() else 0
            at = min(end + 1, stop)
            continue
        while gaps and gaps[0][0] <= at:
            skipped += gaps.popleft()[1]
        length = int(m["length"])
        block = data[end + 1 : min(end + 1 + length, stop)]
        yield Record(at, 2 if m.re is _V2 else 1, skipped, len(block) < length, m["url"], m["ip"], m["date"], m["type"], block)
        at, skipped = min(end + 1 + length, stop), 0


def iso_date(date: bytes) -> str | None:
    """Of 8 (day) to 14 (second) digits; 12 digits are minutes unless only a year of two digits makes them a date."""
    s = date.decode()
    for text in (s.ljust(14, "0"),) if len(s) != 12 else (s + "00", ("19" if s[:2] > "69" else "20") + s):
        try:
            return datetime.datetime.strptime(text, "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")
        except ValueError:
            pass
    return None


def sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def payload(block: bytes) -> bytes | None:
    """What follows the HTTP header; None if the block has none."""
    if not _STATUS.match(block):
        return None
    ends = [(i, n) for mark, n in ((b"\r\n\r\n", 4), (b"\n\n", 2)) if (i := block.find(mark)) >= 0]
    if not ends:
        return b""
    at, n = min(ends)
    return block[at + n :]


def convert(path: str, data: bytes) -> Iterator[tuple]:
    """Rows of SCHEMA."""
    for r in records(*gunzip(data)):
        url, date, digest = r.url.decode("utf-8", "replace"), iso_date(r.date), sha1(r.block)
        body = payload(r.block)
        kind, content = "resource", r.type.decode("utf-8", "replace")
        if r.url.startswith(b"filedesc:"):
            kind, content, body = "warcinfo", "application/warc-fields", None
        elif body is not None and not r.url.startswith(b"dns:"):
            kind, content = "response", "application/http; msgtype=response"
        name = uuid.uuid5(_NAMESPACE, f"{url} {date} {digest}")
        status = _STATUS.match(r.block) if kind == "response" else None
        yield (
            path, r.offset, r.version, r.skipped, r.truncated, kind, f"<urn:uuid:{name}>", url, r.ip.decode(), date, content, len(r.block), digest,
            sha1(body) if kind == "response" else None, int(status[1]) if status else None, r.block,
        )


def warc_record(row) -> bytes:
    """One WARC 1.0 record of a row of SCHEMA."""
    fields = {
        "WARC-Type": row["warc_type"], "WARC-Record-ID": row["record_id"], "WARC-Date": row["warc_date"], "WARC-Target-URI": row["target_uri"], "WARC-IP-Address": row["ip_address"],
        "WARC-Block-Digest": row["block_digest"], "WARC-Payload-Digest": row["payload_digest"], "WARC-Truncated": "length" if row["truncated"] else None,
        "Content-Type": row["content_type"], "Content-Length": row["content_length"],
    }
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return f"WARC/1.0\r\n{head}\r\n".encode() + bytes(row["block"]) + b"\r\n\r\n"


def arc_to_warc(files: DataFrame, path_col: str = "path", content_col: str = "content") -> DataFrame:
    """One row of SCHEMA for each record of the files (path, content), as ``binaryFile`` reads them."""
    rows = files.select(F.col(f"`{path_col}`").cast("string").alias("path"), F.col(f"`{content_col}`").cast("binary").alias("content"))
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
    schema = pa.schema([(n, kinds[x.split()[1]]) for n, x in zip(names, SCHEMA.split(", "), strict=True)])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0

        def flush() -> pa.RecordBatch:
            columns = zip(*out, strict=True) if out else [[] for _ in names]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                for row in convert(path.as_py(), content.as_py() or b""):
                    out.append(row)
                    size += len(row[-1])
                    if size > 8 << 20:
                        yield flush()
                        out, size = [], 0
        yield flush()

    return rows.mapInArrow(run, SCHEMA)


def pages_to_arc(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", epoch: int = 820_454_400) -> DataFrame:
    """(path, content): an ARC file of each page, even ids in version 1 lines and odd ids in version 2 lines, every third compressed.

    What a file holds depends on its page alone. Page ``i`` was archived ``i`` seconds after ``epoch`` and is served as HTML over
    HTTP; a page without an id counts as one with 0, whose file has no number.
    """
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{url_col}`"), F.lit("about:blank")).alias("url"), F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("html"))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, files = [], []
            for page, url, html in zip(*(batch.column(c).to_pylist() for c in ("id", "url", "html")), strict=True):
                i = page or 0
                name = f"page-{'' if page is None else page}.arc"
                head = b"1 1 revlake\nURL IP-address Archive-date Content-type Archive-length\n"
                body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + html.encode()
                date = (datetime.datetime(1970, 1, 1) + datetime.timedelta(seconds=epoch + i)).strftime("%Y%m%d%H%M%S").encode()
                line = (re.sub(r"\s", "%20", url).encode(), f"10.{i >> 16 & 255}.{i >> 8 & 255}.{i & 255}".encode(), date)
                parts = [b"filedesc://%s 0.0.0.0 19960101000000 text/plain %d\n%s\n" % (name.encode(), len(head), head)]
                if i % 2:
                    parts.append(b"%s %s %s text/html 200 - - 0 %s %d\n%s\n" % (*line, name.encode(), len(body), body))
                else:
                    parts.append(b"%s %s %s text/html %d\n%s\n" % (*line, len(body), body))
                names.append(name + ".gz" * (i % 3 == 0))
                files.append(b"".join(map(gzip.compress, parts) if i % 3 == 0 else parts))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(files, pa.binary())], ["path", "content"])

    return rows.mapInArrow(run, "path string, content binary")
