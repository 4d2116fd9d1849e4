"""MPEG audio columns: frames, tags, seek tables, checksums and exact durations of MPEG-1, 2 and 2.5 streams.

A frame is accepted where its header is valid and either the stream ends with it or a header of the same version, layer
and sample rate follows at its end. Elsewhere the reader resynchronises: it goes to the next such place and
counts what it skipped; a header of the stream with no such place within its length is a frame before junk. ID3v2 and APEv2 at the start, ID3v1 and APEv2 at the end are parsed or passed over. A first frame that
holds a Xing, Info or VBRI table is no audio; its frame count, seek points and the encoder's delay and padding are
kept. The duration is the samples of all whole frames, less delay and padding, over the sample rate. Checksums of protected
frames are verified in every layer. In a stream of free bitrate, whose headers declare no
length, it is the distance to the next equal header, found once where a third header or the end of the file confirms it; a lone
frame of free bitrate has no such place and counts as junk.

Files may be of any length, and hold any number of tags, tables and runs of junk; equal files give equal rows, and repeated ids a row each.
A null or empty file, or one without frames, has 0 frames and null stream columns. A frame cut off by the end of the
file is not counted; the file is then ``truncated``. Of tags named twice the first stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tidy

_RATES = {3: (44100, 48000, 32000), 2: (22050, 24000, 16000), 0: (11025, 12000, 8000)}
_V1 = {
    3: (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    2: (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    1: (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
}
_V2 = {3: (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256), 2: (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160)}
_V2[1] = _V2[2]
_NAMES = {3: "1", 2: "2", 0: "2.5"}
#: Layer II: bits of the allocation of each subband, by table.
_ALLOCATION = {"high": (4,) * 11 + (3,) * 12 + (2,) * 7, "low": (4,) * 2 + (3,) * 10, "lsf": (4,) * 4 + (3,) * 7 + (2,) * 19}
#: Most bytes of a frame of free bitrate.
FREE_BYTES = 1 << 15
SCHEMA = (
    "mpeg_version string, layer int, sample_rate int, channels int, n_frames long, n_samples long, duration double, bitrate_mode string, bitrate int, table_kind string, table_frames long, "
    "table_toc array<int>, delay int, padding int, crc_ok long, crc_bad long, skipped long, truncated boolean, tags map<string,string>, offsets array<long>"
)


class Header:
    """What four bytes say; None from ``header`` if they are no frame header."""

    __slots__ = ("bitrate", "channels", "extension", "free", "layer", "length", "mode", "protected", "rate", "samples", "side", "version")


_headers: dict[int, Header | None] = {}


def header(data: bytes, at: int) -> Header | None:
    raw = int.from_bytes(data[at : at + 4]) if at + 4 <= len(data) else 0
    h = _headers.get(raw, False)
    if h is False:
        if len(_headers) > 1 << 16:
            _headers.clear()
        h = _headers[raw] = _read(raw)
    return h


def _read(raw: int) -> Header | None:
    version, layer, rate, bits = raw >> 19 & 3, raw >> 17 & 3, raw >> 10 & 3, raw >> 12 & 15
    if raw >> 21 != 0x7FF or version == 1 or layer == 0 or rate == 3 or bits in (0, 15) or raw & 3 == 2:
        return None
    h = Header()
    h.free = False
    h.version, h.layer, h.rate, h.mode, h.extension = version, 4 - layer, _RATES[version][rate], raw >> 6 & 3, raw >> 4 & 3
    h.bitrate, h.protected, h.channels = (_V1 if version == 3 else _V2)[layer][bits], not raw >> 16 & 1, 1 if h.mode == 3 else 2
    padding = raw >> 9 & 1
    h.samples = 384 if h.layer == 1 else 1152 if h.layer == 2 or version == 3 else 576
    h.length = (12000 * h.bitrate // h.rate + padding) * 4 if h.layer == 1 else h.samples // 8 * h.bitrate * 1000 // h.rate + padding
    h.side = (32 if h.channels == 2 else 17) if version == 3 else (17 if h.channels == 2 else 9)
    return h


def _free(data: bytes, at: int, base: int) -> Header | None:
    """The header of a frame of free bitrate, which has ``base`` bytes without padding."""
    raw = int.from_bytes(data[at : at + 4]) if at + 4 <= len(data) else 0
    h = _read(raw | 1 << 12) if raw >> 12 & 15 == 0 else None
    if h is not None:
        slot = 4 if h.layer == 1 else 1
        h.free, h.length = True, base + slot * (raw >> 9 & 1)
        h.bitrate = round(base * h.rate / (48000 if h.layer == 1 else h.samples // 8 * 1000))
    return h


def _free_base(data: bytes, at: int, end: int) -> int | None:
    """Bytes without padding of the frames of the free bitrate stream that begins here; None if none does."""
    h = _free(data, at, 0)
    if h is None:
        return None
    same = lambda p: p + 4 <= end and int.from_bytes(data[p : p + 4]) & 0xFFFFFC00 == int.from_bytes(data[at : at + 4]) & 0xFFFFFC00
    later = at + 24
    while (later := data.find(data[at : at + 2], later, min(end, at + FREE_BYTES))) >= 0:
        base = later - at - h.length
        n = _free(data, later, base) if same(later) else None
        if n is not None and (later + n.length == end or same(later + n.length)):
            return base
        later += 1
    return None


def _header(data: bytes, at: int, base: int | None) -> Header | None:
    return header(data, at) if base is None else _free(data, at, base)


def _crc_table() -> list[int]:
    out = []
    for byte in range(256):
        crc = byte << 8
        for _ in range(8):
            crc = crc << 1 ^ (0x8005 if crc & 0x8000 else 0)
        out.append(crc & 0xFFFF)
    return out


_CRC = _crc_table()


def crc16(data: bytes, bits: int | None = None) -> int:
    """CRC-16 of MPEG audio over whole bytes or the first ``bits`` of data."""
    whole = len(data) if bits is None else bits // 8
    crc = 0xFFFF
    for byte in data[:whole]:
        crc = crc << 8 & 0xFFFF ^ _CRC[crc >> 8 ^ byte]
    for k in range(0 if bits is None else bits % 8):
        bit = data[whole] >> 7 - k & 1
        crc = crc << 1 & 0xFFFF ^ (0x8005 if crc >> 15 ^ bit else 0)
    return crc


def protected_bits(h: Header, body: bytes) -> int:
    """How many bits after the checksum it covers."""
    if h.layer == 3:
        return 8 * h.side
    bound = 4 * (h.extension + 1) if h.mode == 1 else 32
    if h.layer == 1:
        return 4 * (32 if h.channels == 1 else min(bound, 32) + 32)
    each = 192 if h.free else h.bitrate // h.channels
    if h.version != 3:
        kind, bands = "lsf", 30
    elif (h.rate == 48000 and each >= 56) or 56 <= each <= 80:
        kind, bands = "high", 27
    elif each > 80:
        kind, bands = "high", 30
    else:
        kind, bands = "low", 12 if h.rate == 32000 else 8
    value, size, at, chosen = int.from_bytes(body[:64]), 8 * len(body[:64]), 0, 0
    for band in range(bands):
        n = _ALLOCATION[kind][band]
        for _ in range(h.channels if band < bound else 1):
            if value >> max(0, size - at - n) & (1 << n) - 1:
                chosen += 1 if band < bound else h.channels
            at += n
    return at + 2 * chosen


def checksum(h: Header, frame: bytes) -> int:
    """The checksum that a protected frame should have."""
    body = frame[6:]
    bits = protected_bits(h, body)
    return crc16(frame[2:4] + body[: -(-bits // 8)], 16 + bits)


def _syncsafe(b: bytes) -> int:
    return b[0] << 21 | b[1] << 14 | b[2] << 7 | b[3]


def _text(b: bytes) -> str:
    encoding = {0: "latin-1", 1: "utf-16", 2: "utf-16-be", 3: "utf-8"}.get(b[0] if b else 9)
    return b[1:].decode(encoding, "replace").rstrip("\0") if encoding else ""


_OLD = {"TT2": "TIT2", "TP1": "TPE1", "TAL": "TALB", "TYE": "TYER", "TRK": "TRCK", "TCO": "TCON"}


def id3v2(data: bytes, at: int, tags: dict[str, str]) -> int:
    """Place behind the ID3v2 tag at ``at``; its text frames go to ``tags``."""
    major, flags, end = data[at + 3], data[at + 5], at + 10 + _syncsafe(data[at + 6 : at + 10])
    p, body = 10, data[at : min(end, len(data))]
    if flags & 0x80 and major < 4:
        body = body[:10] + body[10:].replace(b"\xff\x00", b"\xff")
    if flags & 0x40 and major > 2 and len(body) >= 14:
        p += _syncsafe(body[10:14]) if major == 4 else 4 + int.from_bytes(body[10:14])
    width = 3 if major == 2 else 4
    while p + 2 * width + (2 if major > 2 else 0) <= len(body) and body[p]:
        name = body[p : p + width].decode("latin-1")
        raw = body[p + width : p + 2 * width]
        size = _syncsafe(raw) if major == 4 else int.from_bytes(raw)
        p += 2 * width + (2 if major > 2 else 0)
        if name[0] == "T" and name[1:] not in ("XX", "XXX") and size > 0:
            tags.setdefault(_OLD.get(name, name), _text(body[p : p + size]))
        p += size
    return end + (10 if flags & 0x10 else 0)


def id3v1(tag: bytes, tags: dict[str, str]) -> None:
    for name, a, b in (("TIT2", 3, 33), ("TPE1", 33, 63), ("TALB", 63, 93), ("TYER", 93, 97), ("COMM", 97, 127 - 2 * (tag[125] == 0 and tag[126] != 0))):
        if value := tag[a:b].split(b"\0")[0].decode("latin-1").strip():
            tags.setdefault(name, value)
    if tag[125] == 0 and tag[126]:
        tags.setdefault("TRCK", str(tag[126]))


def vbr_table(h: Header, frame: bytes) -> dict | None:
    for at in (4 + h.side, 6 + h.side):
        if frame[at : at + 4] in (b"Xing", b"Info"):
            out = {"kind": frame[at : at + 4].decode(), "frames": None, "toc": None, "delay": 0, "padding": 0}
            flags, p = int.from_bytes(frame[at + 4 : at + 8]), at + 8
            if flags & 1:
                out["frames"] = int.from_bytes(frame[p : p + 4])
                p += 4
            p += 4 * (flags >> 1 & 1)
            if flags & 4:
                out["toc"] = list(frame[p : p + 100])
            extra = frame[at + 120 : at + 144]
            if len(extra) == 24 and extra[:4] in (b"LAME", b"Lavf", b"Lavc", b"GOGO"):
                gap = int.from_bytes(extra[21:24])
                out["delay"], out["padding"] = gap >> 12, gap & 4095
            return out
    if frame[36:40] == b"VBRI" and len(frame) >= 62:
        n, scale, size = (int.from_bytes(frame[a : a + 2]) for a in (54, 56, 58))
        toc = [int.from_bytes(frame[62 + size * i : 62 + size * (i + 1)]) * scale for i in range(n) if 62 + size * (i + 1) <= len(frame)]
        return {"kind": "VBRI", "frames": int.from_bytes(frame[50:54]), "toc": toc, "delay": 0, "padding": 0}
    return None


def parse(data: bytes) -> dict:
    """The columns of SCHEMA."""
    tags: dict[str, str] = {}
    at, end = 0, len(data)
    while data[at : at + 3] == b"ID3" and at + 10 <= end and max(data[at + 6 : at + 10]) < 128:
        at = id3v2(data, at, tags)
    if data[at : at + 8] == b"APETAGEX" and at + 32 <= end:
        at += 32 + int.from_bytes(data[at + 12 : at + 16], "little")
    if end - at >= 128 and data[end - 128 : end - 125] == b"TAG":
        id3v1(data[end - 128 : end], tags)
        end -= 128
    if end - at >= 32 and data[end - 32 : end - 24] == b"APETAGEX":
        end = max(at, end - int.from_bytes(data[end - 20 : end - 16], "little") - 32 * (data[end - 9] >> 7))
    first, table, offsets, rates, crc, skipped, truncated = None, None, [], set(), [0, 0], 0, False
    at, base = min(at, end), None

    def take(at: int, after: int, h: Header) -> None:
        offsets.append(at)
        rates.add(h.bitrate)
        if h.protected:
            crc[int.from_bytes(data[at + 4 : at + 6]) != checksum(h, data[at:after])] += 1

    while at < end:
        if first is None:
            base = _free_base(data, at, end)
        h = _header(data, at, base)
        if h is not None and (first is None or (h.version, h.layer, h.rate) == first):
            after = at + h.length
            n = _header(data, after, base) if after + 4 <= end else None
            if after == end or (n is not None and (n.version, n.layer, n.rate) == (h.version, h.layer, h.rate)):
                if first is None:
                    first = h.version, h.layer, h.rate
                    table = vbr_table(h, data[at:after]) if h.layer == 3 else None
                    stream = h
                if table is None or offsets or at > table.setdefault("at", at):
                    take(at, after, h)
                at = after
                continue
            if after > end and first is not None:
                truncated = True
                skipped += end - at
                break
            if first is not None and offsets and after < end:
                later = _resync(data, at + 1, end, first, base)
                if later is not None and later >= after:  # junk follows a whole frame
                    take(at, after, h)
                    skipped += later - after
                    at = later
                    continue
        later = _resync(data, at + 1, end, first, base)
        if later is None:
            skipped += end - at
            break
        skipped += later - at
        at = later
    out = dict.fromkeys((x.split()[0] for x in SCHEMA.split(", ")), None)
    out |= {"n_frames": len(offsets), "n_samples": 0, "crc_ok": crc[0], "crc_bad": crc[1], "skipped": skipped, "truncated": truncated, "tags": tags, "offsets": offsets}
    if first is not None:
        delay, padding = (table["delay"], table["padding"]) if table else (0, 0)
        samples = len(offsets) * stream.samples
        out |= {"mpeg_version": _NAMES[first[0]], "layer": first[1], "sample_rate": first[2], "channels": stream.channels, "n_samples": samples}
        out |= {"duration": max(0, samples - delay - padding) / first[2], "bitrate_mode": "vbr" if len(rates) > 1 else "cbr", "bitrate": next(iter(rates)) if len(rates) == 1 else None}
        if table:
            out |= {"table_kind": table["kind"], "table_frames": table["frames"], "table_toc": table["toc"], "delay": delay, "padding": padding}
    return out


def _resync(data: bytes, at: int, end: int, first: tuple | None, base: int | None) -> int | None:
    """The next place where a frame of the stream, if there is one already, and then another header or the end stand."""
    while True:
        at = data.find(b"\xff", at, end)
        if at < 0:
            return None
        if first is None:
            base = _free_base(data, at, end)
        h = _header(data, at, base)
        if h is not None and (first is None or (h.version, h.layer, h.rate) == first):
            after = at + h.length
            n = _header(data, after, base) if after + 4 <= end else None
            if after == end or (n is not None and (n.version, n.layer, n.rate) == (h.version, h.layer, h.rate)):
                return at
        at += 1


def parse_audio(files: DataFrame, id_col: str = "path", content_col: str = "content") -> DataFrame:
    """(id_col, columns of SCHEMA) of each file, as ``binaryFile`` reads them; an id named like one of these becomes ``file_`` and its name."""
    rows = files.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{content_col}`").cast("binary").alias("content"))
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    types = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64()), "map<string,string>": pa.map_(pa.string(), pa.string())}
    kinds = [types[x.split()[1]] for x in SCHEMA.split(", ")]

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [parse(c.as_buffer().to_pybytes() if c.is_valid else b"") for c in batch.column("content")]
            columns = [pa.array([list(g[n].items()) if n == "tags" else g[n] for g in got], t) for n, t in zip(names, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], ["id", *names])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, {SCHEMA}").withColumnRenamed("id", f"file_{id_col}" if id_col in names else id_col)


def build(version: int, layer: int, rate: int, bitrates: list[int], payload: bytes, mode: int = 0, protect: bool = False, title: str | None = None, table: bool = False, gap: tuple[int, int] = (0, 0), junk: dict[int, bytes] | None = None, tail: bool = False) -> bytes:
    """A stream whose frames, of the given bitrate indexes in turn, carry the payload in order; junk: bytes before the n-th frame."""
    out = []
    if title is not None:
        text = b"\x03" + title.encode()
        size = lambda n: bytes([n >> 21 & 127, n >> 14 & 127, n >> 7 & 127, n & 127])
        frame = b"TIT2" + size(len(text)) + b"\0\0" + text
        out.append(b"ID3\x04\0\0" + size(len(frame)) + frame)

    def head(bits: int, crc: bool) -> bytes:
        raw = 0x7FF << 21 | version << 19 | (4 - layer) << 17 | (not crc) << 16 | bits << 12 | rate << 10 | mode << 6
        return raw.to_bytes(4)

    at, n, frames = 0, 0, []
    while at < len(payload) or not frames:
        raw = head(bitrates[n % len(bitrates)], protect)
        h = header(raw, 0)
        room = h.length - 4 - 2 * protect
        body = payload[at : at + room].ljust(room, b"\0")
        at += room
        frame = raw + b"\0\0" * protect + body
        if protect:
            frame = frame[:4] + checksum(h, frame).to_bytes(2) + frame[6:]
        frames.append((junk or {}).get(n, b"") + frame)
        n += 1
    if table:
        raw = head(14, False)
        h = header(raw, 0)
        info = b"\0" * h.side + (b"Xing" if len(bitrates) > 1 else b"Info") + (5).to_bytes(4) + n.to_bytes(4) + bytes(range(0, 200, 2))
        info = info.ljust(h.side + 120, b"\0") + b"LAME3.100" + b"\0" * 12 + (gap[0] << 12 | gap[1]).to_bytes(3)
        out.append((raw + info).ljust(h.length, b"\0"))
    out += frames
    if tail:
        out.append(b"TAG" + b"tail".ljust(30, b"\0") + b"\0" * 92 + b"\0\x07\x0c")
    return b"".join(out)


def pages_to_audio(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, content): the page's bytes as the payload of an audio stream whose form depends on the id."""
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").alias("url"), F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("html"))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
                i = i or 0
                layer = (3, 3, 3, 2, 1)[i % 5]
                junk = {k: b"\xff\xfb\xf0junk\xff" * (1 + k % 3) for k in range(2, 40, 7)} if i % 4 == 0 else None
                out.append(build(
                    (3, 2, 0)[i % 3] if layer == 3 else 3, layer, i % 3, [9, 5, 12] if i % 2 else [9], html.encode(), 3 if i % 7 == 0 and layer != 2 else 0,
                    i % 3 == 1, url, layer == 3 and i % 2 == 1, (576, 100) if i % 5 == 1 else (0, 0), junk, i % 6 == 0,
                ))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), pa.array(out, pa.binary())], ["page_id", "content"])

    return rows.mapInArrow(run, "page_id long, content binary")
