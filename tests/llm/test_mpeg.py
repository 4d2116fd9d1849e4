import itertools
import random

import pytest

from revlake.llm.mpeg import _RATES, build, crc16, header, parse, pages_to_audio, parse_audio


def test_header_lengths():
    for raw, length, samples in (("fffb9064", 417, 1152), ("fffb9264", 418, 1152), ("fff3a4c4", 288, 576), ("fffd8404", 384, 1152), ("ffff5400", 160, 384)):
        h = header(bytes.fromhex(raw), 0)
        assert (h.length, h.samples) == (length, samples), raw
    for bad in ("ffeb9064", "fff99064", "fffbf064", "fffb0064", "fffb9c64", "fffb9066", "7ffb9064"):
        assert header(bytes.fromhex(bad), 0) is None, bad


def test_crc_is_bitwise_division():
    def slow(bits):
        crc = 0xFFFF
        for b in bits:
            top = crc >> 15 ^ b
            crc = (crc << 1 & 0xFFFF) ^ (0x8005 if top else 0)
        return crc

    rng = random.Random(1)
    data = rng.randbytes(40)
    bits = [b >> 7 - k & 1 for b in data for k in range(8)]
    for n in (0, 1, 7, 8, 16, 77, 320):
        assert crc16(data, n) == slow(bits[:n])


@pytest.mark.parametrize("version,layer,rate", list(itertools.product((3, 2, 0), (1, 2, 3), (0, 1, 2))))
def test_streams(version, layer, rate):
    rng = random.Random(version * 9 + layer * 3 + rate)
    for mode, protect, table, vbr in itertools.product((0, 1, 3), (False, True), (False, True), (False, True)):
        table = table and layer == 3
        payload = bytes(rng.choices(range(255), k=rng.randint(1, 9000)))
        bitrates = [9, 5, 12] if vbr else [8]
        data = build(version, layer, rate, bitrates, payload, mode, protect, "Tïtle", table, (576, 33), None, True)
        got = parse(data)
        plain = build(version, layer, rate, bitrates, payload, mode, protect)
        offsets, at = [], len(data) - 128 - len(plain)
        for n in itertools.count():
            if at >= len(data) - 128:
                break
            offsets.append(at)
            at += header(data, at).length
        assert got["offsets"] == offsets and got["n_frames"] == len(offsets)
        per = header(plain, 0).samples
        assert got["duration"] == max(0, len(offsets) * per - (609 if table else 0)) / _RATES[version][rate]
        assert (got["crc_ok"], got["crc_bad"], got["skipped"], got["truncated"]) == (len(offsets) if protect else 0, 0, 0, False)
        assert got["tags"] == {"TIT2": "Tïtle", "TRCK": "7"} and got["channels"] == (1 if mode == 3 else 2)
        assert got["table_frames"] == (len(offsets) if table else None) and (got["table_toc"] or [0])[-1] == (198 if table else 0)
        assert got["bitrate_mode"] == ("vbr" if vbr and len(offsets) > 1 else "cbr")


def test_resynchronises_and_verifies():
    payload = bytes(i % 250 for i in range(20_000))
    junk = {3: b"\xff\xfb\x90", 7: b"noise" * 100, 9: b"\xff" * 50}
    data = build(3, 3, 0, [9], payload, protect=True, junk=junk)
    clean = parse(build(3, 3, 0, [9], payload, protect=True))
    got = parse(data)
    assert got["n_frames"] == clean["n_frames"] and got["skipped"] == sum(map(len, junk.values())) and got["crc_ok"] == got["n_frames"]
    before = b"lead-in \xff\xfa" * 9
    assert parse(before + data)["offsets"] == [o + len(before) for o in got["offsets"]]
    broken = bytearray(data)
    broken[got["offsets"][5] + 10] ^= 4
    assert (parse(bytes(broken))["crc_ok"], parse(bytes(broken))["crc_bad"]) == (got["n_frames"] - 1, 1)
    cut = parse(data[:-20])
    assert cut["truncated"] and cut["n_frames"] == got["n_frames"] - 1


def test_no_audio():
    for data in (b"", b"\xff" * 5000, b"ID3", b"ID3\x04\0\0\x7f\x7f\x7f\x7f", b"TAG" + b"\0" * 125, b"text " * 1000):
        got = parse(data)
        assert got["n_frames"] == 0 and got["duration"] is None and got["offsets"] == []


def test_tables(spark):
    a = build(3, 3, 0, [9], b"x" * 3000)
    df = spark.createDataFrame([(a, 1, "x"), (a, 1, "x"), (None, 2, "y"), (b"", None, None)], "content binary, path int, layer string")
    got = parse_audio(df).collect()
    assert sorted((str(r.path), r.n_frames) for r in got) == [("1", 8), ("1", 8), ("2", 0), ("None", 0)]
    assert parse_audio(df.limit(0)).count() == 0
    pages = spark.createDataFrame([(i, f"http://a/{i}", "é<p>" * (i * 37 % 900)) for i in range(120)] + [(None, None, None)], "page_id long, url string, html string")
    got = {r.page_id: r for r in parse_audio(pages_to_audio(pages), "page_id").collect()}
    for i in range(120):
        assert got[i].crc_bad == 0 and not got[i].truncated and got[i].tags["TIT2"] == f"http://a/{i}", i
        assert (got[i].crc_ok > 0) == (i % 3 == 1) and got[i].n_frames > 0
        if got[i].table_kind:
            assert got[i].table_frames == got[i].n_frames, i


def crc_by_bits(data, bits):
    """The polynomial x^16 + x^15 + x^2 + 1 from all ones, bit by bit."""
    crc = 0xFFFF
    for k in range(bits):
        top = crc >> 15 ^ (data[k // 8] >> (7 - k % 8) & 1)
        crc = (crc << 1 & 0xFFFF) ^ (0x8005 if top else 0)
    return crc


@pytest.mark.parametrize(
    ("head", "length", "samples", "rate", "bitrate"),
    [  # lengths of the standard: 144 (layer III of MPEG-2: 72) bytes, layer I 12 slots of 4 bytes, times bit rate over sample rate
        ("fffb9000", 417, 1152, 44100, 128), ("fffb9200", 418, 1152, 44100, 128), ("fffda400", 576, 1152, 48000, 192), ("ffffc800", 4 * (12 * 384000 // 32000), 384, 32000, 384),
        ("fff38000", 208, 576, 22050, 64), ("ffe3a800", 72 * 96000 // 8000, 576, 8000, 96),
    ],
)
def test_headers_written_by_hand(head, length, samples, rate, bitrate):
    head = bytes.fromhex(head)
    data = b"junk" + (head + b"\x55" * (length - 4)) * 9
    got = parse(data)
    assert (got["n_frames"], got["sample_rate"], got["bitrate"], got["skipped"]) == (9, rate, bitrate, 4)
    assert got["offsets"] == [4 + k * length for k in range(9)] and got["duration"] == 9 * samples / rate and got["crc_ok"] == got["crc_bad"] == 0


def test_checksum_written_by_hand():
    side = bytes(range(32))
    frame = lambda crc: b"\xff\xfa\x90\x00" + crc.to_bytes(2, "big") + side + b"\x33" * (417 - 38)
    good = crc_by_bits(b"\x90\x00" + side, 16 + 256)
    got = parse(frame(good) * 5 + frame(good ^ 1) + frame(good) * 2)
    assert (got["n_frames"], got["crc_ok"], got["crc_bad"]) == (8, 7, 1)


def test_an_id_named_like_a_column(spark):
    df = spark.createDataFrame([(7, bytearray(b"\xff\xfb\x90\x00" + b"\0" * 413) * 3, 1), (7, None, 1)], "layer int, content binary, tags int")
    got = parse_audio(df, "layer")
    assert got.columns[0] == "file_layer" and got.columns.count("layer") == 1
    assert sorted((r.file_layer, r.n_frames) for r in got.collect()) == [(7, 0), (7, 3)]


def test_a_long_file():
    got = parse((b"\xff\xfb\x90\x00" + b"\0" * 413) * 60_000)
    assert got["n_frames"] == 60_000 and got["duration"] == 60_000 * 1152 / 44100
