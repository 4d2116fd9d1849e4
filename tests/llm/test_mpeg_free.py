"""Streams of free bitrate."""

import itertools
import random

import pytest

from revlake.llm.mpeg import _RATES, _free, build, checksum, parse


def free(version, layer, rate, base, n, protect=False, padded=lambda k: k % 3 == 0):
    out, rng = [], random.Random(base)
    for k in range(n):
        pad = padded(k)
        raw = (0x7FF << 21 | version << 19 | (4 - layer) << 17 | (not protect) << 16 | rate << 10 | pad << 9).to_bytes(4)
        frame = raw + b"\0\0" + bytes(rng.choices(range(255), k=base + pad * (4 if layer == 1 else 1) - 6))
        if protect:
            frame = frame[:4] + checksum(_free(frame, 0, base), frame).to_bytes(2) + frame[6:]
        out.append(frame)
    return out


@pytest.mark.parametrize("version,layer,rate", list(itertools.product((3, 2, 0), (1, 2, 3), (0, 1, 2))))
def test_free_bitrate(version, layer, rate):
    for protect, n, base in itertools.product((False, True), (2, 3, 40), (240, 1044, 2088)):
        frames = free(version, layer, rate, base, n, protect)
        got = parse(b"".join(frames))
        samples = 384 if layer == 1 else 1152 if layer == 2 or version == 3 else 576
        assert got["n_frames"] == n and got["offsets"] == [0, *itertools.accumulate(map(len, frames[:-1]))]
        assert got["duration"] == n * samples / _RATES[version][rate] and got["bitrate_mode"] == "cbr"
        assert got["bitrate"] == round(8 * base * _RATES[version][rate] / samples / 1000)
        assert (got["crc_ok"], got["crc_bad"], got["skipped"], got["truncated"]) == (n if protect else 0, 0, 0, False)


def test_junk_and_cuts():
    frames = free(3, 3, 0, 2088, 12)
    data = b"lead-in \xff\xfa" * 9 + b"".join(frames[:5]) + b"noise\xff\xfb" * 20 + b"".join(frames[5:])
    got = parse(data)
    assert got["n_frames"] == 12 and got["skipped"] == 90 + 140 and not got["truncated"]
    cut = parse(data[:-20])
    assert cut["n_frames"] == 11 and cut["truncated"]


def test_declared_bitrates_are_read_as_before():
    plain, tail = build(3, 3, 0, [9], bytes(range(250)) * 40), b"".join(free(3, 3, 0, 500, 4))
    for stream in (plain + tail, plain + tail + plain):
        assert parse(stream) == parse(stream.replace(tail, b"n" * len(tail)))
