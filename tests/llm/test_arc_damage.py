"""Damaged gzip files and long header lines lose nothing that can be read."""

import gzip
import random

from test_arc import HEAD, HTTP, rows, v1, v2


def test_gzip_goes_on_behind_a_damaged_member():
    texts = [random.Random(k).randbytes(3000) for k in range(5)]
    members = [gzip.compress(v1(b"http://a.b/%d" % k, t)) for k, t in enumerate(texts)]
    broken = bytearray(members[1])
    broken[1500:1540] = b"\xff" * 40
    for bad in (bytes(broken), members[1][:900]):
        got = rows(members[0] + bad + b"".join(members[2:]))
        assert [r["block"] for r in got if r["url"] != "http://a.b/1"] == [texts[0], *texts[2:]]
        assert all(not r["truncated"] for r in got if r["url"] != "http://a.b/1")
        assert any(r["skipped"] or r["truncated"] for r in got)
    deflated = gzip.compress(v1(b"http://a.b/9", b"some words " * 4000))
    bad = deflated[:100] + b"\xff" * 60 + deflated[160:]
    got = rows(gzip.compress(HEAD) + bad + members[2])
    assert got[-1]["url"] == "http://a.b/2" and got[-1]["block"] == texts[2] and got[-1]["skipped"] > 0


def test_padding_between_members():
    one, two = gzip.compress(v1(b"http://a.b/1", HTTP)), gzip.compress(v2(b"http://a.b/2", HTTP))
    for padding in (b"\0" * 512, b"junk", b"\x1f\x8b"):
        got = rows(one + padding + two + padding)
        assert [(r["url"], r["skipped"], r["truncated"], r["block"]) for r in got] == [("http://a.b/1", 0, False, HTTP), ("http://a.b/2", len(padding), False, HTTP)]
    data = v1(b"http://a.b/1", HTTP)
    got = rows(gzip.compress(data[:60]) + b"\0" * 8 + gzip.compress(data[60:]))
    assert [r["block"] for r in got] == [HTTP]


def test_long_header_lines():
    url = b"http://a.b/" + b"x" * 100_000
    got = rows(v1(b"http://a.b/1", HTTP) + v2(url, HTTP) + v1(url, HTTP))
    assert [len(r["url"]) for r in got] == [12, len(url), len(url)] and not any(r["skipped"] for r in got)
    assert rows(b"y" * 100_000 + b"\n" + v1(b"http://a.b/1", HTTP))[0]["skipped"] == 100_001
