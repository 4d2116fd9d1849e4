import gzip
import uuid

import pytest

from revlake.llm.arc import arc_to_warc, convert, iso_date, pages_to_arc, sha1, warc_record

HTTP = b"HTTP/1.0 404 Not Found\r\nServer: x\r\n\r\n<html>\n\nhttp://a.b/ 1.2.3.4 19970101000000 text/html 5\nhello</html>"
HEAD = b"filedesc://x.arc 0.0.0.0 19970101000000 text/plain 10\n0123456789\n"


def v1(url, block, date=b"19970102030405", kind=b"text/html", length=None):
    return b"%s 10.0.0.1 %s %s %d\n%s\n" % (url, date, kind, len(block) if length is None else length, block)


def v2(url, block):
    return b"%s 10.0.0.1 20010203040506 text/html 404 ABC - 77 x.arc %d\n%s\n" % (url, len(block), block)


def rows(data, path="x.arc"):
    names = ["path", "offset", "version", "skipped", "truncated", "type", "id", "url", "ip", "date", "content_type", "length", "block_digest", "payload_digest", "status", "block"]
    return [dict(zip(names, r, strict=True)) for r in convert(path, data)]


def test_both_versions_and_types():
    data = HEAD + v1(b"http://a.b/x y", HTTP) + v2(b"http://a.b/2", HTTP) + v1(b"dns:a.b", b"19970102030405\na.b. 1 IN A 10.0.0.1", kind=b"text/dns") + v1(b"ftp://a.b/f", b"", kind=b"no-type")
    for variant in (data, gzip.compress(data), gzip.compress(HEAD) + gzip.compress(data[len(HEAD) :])):
        info, one, two, dns, ftp = rows(variant)
        assert [r["type"] for r in (info, one, two, dns, ftp)] == ["warcinfo", "response", "response", "resource", "resource"]
        assert [r["version"] for r in (info, one, two, dns, ftp)] == [1, 1, 2, 1, 1]
        assert one["url"] == "http://a.b/x y" and one["date"] == "1997-01-02T03:04:05Z" and one["status"] == 404 and one["block"] == HTTP
        assert one["payload_digest"] == sha1(HTTP.split(b"\r\n\r\n", 1)[1]) and one["block_digest"] == sha1(HTTP) != one["payload_digest"]
        assert dns["content_type"] == "text/dns" and dns["payload_digest"] is None and ftp["length"] == 0
        assert not any(r["skipped"] or r["truncated"] for r in (info, one, two, dns, ftp))
        assert len({r["id"] for r in (info, one, two, dns, ftp)}) == 5 and uuid.UUID(one["id"][10:-1]).version == 5
    assert sha1(b"") == "sha1:3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"


def test_damage():
    good = v1(b"http://a.b/1", b"abc")
    short = v1(b"http://a.b/2", b"wrong length", length=4)
    first, second, third = rows(good + short + v2(b"http://a.b/3", b"x"))
    assert second["block"] == b"wron" and third["url"] == "http://a.b/3" and third["skipped"] == len(b"g length\n")
    cut = rows(good + v1(b"http://a.b/4", b"abc", length=100))
    assert cut[1]["truncated"] and cut[1]["block"] == b"abc\n"
    assert rows(b"") == rows(b"\n\n\n") == rows(b"junk\xff\n" * 50) == rows(b"x" * 200_000) == []
    assert rows(b"junk\n" + good)[0]["skipped"] == 5


@pytest.mark.parametrize("given,want", [(b"19961231235959", "1996-12-31T23:59:59Z"), (b"19970228", "1997-02-28T00:00:00Z"), (b"970228010203", "1997-02-28T01:02:03Z"), (b"199702280102", "1997-02-28T01:02:00Z"), (b"19970230000000", None)])
def test_dates(given, want):
    assert iso_date(given) == want


def test_tables(spark):
    data = HEAD + v1(b"http://a.b/1", HTTP)
    df = spark.createDataFrame([(b"", "e", 1), (None, "n", 2), (data, "f", 3), (data, "f", 3), (data, None, 4)], "content binary, path string, offset int")
    got = arc_to_warc(df).collect()
    assert sorted((r.path or "", r.warc_type) for r in got) == [("", "response"), ("", "warcinfo"), *[("f", "response")] * 2, *[("f", "warcinfo")] * 2]
    text = warc_record(next(r for r in got if r.warc_type == "response"))
    assert text.startswith(b"WARC/1.0\r\nWARC-Type: response\r\n") and text.endswith(HTTP + b"\r\n\r\n") and b"Content-Length: %d\r\n" % len(HTTP) in text
    assert arc_to_warc(df.limit(0)).count() == 0


def test_pages_round_trip(spark):
    pages = spark.createDataFrame([(i, f"http://x.y/{i} z", "<p>é\n\n</p>" * i) for i in range(150)] + [(None, "a:b", "c"), (200, None, None)], "page_id long, url string, html string")
    got = [r for r in arc_to_warc(pages_to_arc(pages)).collect() if r.warc_type == "response"]
    assert len(got) == 152 and not any(r.skipped or r.truncated for r in got)
    for r in got:
        if r.target_uri.startswith("http"):
            i = int(r.target_uri.split("/")[-1].split("%")[0])
            assert bytes(r.block).split(b"\r\n\r\n", 1)[1].decode() == "<p>é\n\n</p>" * i and r.arc_version == 1 + i % 2


def test_long_header_lines_and_records():
    address = b"http://a.b/" + b"x" * 300_000
    for data in (HEAD + v1(address, HTTP) + v2(b"http://a.b/2", b"y" * 5_000_000), b"".join(map(gzip.compress, (HEAD, v1(address, HTTP), v2(b"http://a.b/2", b"y" * 5_000_000))))):
        got = rows(data)
        assert [r["url"] if "url" in r else r["target_uri"] for r in got][1].startswith("http://a.b/xxx") and len(got) == 3
        assert not any(r["skipped"] or r["truncated"] for r in got) and len(got[2]["block"]) == 5_000_000
