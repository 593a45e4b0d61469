import hashlib
from collections import Counter

import pytest

from facetide.llm import warc


def arc(head, fields, records):
    """An archive with its declared lengths."""
    out = b""
    for line, body in [(head, fields), *records]:
        out += line + b" %d\n" % len(body) + body + b"\n"
    return out


FIELDS = b"URL IP-address Archive-date Content-type"
V1 = arc(b"filedesc://old.arc 0.0.0.0 19960923142103 text/plain", b"1 0 AlexaInternet\n" + FIELDS + b" Archive-length\n", [
    (b"\nhttp://www.dryswamp.edu:80/index.html 127.10.100.2 19961104142103 text/html; charset=x", b"HTTP/1.0 200 OK\r\nA: b\r\n\r\nhello\nwo"),
    (b"dns:www.dryswamp.edu 10.0.0.1 199611041421 text/dns", b"abcd")])
V2 = arc(b"filedesc://new.arc 0.0.0.0 19960923142103 text/plain 200 - - 0 new.arc",
         b"2 0 AlexaInternet\n" + FIELDS + b" Result-code Checksum Location Offset Filename Archive-length\n",
         [(b"http://a/ 1.2.3.4 19961104142103 text/html 200 fac069150613fe55 - 209 new.arc", b"HTTP/1.0 200 OK\r\n\r\n12345")])


def test_both_versions():
    rows = list(warc.parse_arc(V1))
    assert [(r[1], r[2], r[3], r[4], len(r[5])) for r in rows] == [
        ("http://www.dryswamp.edu:80/index.html", "127.10.100.2", "19961104142103", "text/html; charset=x", 33),
        ("dns:www.dryswamp.edu", "10.0.0.1", "199611041421", "text/dns", 4)]
    (offset, url, ip, date, kind, block), = warc.parse_arc(V2)
    assert (url, ip, kind, block) == ("http://a/", "1.2.3.4", "text/html", b"HTTP/1.0 200 OK\r\n\r\n12345")
    with pytest.raises(ValueError):
        list(warc.parse_arc(V2[:-3]))


def test_converted_records():
    for archive, data in (("old.arc", V1), ("new.arc", V2)):
        records = list(warc.parse_warc(b"".join(warc._converted(archive, data, {}))))
        heads = [h for h, _ in records]
        assert [warc._field(h, "WARC-Type") for h in heads] == ["warcinfo", "response", "resource"][:len(heads)]
        assert len({warc._field(h, "WARC-Record-ID") for h in heads}) == len(heads)
        assert warc._field(heads[1], "WARC-Date") == "1996-11-04T14:21:03Z"
        for (head, block), (*_, old) in zip(records[1:], warc.parse_arc(data)):
            assert block == old and warc._field(head, "WARC-Block-Digest") == warc._digest(block)


PAGES = [(1, "http://a/ b\n", "x" * 999), (2, None, "x" * 999), (3, "http://c", "y" * 1000), (4, "-", "y" * 1000), (None, "http://d", "y" * 1000),
         (5, "http://e", None), (6, "", ""), (7, "http://é", "日本\r\n\r\nWARC/1.1\r\n" * 200), (7, "http://é", "日本\r\n\r\nWARC/1.1\r\n" * 200),
         (None, None, None), (8, "u", "HTTP/1.1 x\n\n" * 300_000), (9, "u", "HTTP/1.1 x\n\n" * 300_000)]


def brute(rows):
    held = [(p, u, (h or "").encode()) for p, u, h in rows]
    groups, out = {}, []
    for p, _, b in held:
        groups.setdefault(b, []).append(p)
    for p, _, b in held:
        group = groups[b]
        top = max((x for x in group if x is not None), default=None)
        first = len(b) < 1000 or p == top
        out.append((p, len(b), hashlib.sha1(b).hexdigest(), "response" if first else "revisit", None if first else top))
    return out


def test_round_trip(spark, monkeypatch):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(3)
    got = warc.read_warc(spark, warc.pages_to_warc(pages)).collect()
    want = brute(PAGES)
    # Of two rows alike, one is the response.
    i = max(k for k, w in enumerate(want) if w[0] == 7)
    want[i] = (*want[i][:3], "revisit", 7)
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == Counter(want)
    ids = {r["record_id"]: r["record_type"] for r in got}
    assert len(ids) == len(PAGES) and all(ids[r["refers_to_record"]] == "response" for r in got if r["record_type"] == "revisit")
    assert {r["url"] for r in got if r["page_id"] in (1, 4)} == {"http://a/%20b%0A", "%2D"}
    assert warc.read_warc(spark, warc.pages_to_warc(pages.limit(0))).count() == 0
