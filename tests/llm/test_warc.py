"""WARC archives: exact round trip, index, revisits, edge cases."""

import base64
import collections
import gzip
import hashlib
import tempfile

import pytest

from vitrine.llm import warc


def test_keys():
    assert warc.url_key("https://www.Example.org/a/B?x=1#f") == "org,example,www)/a/B?x=1#f"
    assert warc.url_key(None) == "" and warc.url_key("") == ")" and warc.url_key("no scheme/x") == "no%20scheme)/x"
    assert warc.url_key("http://h\t\n.é/") == "é,h%09%0A)/"


def test_record_is_standard_gzip_with_crlf_headers():
    digest = base64.b32encode(hashlib.sha1(b"<p>\r\n\r\n</p>").digest()).decode()
    data = gzip.decompress(warc.record(4, "http://a/\nb", b"<p>\r\n\r\n</p>", digest, None))
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and data.endswith(b"\r\n\r\n</p>\r\n\r\n")
    back = warc.parse(warc.record(4, "http://a/\nb", b"<p>\r\n\r\n</p>", digest, None))
    assert back["payload"] == b"<p>\r\n\r\n</p>" and back["url"] == "http://a/%0Ab"
    with pytest.raises(ValueError):
        warc.parse(warc.record(4, "http://a/", b"other", digest, None))


def pages():
    rows = [(k, f"http{'s' * (k % 2)}://{'wm'[k % 2]}.h{k % 13}.example.org/p/{k}", f"<html>{k % 40} é</html>" * (1 + k % 5)) for k in range(400)]
    rows += [(1000 + k, "http://hot.example.org/", f"body {k}") for k in range(300)]
    return rows + [(2000, None, "null url"), (2001, None, None), (2002, "http://x/", ""), (2003, "plain", "é" * 300_000), (2004, "", "same"),
                   (2004, "", "same"), (2005, "http://x/", "same"), (None, "http://y/", "same"), (None, "http://y/", "alone")]


def expected(rows, least=0):
    first = {}
    for i, _, h in rows:
        body = (h or "").encode()
        if len(body) >= least and i is not None:
            first[body] = min(first.get(body, i), i)
    out = collections.Counter()
    for i, _, h in rows:
        body = (h or "").encode()
        head = first.get(body)
        refers = head if head is not None and head != i else None
        out[(i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if refers is not None else "response", refers)] += 1
    return out


@pytest.mark.parametrize("least", [0, 20])
def test_round_trip_through_the_index(spark, monkeypatch, least):
    monkeypatch.setattr(warc, "BLOCK_LINES", 16)
    rows = pages()
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string").repartition(5)
    folder = "file://" + tempfile.mkdtemp()
    archive = warc.write_archive(df, folder, least_bytes=least)
    got = warc.read_captures(archive, df).collect()
    assert collections.Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == expected(rows, least)
    texts = {i: (h or "").encode() for i, _, h in rows if i is not None}
    assert all(bytes(r["payload"]) == texts[r["page_id"]] for r in got if r["record_type"] == "response" and r["page_id"] is not None)
    one = warc.read_captures(archive, spark.createDataFrame([("http://hot.example.org/",), ("http://nowhere/",), ("https://hot.example.org/",)], "url string"))
    assert one.count() == 300
    blocks = archive.index.agg({"blocks": "sum", "captures": "sum"}).first()
    assert blocks["sum(captures)"] == len(rows) and blocks["sum(blocks)"] >= len(rows) // 16


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    archive = warc.write_archive(df, "file://" + tempfile.mkdtemp())
    assert warc.read_captures(archive, df).collect() == []
