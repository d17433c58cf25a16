import base64
import hashlib

import pytest

import __spark_entry__ as entry
from deposit_analytics.llm import warc
from deposit_analytics.sources import sinks

ROWS = [
    (5, "http://a.b.c/x y", "same\r\n\r\nthing"), (3, "http://a.b.c/x y", "same\r\n\r\nthing"), (7, None, None), (2, "weird", ""),
    (9, "http://ü.de/é", "é\n"), (None, "http://q.r/", "z"), (11, "http://A.b.c/x%20y", "other"), (-4, "https://u@a.b.c:8080?q#f", "p"),
    (5, "http://a.b.c/x y", "same\r\n\r\nthing"), (12, "http://l.m/", "long " * 50000), (13, "http://l.m/\r\nWARC-Type: x", "\r\n\r\nWARC/1.1\r\n"),
]


def plain(rows, least=0):
    first = {}
    for page_id, _, html in rows:
        if page_id is not None:
            first[html or ""] = min(first.get(html or "", page_id), page_id)
    out = []
    for page_id, _, html in rows:
        raw = (html or "").encode()
        revisit = page_id is not None and len(raw) >= least and page_id > first[html or ""]
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((page_id, len(raw), digest, "revisit" if revisit else "response", first[html or ""] if revisit else None))
    return sorted(out, key=str)


def run(spark, rows, **options):
    pages = spark.createDataFrame([(*row, 1, "x") for row in rows], "page_id long, url string, html string, first int, digest string")
    folder = sinks.work_folder(spark, "warc")
    warc.write(pages, folder, **options)
    index = warc.build_index(spark, folder)
    return pages, index, warc.read(warc.captures_of(index, pages))


def digest_rows(records):
    return sorted(
        ((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in records.collect()), key=str
    )


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(warc, "LINES", 2)
    pages, index, records = run(spark, ROWS)
    assert digest_rows(records) == plain(ROWS)
    payloads = {bytes(r.payload) for r in records.collect() if r.payload is not None}
    assert payloads == {(html or "").encode() for _, _, html in ROWS}
    urls = spark.createDataFrame([("http://a.b.c/x y",), ("http://nowhere/",), (None,)], "url string")
    assert sorted(str(r.page_id) for r in warc.captures_at(index, urls).collect()) == ["11", "3", "5", "5", "7"]


def test_small_payloads_are_all_responses(spark):
    _, _, records = run(spark, ROWS, least_bytes=5)
    assert digest_rows(records) == plain(ROWS, 5)


def test_empty_table(spark):
    _, index, records = run(spark, [])
    assert records.count() == 0
    assert index.count() == 0


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    assert digest_rows(entry.queries()["op9_capture_index"](spark, sf)) == plain(rows)


def test_keys():
    assert warc.url_key("http://www.Example.org/a?b#c") == "org,example,www)/a?b"
    assert warc.url_key("https://u:p@h.org:81") == "org,h:81)/"
    assert warc.url_key(None) == ""
    assert warc.capture_key("http://a/", -1) < warc.capture_key("http://a/", 0) < warc.capture_key("http://a/", 10)
