import gzip
import glob
import hashlib

import pytest
from pyspark.sql import functions as F

from haulmetrics.llm import warc
from haulmetrics.session import new_path

FAKE = ("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: urn:page:999\r\n"
        "Content-Length: 5\r\n\r\nhello\r\n\r\n")


def brute(rows):
    first = {}
    for key, _, html in rows:
        if key is not None:
            first[html or ""] = min(first.get(html or "", key), key)
    out = []
    for key, _, html in rows:
        body = (html or "").encode()
        least = first.get(html or "")
        again = len(body) >= 100 and key != least and least is not None
        out.append((key, len(body), hashlib.sha256(body).hexdigest(),
                    "revisit" if again else "response", least if again else None))
    return sorted(out, key=str)


PAGE = "<p>héllo</p>" * 20
ROWS = [(1, "http://a/", PAGE), (2, "http://b/", PAGE), (3, None, PAGE), (4, "http://c/", None),
        (5, "http://c/", ""), (6, "x\r\nContent-Length: 1\r\n", "short"), (7, "y", "short"),
        (8, "z", FAKE), (9, "z", FAKE * 3), (10, "z", FAKE * 3), (11, "z", "a\r\n\r\n" + FAKE + "b"),
        (12, "z", "WARC/1.1\r\n"), (13, "z", "WARC/1.1\r\n" * 9), (14, "z", "\r\n\r\n"),
        (15, "z", "é" * 200_000), (16, "z", "WARC/1.1\r\nContent-Length: 99999\r\n\r\n"),
        (17, "z", "x" * 99), (18, "z", "x" * 99), (19, "z", "x" * 100), (20, "z", "x" * 100),
        (20, "z", "x" * 100), (19, "z", "x" * 100), (None, "n", "x" * 100), (None, "n", "no key"),
        (21, "z", "Content-Length: 7\r\n\r\nx"), (22, "z", FAKE[:-4])]


@pytest.fixture
def pages(prepared):
    return lambda rows, n=2: prepared.createDataFrame(
        rows, "page_id long, url string, html string").repartition(n).withColumns(
        {c: F.lit("other") for c in ("head", "file", "content", "value", "digest")})


@pytest.mark.parametrize("parts", [1, 5])
def test_round_trip(pages, parts):
    found = warc.round_trip(pages(ROWS, parts))
    assert sorted(map(tuple, found.collect()), key=str) == brute(ROWS)


def test_text_keys(prepared):
    rows = [("a-1", "u", "x" * 100), ("a-2", "u", "x" * 100), ("b", "u", "y")]
    pages = prepared.createDataFrame(rows, "page_id string, url string, html string")
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.round_trip(pages).collect()}
    assert got == {"a-1": ("response", None), "a-2": ("revisit", "a-1"), "b": ("response", None)}


def test_payloads_and_headers(pages, prepared):
    path = new_path(prepared, "archives")
    warc.write_archives(pages(ROWS), path)
    found = warc.read_archives(prepared, path, payloads=True).collect()
    by_key = {key: html or "" for key, _, html in ROWS if key}
    for r in found:
        key = r.record_id and int(r.record_id.rsplit(":", 1)[1])
        if key and r.record_type == "response":
            assert bytes(r.payload).decode() == by_key[key]
    urls = {r.target_uri for r in found}
    assert None in urls and "x%0D%0AContent-Length: 1%0D%0A" in urls


def test_a_broken_record_ends_the_chain(prepared, tmp_path):
    def record(n, body, size=None):
        return (f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: urn:page:{n}\r\n"
                f"Content-Length: {len(body) if size is None else size}\r\n\r\n").encode() + body \
            + b"\r\n\r\n"
    for name, data in {
            "good": record(1, b"\xff\xfe binary \x00") + record(2, b"WARC/1.1\r\nx"),
            "broken": record(3, b"fine") + record(4, b"cut", 90) + record(5, b"lost"),
            "no_start": b"junk" + record(6, b"never reached"), "empty": b""}.items():
        with gzip.open(tmp_path / f"{name}.warc.gz", "wb") as f:
            f.write(data)
    found = warc.read_archives(prepared, f"file://{tmp_path}", payloads=True).collect()
    assert {r.record_id: bytes(r.payload) for r in found} == {
        "urn:page:1": b"\xff\xfe binary \x00", "urn:page:2": b"WARC/1.1\r\nx", "urn:page:3": b"fine"}


def test_files_are_archives(pages, prepared, tmp_path):
    warc.write_archives(pages(ROWS[:3], 1), f"file://{tmp_path}/out")
    data = b"".join(gzip.open(f).read() for f in glob.glob(f"{tmp_path}/out/part-*"))
    assert data.count(b"WARC/1.1\r\n") == 3 and data.endswith(b"\r\n\r\n")
    assert data.count(PAGE.encode()) == 1


def test_empty_table(pages):
    assert warc.round_trip(pages([])).collect() == []
