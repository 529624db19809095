"""WARC archives and the merged index of captures against plain sorting, on odd rows."""

import glob
import gzip
import hashlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskflow.llm import warc
from riskflow.llm.queries import capture_histories

SCHEMA = "page_id long, url string, html string, record_type string, digest string"
BIG = "<p>" + "all alike " * 20 + "</p>"


def odd_rows():
    rows = [(None, "http://a.org/", BIG), (None, None, BIG), (7, "http://a.org/", BIG), (7, "http://a.org/", BIG), (7, None, BIG), (9, "x", None), (9, "x", ""), (10, "", "é" * 49), (11, "", "é" * 50), (12, "", "é" * 50)]
    rows += [(20, "http://a.org/\r\n\r\nWARC/1.1", "\r\n\r\nWARC/1.1\r\n\r\n\0" * 30), (21, "http://[bad/", "\r\n" * 80), (22, "HTTPS://www.A.org:443/P?b=2&a=1#x", "long " * 60_000)]
    rows += [(-5, "http://twin.org/", BIG + "!")] * 5 + [(k, "http://hot.org/page", f"page {k % 3} " * 30) for k in range(100, 400)]
    return [(*r, "x", "y") for r in rows]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 50), max_size=9), max_size=12))
def test_loser_tree(sequences):
    assert list(warc.LoserTree([iter(sorted(s)) for s in sequences], lambda x: x)) == sorted(x for s in sequences for x in s)


@pytest.mark.parametrize("url, key", [
    ("http://www.Example.com/a/B?z=1&a=2#frag", "com,example)/a/b?a=2&z=1"), ("https://example.com:443", "com,example)/"), ("http://u:p@m.example.com:8080/x", "com,example,m:8080)/x"),
    (None, ""), ("no host", "no host"), ("http://[bad/", "http://[bad/"), ("http://x:port/", "http://x:port/"),
])
def test_url_key(url, key):
    assert warc.url_key(url) == key


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.binary(max_size=300), st.text(max_size=20), st.integers(-(2**60), 2**60), st.booleans()), max_size=6))
def test_records(items):
    archive, want = b"", []
    for k, (payload, url, at, revisit) in enumerate(items):
        row = {"page_id": k, "url": url, "captured_at": at, "digest": hashlib.sha256(payload).hexdigest(), "record_id": str(k), "refers_to_record": "0" if revisit else None}
        archive += warc.record(row, payload)
        want.append(("revisit" if revisit else "response", b"" if revisit else payload))
        assert archive[-1] == 0
    found = list(warc.records(archive))
    assert [(f["warc-type"], block.partition(b"\r\n\r\n")[2]) for _, _, f, block in found] == want
    assert b"".join(archive[a : a + n] for a, n, _, _ in found) == archive
    assert all(date == warc.warc_date(warc.date_micros(date)) for date in (f["warc-date"] for _, _, f, _ in found))


def test_large_and_broken_records():
    row = {"page_id": None, "url": None, "captured_at": 0, "digest": hashlib.sha256(bytes(1 << 25)).hexdigest(), "record_id": "0", "refers_to_record": None}
    data = warc.record(row, bytes(1 << 25))
    assert data[-1] == 0 and len(list(warc.members(data))) == 2
    (only,) = warc.run("a", data + b"")
    assert only["payload_bytes"] == 1 << 25 and only["length"] == len(data)
    for broken in (data[:-1], data[:-30], b"x" + data):
        with pytest.raises(Exception):
            warc.run("a", broken)
    with pytest.raises(ValueError):
        warc.run("a", warc.record(row, b"other"))


def brute(rows):
    """(page_id, bytes, digest, type, refers_to) of each row."""
    out, by = [], defaultdict(list)
    for page_id, url, html, *_ in rows:
        data = (html or "").encode()
        by[hashlib.sha256(data).hexdigest(), len(data)].append((page_id is None, page_id or 0, url is None, url or "", page_id))
    for (digest, n), own in by.items():
        for k, (*_, page_id) in enumerate(sorted(own, key=lambda r: r[:4])):
            revisit = n >= 100 and k > 0
            out.append((page_id, n, digest, "revisit" if revisit else "response", min(own, key=lambda r: r[:4])[-1] if revisit else None))
    return Counter(out)


def test_histories(spark, tmp_path):
    rows = odd_rows()
    pages = spark.createDataFrame(rows, SCHEMA).repartition(4)
    path = str(tmp_path / "warc")
    found = warc.archive_pages(pages, F.timestamp_seconds(F.col("page_id") % 40), path, archive_bytes=2000, range_rows=60).collect()
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in found) == brute(rows)
    # The index has the order of one sort, and numbers captures of a URL through all ranges.
    ordered = sorted(found, key=lambda r: (r["url_key"], r["captured_at"], r["page_id"] is not None, r["page_id"] or 0, r["archive"], r["start"]))
    seen = Counter()
    for k, r in enumerate(ordered):
        seen[r["url_key"]] += 1
        assert (r["position"], r["capture"]) == (k, seen[r["url_key"]])
    assert seen["org,hot)/page"] == 300 and len({r["record_id"] for r in found}) == len(rows)
    # Any reader of gzip can read the files, and the index leads to single records.
    files = glob.glob(f"{path}/archives/*/*.txt")
    assert len(files) > 8 and sum(gzip.open(f).read().count(b"WARC-Record-ID: ") for f in files) == len(rows)
    one = next(r for r in found if r["page_id"] == 20)
    with open(one["archive"].removeprefix("file:"), "rb") as f:
        f.seek(one["start"])
        assert rows[10][2].encode() in gzip.decompress(f.read(one["length"]))


def test_query(spark, tmp_path):
    rows = odd_rows()
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/pages.parquet")
    assert Counter(map(tuple, capture_histories(spark, str(tmp_path)).collect())) == brute(rows)


def test_no_pages(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/pages.parquet")
    assert capture_histories(spark, str(tmp_path)).collect() == []
