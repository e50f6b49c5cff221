import gzip
import hashlib
import io

import pytest

from tests.conftest import SF001
from tidewater.llm import warc
from tidewater.llm.shared import new_folder, open_file


def expected(rows):
    first, out = {}, []
    for page, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        data = (html or "").encode()
        if len(data) >= 100 and page is not None:
            first.setdefault(data, page)
    for page, url, html in rows:
        data = (html or "").encode()
        refers = first.get(data) if len(data) >= 100 else None
        refers = None if refers == page else refers
        out.append((str(page), len(data), hashlib.sha256(data).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def got(df):
    return sorted(((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in df.collect()), key=str)


def test_pages(spark):
    pages = spark.read.parquet(f"{SF001}/pages.parquet")
    assert got(warc.archive(pages)) == expected([(r["page_id"], r["url"], r["html"]) for r in pages.collect()])


def test_edges(spark):
    big, long_ = "é" * 60, "<p>" + "long text " * 300_000
    rows = [(5, "u", big), (3, "u", big), (3, "u", big), (9, None, big), (7, "a b\r\nWARC-Type: x", "WARC/1.0\r\n\r\n\r\n"), (8, "u", None), (10, "u", ""), (None, "u", big),
            (None, "u", "only without a name" * 9), (11, "u", "x" * 99), (12, "u", "x" * 99), (13, "u", "x" * 100), (14, "u", "x" * 100), (15, "u", long_), (16, "u", long_), (17, "u", "\n\r\n \r\n\r\n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS payload_digest", "2 AS first", "3 AS refers_to")
    assert got(warc.archive(pages.repartition(3))) == expected(rows)
    assert warc.archive(pages.limit(0)).count() == 0


def test_members_stand_alone(spark):
    pages = spark.read.parquet(f"{SF001}/pages.parquet").coalesce(1)
    whole = warc.write_archives(warc.with_revisits(pages), new_folder(spark, "whole"))
    target = warc.normalise(whole, new_folder(spark, "members")).first()["file"]
    source = whole.first()["file"]
    with open_file(target) as f, open_file(source) as s:
        data, before = f.read(), s.read()
    entries = list(warc.entries(target))
    assert gzip.decompress(data) == gzip.decompress(before)  # the same records
    assert len(entries) > 1 and sum(e["length"] for e in entries) == len(data)
    for e in entries[:20]:
        record = gzip.decompress(data[e["offset"]:e["offset"] + e["length"]])
        assert record.startswith(b"WARC/1.0\r\n") and e["id"].encode() in record


def test_streams_of_many_members_and_broken_ones():
    parts = [warc.record({"page_id": i, "url": "u", "html": b"x" * (i * 90_000), "payload_bytes": i * 90_000, "payload_digest": "d", "refers_to": None}, "1970-01-01T00:00:00Z")
             for i in range(8)]
    for data in (gzip.compress(b"".join(parts)), b"".join(map(gzip.compress, parts))):
        found = [b"".join(body) for _, body in warc.split_records(warc.inflated(io.BytesIO(data)))]
        assert found == parts
    with pytest.raises(ValueError):
        for _, body in warc.split_records([parts[3][:-500]]):
            b"".join(body)
