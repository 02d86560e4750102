"""WARC archives: round trips, revisits, and archives that must be refused."""

import hashlib
import io
import struct

import pytest
import zstandard

from revtide.llm import warc
from revtide.llm.queries import ORACLES, QUERIES
from revtide.session import work_folder
from tests.compare import connect, difference
from tests.llm.helpers import rows

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string, record_type string"


def test_query_equals_sql(spark):
    got = QUERIES["op10_warc"](spark, SF_DIR).toPandas()
    assert difference(got, connect(SF_DIR).execute(ORACLES["op10_warc"]).df()) is None


def test_round_trip_of_odd_pages(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    h, long = "x" * 200, "é" * 400_000
    data = [(1, None, None), (2, "u", ""), (7, "u\nv", h), (7, "u", h), (3, "http://é", h), (3, "http://é", h), (None, "z", h),
            (None, "z", "y" * 150), (None, "z2", "y" * 150), (9, "é", "short"), (10, "q", "short"), (11, "l", long), (12, "m", long)]
    pages = spark.createDataFrame([(*d, "clash") for d in data], SCHEMA)
    folder = work_folder(spark, "warc")
    archives = warc.write_archives(pages, folder, warc.train_dictionary(pages))
    assert archives.count() >= 1
    got = warc.read_archives(archives, folder).collect()
    kinds = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in got), key=repr)
    size = 2 * 400_000
    assert kinds == sorted([
        (1, "response", None, 0), (2, "response", None, 0), (3, "response", None, 200), (3, "revisit", 3, 200), (7, "revisit", 3, 200),
        (7, "revisit", 3, 200), (None, "revisit", 3, 200), (None, "response", None, 150), (None, "revisit", None, 150),
        (9, "response", None, 5), (10, "response", None, 5), (11, "response", None, size), (12, "revisit", 11, size)], key=repr)
    texts = {d[2] or "" for d in data}
    for r in got:
        if r.record_type == "response":
            assert r.payload.decode() in texts and r.payload_digest == hashlib.sha256(r.payload).hexdigest()
        else:
            assert r.payload is None
    assert rows(warc.round_trip(pages.limit(0))) == []


def archive(records, dictionary=b"", squeezed=False):
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    body = b"".join(zstandard.ZstdCompressor(dict_data=shared).compress(r) for r in records)
    front = zstandard.ZstdCompressor().compress(dictionary) if squeezed else dictionary
    head = struct.pack("<II", warc.DICTIONARY_FRAME, len(front)) + front if dictionary else b""
    return io.BytesIO(head + body)


def good(page, payload=b"p" * 120):
    return warc.record(page, "http://a/b", payload, hashlib.sha256(payload).hexdigest(), False, None)


def test_dictionary_in_the_leading_frame():
    samples = [good(i, (b"<html><body>page %d of many pages" % i) * 9) for i in range(300)]
    dictionary = zstandard.train_dictionary(4096, samples).as_bytes()
    for squeezed in (False, True):
        found = list(warc.records_of(archive(samples[:5], dictionary, squeezed)))
        assert [r["page_id"] for r in found] == [0, 1, 2, 3, 4]
    assert [r["page_id"] for r in warc.records_of(archive(samples[:2]))] == [0, 1]
    with pytest.raises(zstandard.ZstdError):  # the frames need their dictionary
        list(warc.records_of(io.BytesIO(archive(samples[:2], dictionary).read()[8 + len(dictionary):])))


@pytest.mark.parametrize("change", [
    lambda r: r.replace(b"WARC/1.1", b"WARC/0.9"), lambda r: r.replace(b"WARC-Date", b"WARC-When"),
    lambda r: r.replace(b"p" * 120, b"p" * 119), lambda r: r.replace(b"p" * 120, b"q" * 120),
    lambda r: r[:-2], lambda r: r + b"x", lambda r: r.replace(b"response\r\n", b"response\r\n", 1).replace(b"<urn:page", b"<urn:book"),
    lambda r: r.replace(b"Content-Length: 120", b"Content-Length: 121"), lambda r: r + r,
])
def test_wrong_records_are_refused(change):
    assert warc.parse(good(1))["payload"] == b"p" * 120
    with pytest.raises(ValueError):
        list(warc.records_of(archive([good(0), change(good(1))])))


def test_cut_archives_are_refused():
    data = archive([good(0), good(1)]).read()
    with pytest.raises(ValueError):
        list(warc.records_of(io.BytesIO(data[:-3])))
