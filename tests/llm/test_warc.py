"""WARC archives: exact round trips, and damage that is noticed."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tierlake.llm.warc import read_archives, roundtrip, write_archives
from tierlake.llm.warc_format import Damaged, chunked, dechunked, page_records, payload_of, read_records
from tierlake.sources.staging import new_folder


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=400), st.integers(1, 50))
def test_chunks_round_trip(body, size):
    assert dechunked(chunked(body, size)) == body


@pytest.mark.parametrize("data", [b"", b"5\r\nabc", b"x\r\n", b"3\r\nabcd\r\n0\r\n\r\n", b"3\r\nabc\r\n"])
def test_bad_chunks(data):
    with pytest.raises(Damaged):
        dechunked(data)


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=900), st.integers(60, 400))
def test_segments_round_trip(payload, limit):
    archive = b"".join(r + b"\r\n\r\n" for r in page_records(7, "http://a/\r\nX: y", payload, None, limit))
    records = list(read_records(archive))
    assert payload_of(b"".join(block for _, block in records))[0] == payload
    assert [h.get("warc-segment-number") for h, _ in records] == ([None] if len(records) == 1 else [str(i + 1) for i in range(len(records))])
    with pytest.raises(Damaged):
        list(read_records(archive[:-5]))


PAGES = [
    (1, "http://a", "é\r\n\r\nWARC/1.1\r\n" * 4000), (2, "http://b", "same" * 400), (3, None, "same" * 400), (4, "http://c", "same" * 400),
    (5, "http://d", None), (6, "http://e", ""), (7, "http://f", "short"), (8, "http://g", "short"), (9, "http://h", "\U0001f600" * 20_001),
    (9, "http://h", "\U0001f600" * 20_001), (10, "http://i", "x" * 999), (11, "http://i", "x" * 999), (12, "z", "y" * 1000), (13, "z", "y" * 1000),
    (None, "n", "same" * 400), (None, "n", "nobody else has this " * 90), (None, "m", "nobody else has this " * 90),
]


def plain(pages):
    out = []
    for key, _, html in pages:
        body = (html or "").encode()
        known = [k for k, _, h in pages if h == html and k is not None]
        holder = max(known) if len(body) >= 1000 and known else None
        revisit = holder is not None and holder != key
        out.append((key, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", holder if revisit else None))
    return Counter(out)


@pytest.mark.parametrize("options", [{}, {"segment_bytes": 700, "records_per_file": 3, "filter_bits": 64}])
def test_pages_round_trip(spark, options):
    frame = spark.createDataFrame([(*p, "x", "y") for p in PAGES], "page_id long, url string, html string, payload string, digest string")
    found = roundtrip(frame.repartition(3), **options).collect()
    assert all(r["problem"] is None for r in found)
    assert Counter(tuple(r)[:5] for r in found) == plain(PAGES)


def test_payloads_come_back(spark):
    folder = new_folder(spark, "warc")
    write_archives(spark.createDataFrame(PAGES[:2], "page_id long, url string, html string"), folder, segment_bytes=900)
    found = {r["page_id"]: bytes(r["payload"]).decode() for r in read_archives(spark, folder).collect()}
    assert found == {k: h for k, _, h in PAGES[:2]}


def test_empty_table(spark):
    assert roundtrip(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_missing_segments_are_reported(spark, tmp_path):
    records = [*page_records(1, "u", b"a" * 900, None, 300), *page_records(2, "u", b"b" * 900, None, 300), *page_records(3, "u", b"fine", None)]
    records += page_records(4, "u", b"d" * 900, None, 300)
    drop = {1, 4, 6}  # one in the middle, a first one, a last one of the next
    sizes = [len(list(page_records(k, "u", c * 900, None, 300))) for k, c in ((1, b"a"), (2, b"b"), (4, b"d"))]
    assert sizes[0] == sizes[1] == sizes[2]
    n = sizes[0]
    drop = {1, n, 2 * n + 1 + n - 1}
    kept = [r for i, r in enumerate(records) if i not in drop]
    (tmp_path / "a.txt").write_bytes(b"".join(r + b"\r\n\r\n" for r in reversed(kept)))
    (tmp_path / "b.txt").write_bytes(b"not an archive")
    found = read_archives(spark, "file://{}".format(tmp_path)).collect()
    assert [(r["page_id"], bytes(r["payload"])) for r in found if r["problem"] is None] == [(3, b"fine")]
    assert len(found) == 5 and all(r["payload"] is None for r in found if r["problem"])
