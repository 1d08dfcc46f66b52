"""Archives: round trips of awkward pages, revisits, foreign archives, and captures from links in any direction."""

import gzip

import pytest

from ebbline.llm import warc

SCHEMA = "page_id bigint, url string, html string, record_id string, payload string, type string"
BIG = "é" * 600  # 1200 bytes
TEXTS = [
    (1, "http://a.example/x?y=1", BIG),
    (2, "http://b.example/", BIG),
    (3, None, BIG),
    (4, "http://c.example/\r\nWARC-Type: response", "a" * 999),
    (5, "http://d.example", "a" * 999),
    (6, "", None),
    (7, "http://e.example/", ""),
    (8, "http://f.example/", "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n"),
    (9, "http://g.example/", "\u0000﻿ long " * 60_000),
    (9, "http://g.example/", "\u0000﻿ long " * 60_000),
]


@pytest.fixture(scope="module")
def captures(spark):
    pages = spark.createDataFrame([(*t, "clash", "clash", "clash") for t in TEXTS], SCHEMA).repartition(3)
    return warc.round_trip(pages)


def test_payloads_come_back(captures):
    rows = {r.page_id: r for r in warc.page_ids(captures).collect()}
    assert sorted(rows) == list(range(1, 10))
    assert {i: (r.record_type, r.refers_to) for i, r in rows.items() if r.record_type == "revisit"} == {1: ("revisit", 3), 2: ("revisit", 3)}
    assert {r.payload_bytes for i, r in rows.items() if i < 4} == {1200}
    read = {r.capture: bytes(r.response.payload).decode() for r in captures.collect()}
    for page, _, html in TEXTS[3:]:
        assert read[rows[page].capture] == (html or "")


def test_equal_rows_are_captures_of_their_own(spark, captures):
    assert captures.count() == len(TEXTS)
    rows = [(1, "u", BIG), (1, "u", BIG), (None, "u", BIG), (None, "u", BIG), (2, None, None), (2, None, None), (None, None, None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    for bodies in (True, False):
        back = warc.page_ids(warc.round_trip(pages, bodies)).select("page_id", "payload_bytes", "record_type", "refers_to").collect()
        assert sorted(map(str, back)) == sorted(
            f"Row(page_id={p}, payload_bytes={b}, record_type='{t}', refers_to={r})"
            for p, b, t, r in [(1, 1200, "response", None)] * 2 + [(None, 1200, "revisit", 1)] * 2 + [(2, 0, "response", None)] * 2 + [(None, 0, "response", None)]
        )


def test_nested_rows(captures):
    for r in captures.collect():
        assert len(r.requests) == len(r.metadata) == 1
        assert r.requests[0].target == r.response.target


def test_no_pages(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert warc.page_ids(warc.round_trip(none)).count() == 0


def record(kind, identity, body, *more):
    head = "\r\n".join(["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: {identity}", *more, f"Content-Length: {len(body)}"])
    return f"{head}\r\n\r\n{body}\r\n\r\n".encode()


def test_links_in_any_direction(spark, tmp_path):
    """A response that names its request, metadata that name the request, and an orphan; a gzip member a record."""
    parts = [
        record("warcinfo", "<i>", "software: x"),
        record("response", "<r>", "body", "WARC-Concurrent-To: <q>"),
        record("request", "<q>", "GET"),
        record("metadata", "<m>", "k: v", "WARC-Concurrent-To: <q>"),
        record("metadata", "<n>", "k: w", "WARC-Concurrent-To: <r>", "WARC-Concurrent-To: <q>"),
        record("metadata", "<o>", "lost", "WARC-Concurrent-To: <nowhere>"),
        record("resource", "<s>", "alone"),
    ]
    (tmp_path / "part-0.warc.gz").write_bytes(b"".join(map(gzip.compress, parts)))
    rows = {r.capture: r for r in warc.assemble(warc.read(spark, f"file://{tmp_path}")).collect()}
    assert set(rows) == {"<r>", "<s>"}
    assert [q.record_id for q in rows["<r>"].requests] == ["<q>"]
    assert [m.record_id for m in rows["<r>"].metadata] == ["<m>", "<n>"]
    assert rows["<s>"].requests is None


def test_cut_off_archive(spark, tmp_path):
    (tmp_path / "part-0.warc").write_bytes(record("response", "<r>", "body" * 100)[:-50])
    with pytest.raises(Exception, match="cut off"):
        warc.read(spark, f"file://{tmp_path}").collect()
