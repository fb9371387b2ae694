import base64
from hashlib import sha1

import pytest

from zonewright.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, first string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


ROWS = [
    (3, "http://a/é?q=1&r=2", "<p>same</p>"),
    (1, "http://b/\r\nX-Evil: 1", "<p>same</p>"),
    (2, None, "<p>other\r\n\r\nWARC/1.1</p>"),
    (4, "u", None),
    (5, "u", ""),
    (None, "u", "<p>same</p>"),
    (6, "u", "long " * 100_000),
    (1, "again", "<p>same</p>"),
]


def test_round_trip(spark):
    index, records = warc.archive(pages(spark, ROWS))
    got = sorted(map(tuple, records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)
    first = {"<p>same</p>": 1, "": 4}
    want = []
    for page, _, html in ROWS:
        body = (html or "").encode()
        known = first.get(html or "", page)
        digest = base64.b32encode(sha1(body).digest()).decode()
        want.append((page, len(body), digest, "response" if page == known else "revisit", None if page == known else known))
    assert got == sorted(want, key=repr)
    assert index.count() == len(ROWS)
    assert records.schema["refers_to"].dataType.simpleString() == "bigint"


def test_every_record_is_found_by_its_index_entry(spark):
    index, _ = warc.archive(pages(spark, ROWS))
    for entry in index.collect():
        fields, block = warc.read_record(entry["bundle"], entry["frame"], entry["frame_offset"])
        assert fields["WARC-Record-ID"] == entry["record_id"]
        assert fields["WARC-Type"] == entry["record_type"]
        if entry["page_id"] == "2":
            assert block.endswith(b"WARC/1.1</p>")
        assert "X-Evil" not in fields


def test_frames_stand_alone_and_the_table_covers_the_file(spark, tmp_path):
    import zstandard

    rows = warc.with_responses(pages(spark, [(i, "u", f"<p>{i}</p>" * 50) for i in range(40)]))
    index = warc.write_bundles(rows.coalesce(1), str(tmp_path), frame_bytes=2000).collect()
    (bundle,) = {r["bundle"] for r in index}
    data = open(bundle.removeprefix("file://"), "rb").read()
    system, path = warc.open_fs(bundle)
    with system.open_input_file(path) as file:
        table = warc.seek_table(file)
    assert len(table) == len({r["frame"] for r in index}) > 1
    for start, packed, size in table:
        one = zstandard.ZstdDecompressor().decompress(data[start : start + packed], max_output_size=size)
        assert len(one) == size and one.startswith(b"WARC/1.1\r\n")
    # Any reader of the format sees the records one after another and passes over the table.
    whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert whole.count(b"WARC/1.1\r\n") == 40


def test_small_payloads_are_all_responses(spark):
    _, records = warc.archive(pages(spark, ROWS), min_bytes=5)
    assert {r["page_id"]: r["record_type"] for r in records.collect()}[5] == "response"


def test_no_pages(spark):
    index, records = warc.archive(pages(spark, []))
    assert index.count() == 0 and records.count() == 0


def test_a_damaged_payload_is_an_error():
    data = warc.render("1", "u", b"payload", None, warc.bare_digest(b"payload"))
    fields, block, end = warc.parse(data)
    assert end == len(data) and block.endswith(b"payload")
    with pytest.raises(ValueError):
        warc.parse(data, 1)
