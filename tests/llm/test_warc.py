from __future__ import annotations

import hashlib
from pathlib import Path

import zstandard

from stateloom.llm.warc import as_records, read_records, resolve_revisits, write_bundles

PAGES = "page_id long, url string, html string, payload string, record_id string"


def pages(spark):
    big = "<p>ü" * 60
    rows = [(3, "http://a/", big), (1, "http://b/", big), (1, "http://b/", big), (7, None, big), (None, "http://n/", big), (2, "http://c/", None),
            (4, "http://d/", ""), (5, "http://e/\r\n", "short"), (6, "http://f/", "short"), (8, "http://g/", "x\r\n\r\ny" * 300_000)]
    return spark.createDataFrame([(*r, "p", "r") for r in rows], PAGES), rows


def test_round_trip_types_and_digests(spark, tmp_path):
    table, rows = pages(spark)
    folder, index = write_bundles(as_records(table), f"file://{tmp_path}/w", frame_bytes=1000, bundle_bytes=5000)
    assert index.count() == len(rows)
    read = read_records(spark, folder, index)
    by_payload = {r.payload_digest: bytes(r.payload) for r in read.filter("record_type = 'response'").collect()}
    out = resolve_revisits(read).collect()
    assert len(out) == len(rows)
    for r in out:
        html = next(h or "" for i, _, h in rows if i == r.page_id)
        assert r.payload_bytes == len(html.encode()) and r.payload_digest == hashlib.sha256(html.encode()).hexdigest()
        assert by_payload[r.payload_digest] == html.encode()
        again = html.startswith("<") and r.page_id != 1
        assert (r.record_type, r.refers_to) == (("revisit", 1) if again else ("response", None))


def test_bundles_are_plain_zstandard_and_records_are_found_alone(spark, tmp_path):
    table, rows = pages(spark)
    folder, index = write_bundles(as_records(table), f"file://{tmp_path}/w", frame_bytes=500)
    text = b"".join(zstandard.ZstdDecompressor().stream_reader(p.open("rb"), read_across_frames=True).read() for p in Path(tmp_path, "w").iterdir())
    assert text.count(b"WARC/1.1\r\n") == len(rows)
    one = index.filter("page_id = 8")
    found = read_records(spark, folder, one).collect()
    assert [r.page_id for r in found] == [8] and len(found[0].payload) == 6 * 300_000


def test_empty_table(spark, tmp_path):
    folder, index = write_bundles(as_records(pages(spark)[0].limit(0)), f"file://{tmp_path}/w")
    assert resolve_revisits(read_records(spark, folder, index)).count() == 0
