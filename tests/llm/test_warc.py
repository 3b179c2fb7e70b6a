import hashlib
import io

import pytest
import zstandard

from fieldpulse.llm import warc as W
from fieldpulse.llm._common import scratch_path

SCHEMA = "page_id long, url string, html string, digest string"


def pages():
    long, hard = "x" * 200 + "é", "WARC/1.1\r\n\r\nWARC-Type: response\r\n\r\n" * 5
    return [(3, "http://a/é b\r\nX: y", long, "c"), (1, "http://b", long, "c"), (9, None, long, "c"), (None, "http://n", long, "c"), (4, "http://s", "short", ""),
            (5, "http://s2", "short", ""), (6, "http://h", hard, ""), (7, "http://h", hard, ""), (8, "u", None, ""), (10, "u", "", ""),
            (11, "u", "z" * 99, ""), (12, "u", "z" * 99, ""), (13, "u", "y" * 100, ""), (14, "u", "y" * 100, ""), (None, "only", "n" * 150, ""), (20, "u", "big" * 400_000, "")]


def test_round_trip(spark):
    data = pages()
    folder = scratch_path(spark, "warc-test")
    index = W.write_archives(spark.createDataFrame(data, SCHEMA), folder, frame_bytes=500, bundle_bytes=3000)
    got = W.read_archives(index).collect()
    assert len(got) == len(data)
    first = {}
    for p, _, h, _ in data:
        h = (h or "").encode()
        if len(h) >= 100 and p is not None:
            first[h] = min(p, first.get(h, p))
    want = sorted(((p, (h or "").encode() if first.get((h or "").encode(), p) == p else None) for p, _, h, _ in data), key=str)
    assert sorted(((r["page_id"], None if r["payload"] is None else bytes(r["payload"])) for r in got), key=str) == want
    for r in got:
        if r["payload"] is not None:
            assert hashlib.sha256(r["payload"]).hexdigest() == r["digest"]
    by_id = {r["record_id"]: r for r in got}
    for r in got:
        if r["record_type"] == "revisit":
            assert by_id[r["refers_to_record"]]["record_type"] == "response" and by_id[r["refers_to_record"]]["digest"] == r["digest"]
    # the index leads to the record within its frame
    at = {(r["bundle"], r["frame"], r["at"]): r["record_id"] for r in got}
    rows = index.collect()
    assert all(at[(r["bundle"], r["frame"], r["at"])] == r["record_id"] for r in rows)
    assert len({r["bundle"] for r in rows}) > 1 and max(r["frame"] for r in rows) > 0
    one = W.fetch(index, [rows[0]["record_id"]]).collect()
    assert [r["record_id"] for r in one] == [rows[0]["record_id"]]


def test_bundle_is_plain_zstandard_and_seekable():
    out = io.BytesIO()
    w = W.BundleWriter(out)
    records = [b"r%d" % i * 50 for i in range(10)]
    places = []
    for i, r in enumerate(records):
        places.append(w.add(r))
        if i % 3 == 2:
            w.end_frame()
    w.close()
    out.seek(0)
    assert zstandard.ZstdDecompressor().stream_reader(out, read_across_frames=True).read() == b"".join(records)
    table = W.seek_table(out)
    for r, (frame, at) in zip(records, places):
        assert W.read_frame(out, *table[frame])[at:at + len(r)] == r


def test_damage_is_found(spark):
    with pytest.raises(ValueError):
        W.seek_table(io.BytesIO(b"no table at the end of this"))


def test_empty(spark):
    index = W.write_archives(spark.createDataFrame([], SCHEMA), scratch_path(spark, "warc-test"))
    assert index.collect() == [] and W.read_archives(index).collect() == []
