from __future__ import annotations

import gzip
import hashlib
import io
import re
import zlib

import pytest

from tallymart.llm import warc as W

BIG = "page é " * 300


def archive(*records):
    return b"".join(W.write_record(*r) for r in records)


def test_reader_frames_and_checks():
    data = archive((1, "http://a/ b\r\nX: y", b"x" * 200_000, None, False), (2, None, b"", None, False), (3, "u", b"zz", 1, True))
    got = list(W.read_records(io.BytesIO(data)))
    assert [r.headers["warc-type"] for r in got] == ["response", "response", "revisit"]
    assert [len(r.payload) for r in got] == [200_000, 0, 0] and got[2].http["content-length"] == "2"
    assert "x" not in got[0].headers
    assert list(W.read_records(io.BytesIO(b""))) == []


@pytest.mark.parametrize(
    "damage",
    [
        lambda m: m[:-9],
        lambda m: m[:-1],
        lambda m: b"plain text",
        lambda m: gzip.compress(zlib.decompress(m, 31).replace(b"payload!", b"payload?")),
        lambda m: gzip.compress(zlib.decompress(m, 31) + b"more"),
        lambda m: gzip.compress(zlib.decompress(m, 31)[:-6]),
        lambda m: gzip.compress(zlib.decompress(m, 31).replace(b"WARC/1.1", b"WRAC/1.1")),
        lambda m: gzip.compress(re.sub(rb"msgtype=response\r\nContent-Length: ", rb"\g<0>x", zlib.decompress(m, 31))),
    ],
)
def test_damage_is_found(damage):
    member = archive((1, "u", b"payload!", None, False))
    with pytest.raises(W.WarcError):
        list(W.read_records(io.BytesIO(archive((0, "u", b"a", None, False)) + damage(member))))


@pytest.fixture
def pages(spark):
    def make(*rows):
        return spark.createDataFrame(rows, "page_id long, url string, html string, refers_to string, path string")

    return make


def test_round_trip(pages):
    rows = [
        (1, "http://a/%41", BIG), (2, None, None), (3, "http://b/é", ""), (4, "u4", BIG), (9, "u9", BIG), (9, "u9", BIG),
        (None, "null", BIG), (5, "small", "same"), (6, "small", "same"), (7, "long", "x" * 3_000_000), (None, "n1", "y" * 2000), (None, "n2", "y" * 2000),
    ]
    frame = pages(*[(*r, "clash", "clash") for r in rows]).repartition(3)
    got = W.warc_round_trip(frame).collect()
    assert len(got) == len(rows)
    assert {(r.page_id, r.url) for r in got} == {r[:2] for r in rows}
    for r in got:
        html = next(x[2] for x in rows if x[:2] == (r.page_id, r.url)) or ""
        data = html.encode()
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
        revisit = html == BIG and r.page_id != 9
        assert (r.record_type, r.refers_to) == (("revisit", 9) if revisit else ("response", None))
        assert r.payload == (None if revisit else data)
    assert W.warc_round_trip(frame.limit(0)).collect() == []


def test_archives_are_cut_by_size(spark, pages, tmp_path):
    frame = pages(*[(i, "u", str(i) * 5000, None, None) for i in range(12)]).coalesce(1)
    manifest = W.write_archives(W.plan_revisits(frame), f"file://{tmp_path}/a", archive_bytes=100)
    assert manifest.count() == 12 and {r.records for r in manifest.collect()} == {1}
    assert W.read_archives(manifest).count() == 12
