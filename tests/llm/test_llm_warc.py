import base64
import gzip
import hashlib
import io

import pytest

from candela.llm import warc as W

SCHEMA = "page_id long, url string, html string, sha1 string, refers_to long, record string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 5, "y") for i, u, h in rows], SCHEMA)


ROWS = [
    (3, "http://a/", "<p>é</p>"), (1, "http://b/\n x", "<p>é</p>"), (2, None, ""), (7, "u", None), (5, "v", "z" * 200_000), (5, "v", "z" * 200_000),
    (6, "w", "\r\n\r\nContent-Length: 3\r\n\r\n"), (None, "n", "only"), (9, "q", "only"),
]


@pytest.mark.parametrize("archive_bytes,least", [(1 << 28, 0), (1, 0), (1 << 28, 5)])
def test_round_trip(spark, archive_bytes, least):
    want = []
    for i, _, h in ROWS:
        data = (h or "").encode()
        same = [j for j, _, g in ROWS if (g or "") == (h or "") and j is not None]
        first = min(same, default=None)
        revisit = len(data) >= least and first is not None and i != first
        want.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", first if revisit else None))
    got = W.warc_roundtrip(pages(spark, ROWS), revisit_from=least, archive_bytes=archive_bytes).drop("url").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_members_and_sidecar(spark, tmp_path):
    files = W.write_monolithic(W.deduplicated(pages(spark, ROWS)).coalesce(1), f"file://{tmp_path}/raw")
    index = W.normalise(files, f"file://{tmp_path}/members").orderBy("path", "offset").collect()
    path = index[0]["path"]
    data = open(path, "rb").read()
    records = [gzip.decompress(data[r["offset"] : r["offset"] + r["length"]]) for r in index]
    assert len(index) == len(ROWS) and all(r.startswith(b"WARC/1.1\r\n") for r in records)
    assert b"".join(records) == gzip.decompress(data) == gzip.decompress(open(files.first()["path"], "rb").read())
    side = open(path.removesuffix(".warc.gz") + ".idx").read().split("\n")[:-1]
    assert side == [f"{r['offset']} {r['length']} {r['record_id']}" for r in index]


def test_normaliser_reads_members_and_bounded_chunks(monkeypatch):
    monkeypatch.setattr(W, "CHUNK", 7)
    raw = [W.record(1, "u", b"abc", "D", None), W.record(2, None, b"", "E", 1)]
    for stream in (gzip.compress(b"".join(raw)), b"".join(map(gzip.compress, raw))):
        assert list(W.split_records(W.inflated(io.BytesIO(stream)))) == raw
    with pytest.raises(ValueError):
        list(W.split_records(iter([raw[0][:-3]])))


def test_empty_table(spark):
    assert W.warc_roundtrip(pages(spark, [])).count() == 0
