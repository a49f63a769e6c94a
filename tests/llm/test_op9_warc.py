import base64
import gzip
import hashlib
from pathlib import Path

import pytest

from leadlens.llm import op9_warc as W

PAGES = "page_id long, url string, html string"
ROWS = [(5, "http://a/", "same"), (2, "http://b/", "same"), (9, None, "same"), (3, "http://c/\r\nX: y", None), (4, "http://d/", ""),
        (6, "http://é/", "é\r\n\r\nWARC/1.1\r\n" * 50), (7, "u", "x" * 200_000), (8, "u", "x" * 200_000), (11, "u", "one")]


def folder(tmp_path):
    return f"file://{tmp_path}/a"


def check(got, rows):
    by = {}
    for i, _, t in rows:
        by.setdefault(t or "", []).append(i)
    assert len(got) == len(rows)
    for r in got:
        text = next(t or "" for i, _, t in rows if i == r.page_id)
        raw = text.encode()
        first = min(by[text])
        assert r.payload_bytes == len(raw)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(raw).digest()).decode()
        assert (r.record_type, r.refers_to) == (("response", None) if r.page_id == first else ("revisit", first))
        assert r.payload == (text if r.record_type == "response" else None)


@pytest.mark.parametrize("archive_bytes", [W.ARCHIVE_BYTES, 300])
def test_round_trip(spark, tmp_path, monkeypatch, archive_bytes):
    monkeypatch.setattr(W, "READ_BYTES", 700)
    pages = spark.createDataFrame([(*r, "x", 1) for r in ROWS], PAGES + ", key string, first_id int").repartition(2)
    index = W.write_archives(pages, folder(tmp_path), archive_bytes=archive_bytes)
    check(W.read_archives(index, folder(tmp_path)).collect(), ROWS)
    assert W.read_archives(index, folder(tmp_path), payloads=False).where("payload is not null").count() == 0
    # Any WARC reader finds the records one after the other.
    whole = b"".join(gzip.decompress(p.read_bytes()) for p in sorted(Path(tmp_path, "a").iterdir()))
    assert whole.count(b"WARC/1.1\r\nWARC-Type: ") == len(ROWS)
    urls = {r.page_id: r.url for r in index.collect()}
    assert urls == {i: u for i, u, _ in ROWS}
    some = W.read_archives(index.where("page_id in (2, 11)"), folder(tmp_path)).collect()
    assert sorted(r.page_id for r in some) == [2, 11]


def test_revisits_by_shuffle_short_payloads_and_null_ids(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "MAX_BROADCAST_REVISITS", 0)
    pages = spark.createDataFrame(ROWS + [(None, "n", "same"), (2, "http://b/", "same")], PAGES)
    got = W.read_archives(W.write_archives(pages, folder(tmp_path)), folder(tmp_path)).collect()
    same = sorted((str(r.page_id), r.record_type, r.refers_to) for r in got if r.payload_bytes == 4)
    assert same == [("2", "response", None), ("2", "response", None), ("5", "revisit", 2), ("9", "revisit", 2), ("None", "revisit", 2)]
    other = f"file://{tmp_path}/b"
    few = W.read_archives(W.write_archives(pages, other, least_bytes=5), other).where("payload_bytes < 5").collect()
    assert {r.record_type for r in few} == {"response"}


def test_damage_is_found_and_empty_table(spark, tmp_path):
    member, _ = W.record_bytes(1, "u", b"payload", None, "response")
    assert W.parse_record(member)["payload"] == "payload"
    with pytest.raises(ValueError, match="damaged"):
        W.parse_record(gzip.compress(gzip.decompress(member).replace(b"payload\r\n", b"paylaod\r\n")))
    index = W.write_archives(spark.createDataFrame([], PAGES), folder(tmp_path))
    assert W.read_archives(index, folder(tmp_path)).count() == 0


def test_archives_are_read_by_as_many_tasks_as_their_bytes_need(spark, tmp_path):
    import os
    pages = spark.createDataFrame([(i, "u", os.urandom(2000).hex()) for i in range(200)], PAGES).repartition(1)
    index = W.write_archives(pages, folder(tmp_path))
    total = sum(r.length for r in index.collect())
    got = W.read_archives(index, folder(tmp_path), payloads=False, stretch=total // 16)
    assert got.rdd.getNumPartitions() >= 16 and got.count() == 200
