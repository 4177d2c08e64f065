from __future__ import annotations

import gzip
import hashlib

import pytest

from panelwright.llm import warc
from panelwright.session import scratch_path, settings

BIG = "<p>" + "ä" * 120 + "</p>"


def through(spark, rows, extra=()):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", *extra)
    path = scratch_path(spark, "warc")
    warc.write_archives(pages, path)
    return path, warc.resolved(warc.read_archives(spark, path))


def test_round_trip(spark):
    tricky = "a\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n" + "x" * 100 + "\r\n\r\n"
    rows = [(3, "u3", BIG), (1, "u1", BIG), (2, "u\r\nEvil: 1", BIG), (4, None, None), (5, "u5", ""), (6, "u6", "short"), (7, "u7", "short"),
            (8, "u8", tricky), (9, "u9", tricky), (10, "u10", "y" * 3_000_000), (None, "n", BIG), (11, "q", "z" * 100), (12, "q", "z" * 100),
            (13, "q", "z" * 99), (14, "q", "z" * 99)]
    path, got = through(spark, rows, ["'x' AS digest", "1 AS bytes"])
    found = {r["page_id"]: r for r in got.collect()}
    assert len(found) == len(rows)
    refers = {3: 1, 2: 1, 9: 8, 12: 11}
    for page, _, html in rows:
        payload = (html or "").encode()
        r = found[page]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(payload), hashlib.sha256(payload).hexdigest())
        assert (r["record_type"], r["refers_to"]) == (("revisit", refers[page]) if page in refers else ("response", None))
    read = warc.read_archives(spark, path)
    assert {r["bytes"] for r in read.filter("record_type = 'revisit'").collect()} == {0}
    assert "Evil" not in "".join(read.filter("target LIKE 'u%Evil%'").select("target").first()["target"].splitlines()[1:])


def test_repeated_rows(spark):
    _, got = through(spark, [(1, "u", BIG), (1, "u", BIG), (2, "u", BIG), (2, "u", BIG)])
    assert sorted((r["page_id"], r["record_type"], r["refers_to"]) for r in got.collect()) == [
        (1, "response", None), (1, "response", None), (2, "revisit", 1), (2, "revisit", 1)]


def test_no_pages(spark):
    assert through(spark, [])[1].collect() == []


def test_missing_original_and_damage(spark):
    path, _ = through(spark, [(1, "u", BIG), (2, "u", BIG)])
    alone = warc.resolved(warc.read_archives(spark, path).filter("record_type = 'revisit'")).collect()
    assert [(r["page_id"], r["payload_bytes"], r["refers_to"]) for r in alone] == [(2, None, 1)]
    whole = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <x>\r\nContent-Length: 9\r\n\r\nA: b\r\n\r\nx\r\n\r\n"
    assert list(warc.parse_archive(gzip.compress(whole)))[0][1] == 1
    with pytest.raises(ValueError):
        list(warc.parse_archive(gzip.compress(whole[:-3])))
    with pytest.raises(ValueError):
        list(warc.parse_archive(gzip.compress(b"junk\r\n")))


def test_files_are_cut_by_bytes_and_read_as_streams(spark, monkeypatch):
    pages = spark.createDataFrame([(i, "u", f"{i:06d}" * 20_000) for i in range(40)], "page_id long, url string, html string").coalesce(1)
    found = {}
    for size in (warc.FILE_BYTES, 1_000_000):
        monkeypatch.setattr(warc, "FILE_BYTES", size)
        path = scratch_path(spark, "warc")
        with settings(spark, spark__sql__shuffle__partitions="1"):
            warc.write_archives(pages, path)
        read = warc.read_archives(spark, path)
        found[size] = sorted((r["record_id"], r["bytes"], r["digest"]) for r in read.collect())
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path").count()
        assert files == (1 if size > 1_000_000 else 5)
        assert "content" not in read._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]
    assert len(found[1_000_000]) == 40 and len({tuple(f) for f in found.values()}) == 1


def test_more_records_than_a_batch(spark):
    rows = [(i, "u", str(i)) for i in range(warc.BATCH + 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    path = scratch_path(spark, "warc")
    with settings(spark, spark__sql__shuffle__partitions="1"):
        warc.write_archives(pages, path)
    assert warc.resolved(warc.read_archives(spark, path)).select("page_id").distinct().count() == len(rows)
