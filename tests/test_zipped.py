"""Zip archives as a data source."""

from __future__ import annotations

import zipfile

import pytest

from panelwright.session import settings, ship
from panelwright.sources import sinks, zipped


@pytest.fixture(scope="module")
def archives(spark, tmp_path_factory):
    ship(spark)
    folder = tmp_path_factory.mktemp("zips")
    (folder / "deep").mkdir()
    with zipfile.ZipFile(folder / "a.zip", "w") as archive:
        archive.writestr("one.csv", '﻿"REF_DATE","GEO","VALUE"\n2018-01,"Canada, all",1.5\n2018-02,"two\nlines",\n')
        archive.writestr("two.csv", "VALUE,REF_DATE\n7,2018-03\n")
        archive.writestr("notes.txt", "no rows")
    with zipfile.ZipFile(folder / "deep" / "b c.zip", "w") as archive:
        archive.writestr("three.csv", "GEO,REF_DATE,VALUE\n" + "".join(f"P{i % 3},2019-01,{i}\n" for i in range(1000)))
        archive.writestr("empty.csv", "GEO,REF_DATE\n")
    return str(folder)


def test_members_are_partitions_and_columns_are_found_by_name(spark, archives):
    rows = zipped.scan_archives(spark, archives, ["VALUE", "GEO", "nowhere"])
    assert rows.rdd.getNumPartitions() == 4
    found = [tuple(r) for r in rows.collect()]
    assert len(found) == 1003
    assert {("1.5", "Canada, all", None), (None, "two\nlines", None), ("7", None, None), ("999", "P0", None)} <= set(found)


def test_filters_run_in_the_task(spark, archives):
    with settings(spark, spark__sql__python__filterPushdown__enabled="true"):
        rows = zipped.scan_archives(spark, archives, ["GEO", "VALUE"])
        one = rows.where("GEO = 'P1'")
        assert one.count() == 333 and rows.where("GEO IN ('P1', 'P2') AND VALUE IS NOT NULL").count() == 666
        assert rows.where("GEO = 'P1' AND cast(VALUE AS int) < 10").count() == 3
        assert rows.where("VALUE IS NULL").count() == 1
        # nothing is left to filter above the scan
        assert "Filter (" not in one._jdf.queryExecution().executedPlan().toString()
    assert zipped.scan_archives(spark, archives, ["GEO"]).where("GEO = 'P1'").count() == 333


def test_blocks_of_a_member(spark, archives, tmp_path):
    """Rows of many blocks, among them a first one whose column has no value."""
    reader = zipped.ZippedCsvReader([], ".csv", ["a", "b"])
    with zipfile.ZipFile(tmp_path / "big.zip", "w") as archive:
        archive.writestr("t.csv", "a,b\n" + "".join(f"{i},\n" for i in range(500)) + "".join(f"{i},x\n" for i in range(500)))
    old, zipped.BLOCK_BYTES = zipped.BLOCK_BYTES, 256
    try:
        batches = list(reader.read(zipped.Member(f"file:{tmp_path}/big.zip", "t.csv")))
    finally:
        zipped.BLOCK_BYTES = old
    assert len(batches) > 10 and sum(b.num_rows for b in batches) == 1000
    assert sum(b.column("b").null_count for b in batches) == 500


def test_written_archives_are_scanned_back(spark, tmp_path):
    rows = spark.createDataFrame([(i, f'"q", {i}' if i % 2 else None) for i in range(100)], "n int, t string")
    sinks.write_zipped(rows.repartition(3), f"{tmp_path}/out")
    found = zipped.scan_archives(spark, f"{tmp_path}/out", ["n", "t"]).collect()
    assert sorted((int(r["n"]), r["t"]) for r in found) == sorted(map(tuple, rows.collect()))
    sinks.write_zipped(rows.where("n > 1000"), f"{tmp_path}/none")
    assert zipped.scan_archives(spark, f"{tmp_path}/none", ["n"]).count() == 0
