"""Distinct counts out of stored sketches."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from panelwright.operators import sketches as s
from panelwright.operators.extremes import distinct_count
from panelwright.plans import workbook


@pytest.fixture(scope="module")
def panel(spark):
    rows = spark.range(60_000).select(
        F.concat(F.lit("201"), (F.col("id") % 3).cast("string"), F.lit("-0"), (F.col("id") % 7 + 1).cast("string")).alias("REF_DATE"),
        F.concat(F.lit("region "), F.col("id") % 4).alias("GEO"), F.concat(F.lit("unit "), F.col("id") % 2).alias("uom_houseindex"),
        F.when(F.col("id") % 11 != 0, F.pmod(F.col("id") * 7919, F.lit(20_011)) / 4).alias("total_house_land"),
    )
    return rows.union(spark.createDataFrame([("2010-01", "empty", "unit 0", None)], rows.schema))


def counts(df, groups):
    return {tuple(r[g] for g in groups): r["distinct_total_house_land"] for r in df.collect()}


@pytest.mark.parametrize("groups", [["year"], ["GEO"], ["uom_houseindex", "GEO"], ["year", "REF_DATE", "uom_houseindex", "GEO"]])
def test_monthly_sketches_merge_to_the_whole(spark, panel, tmp_path, groups):
    workbook.stored_sketches(panel).write.parquet(str(tmp_path / "sketches"))
    found = counts(workbook.sheet_of_sketches(spark.read.parquet(str(tmp_path / "sketches")), groups), groups)
    exact = counts(distinct_count(panel.withColumn("year", F.substring("REF_DATE", 1, 4).cast("int")), groups, ["total_house_land"]), groups)
    assert set(found) == set(exact)
    assert all(abs(found[k] - exact[k]) <= 0.05 * exact[k] for k in exact)
    # and the sketch of all rows says nearly the same
    direct = s.sketch_table(panel.withColumn("year", F.substring("REF_DATE", 1, 4).cast("int")), groups, ["total_house_land"])
    whole = counts(s.sketched_counts(direct, groups, ["total_house_land"]), groups)
    assert all(abs(found[k] - whole[k]) <= 0.02 * exact[k] for k in exact)


def test_sheets_of_a_year_and_of_regions(panel):
    sketches = workbook.stored_sketches(panel)
    one = workbook.sheet_of_sketches(sketches, year=2011, regions=["region 1", "empty"])
    assert {(r["year"], r["GEO"]) for r in one.collect()} == {(2011, "region 1")}
    none = counts(workbook.sheet_of_sketches(sketches, ["GEO"]), ["GEO"])
    assert none[("empty",)] == 0


def test_a_new_month_is_added_without_the_old_rows(spark, panel):
    later = spark.createDataFrame([("2012-08", "region 1", "unit 1", float(i)) for i in range(500)], panel.schema)
    both = workbook.stored_sketches(panel).unionByName(workbook.stored_sketches(later))
    found = counts(workbook.sheet_of_sketches(both, ["GEO"]), ["GEO"])
    exact = counts(distinct_count(panel.union(later), ["GEO"], ["total_house_land"]), ["GEO"])
    assert set(found) == set(exact) and all(abs(found[k] - exact[k]) <= 0.05 * exact[k] for k in exact)
    # values that were there before do not count again
    again = workbook.stored_sketches(panel).unionByName(workbook.stored_sketches(panel))
    once = counts(distinct_count(panel, ["GEO"], ["total_house_land"]), ["GEO"])
    found = counts(workbook.sheet_of_sketches(again, ["GEO"]), ["GEO"])
    assert all(abs(found[k] - once[k]) <= 0.05 * once[k] for k in once)
