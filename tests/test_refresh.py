"""A refreshed panel against one that is built anew, and which files a refresh writes."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from panelwright.operators import refresh as r
from panelwright.operators.panel import Feature, build_panel

HOUSING = "DGUID string, REF_DATE string, price double"
INCOME = "DGUID string, REF_DATE string, income double"


def build(tables):
    return build_panel(tables["housing"], [Feature(tables["income"], ["income"], grain="year", annual=["income"])])


def files(path):
    return {
        (folder[len(str(path)):], name, os.stat(os.path.join(folder, name)).st_mtime_ns)
        for folder, _, names in os.walk(path) for name in names if name.endswith(".parquet")
    }


def years_of(found):
    return {folder.split("=")[1] for folder, *_ in found}


@pytest.fixture
def tables(spark):
    months = [(g, f"{y}-{m:02d}", 100.0 * y + m) for g in "ab" for y in (2015, 2016, 2017) for m in range(1, 13)]
    incomes = [(g, str(y), 12.0 * y) for g in "ab" for y in (2015, 2016, 2017)]
    return months, incomes


def run(spark, path, months, incomes):
    sources = {"housing": spark.createDataFrame(months, HOUSING), "income": spark.createDataFrame(incomes, INCOME)}
    done = r.refresh_panel(path, sources, build)
    got = sorted(map(tuple, spark.read.parquet(path).drop("panel_year").collect()), key=repr)
    assert got == sorted(map(tuple, build(sources).collect()), key=repr)
    return done, {(c["DGUID"], c["REF_DATE"]): c["change"] for c in done.changes.collect()}


def test_only_changed_years_are_computed_and_written(spark, tmp_path, tables):
    months, incomes = tables
    path = str(tmp_path / "panel")
    done, changes = run(spark, path, months, incomes)
    assert done.written == ["2015", "2016", "2017"] and set(changes.values()) == {"new"} and len(changes) == 72
    first = files(path)

    # nothing new: nothing is computed
    done, changes = run(spark, path, months[::-1], incomes)
    assert (done.computed, done.written, changes) == ([], [], {}) and files(path) == first

    # a late month, a corrected one, a withdrawn one
    months = [*months, ("a", "2018-01", 1.0)]
    months = [(g, m, 7.0) if (g, m) == ("b", "2016-05") else (g, m, p) for g, m, p in months if (g, m) != ("a", "2016-09")]
    done, changes = run(spark, path, months, incomes)
    assert done.computed == done.written == ["2016", "2018"]
    assert changes == {("a", "2018-01"): "new", ("b", "2016-05"): "changed", ("a", "2016-09"): "removed"}
    second = files(path)
    assert years_of(second - first) == {"2016", "2018"} and {f for f in second if "2015" in f[0] or "2017" in f[0]} <= first

    # an annual amount reaches all months of its region and year
    incomes = [(g, y, v + 12.0) if (g, y) == ("a", "2017") else (g, y, v) for g, y, v in incomes]
    done, changes = run(spark, path, months, incomes)
    assert done.written == ["2017"] and set(changes) == {("a", f"2017-{m:02d}") for m in range(1, 13)}

    # a source that changes without a trace in the panel: computed, not written; a whole year that goes: deleted
    incomes = [*incomes, ("zz", "2015", 1.0)]
    months = [m for m in months if not m[1].startswith("2018")]
    done, changes = run(spark, path, months, incomes)
    assert done.computed == ["2015", "2018"] and done.written == ["2018"] and changes == {("a", "2018-01"): "removed"}
    assert "2018" not in years_of(files(path))


def test_a_refresh_that_broke_off_is_repeated(spark, tmp_path, tables):
    months, incomes = tables
    path = str(tmp_path / "panel")
    run(spark, path, months, incomes)
    later = [*months, ("b", "2018-03", 3.0)]

    def broken(_):
        raise RuntimeError("lost")

    sources = {"housing": spark.createDataFrame(later, HOUSING), "income": spark.createDataFrame(incomes, INCOME)}
    with pytest.raises(RuntimeError):
        r.refresh_panel(path, sources, broken)
    done, changes = run(spark, path, later, incomes)
    assert done.written == ["2018"] and changes == {("b", "2018-03"): "new"}


def test_digests_ignore_order_and_see_nulls_copies_and_noise(spark):
    def digest(rows):
        df = spark.createDataFrame(rows, "k string, a string, v double").repartition(3)
        return {d["k"]: (d["rows"], d["low"], d["high"]) for d in r.digests(df, {"k": F.col("k")}).collect()}

    base = [("x", None, 1.0), ("x", "p", None), (None, "q", 2.0)]
    assert digest(base) == digest(base[::-1]) == digest([("x", None, 1.0 + 1e-12), *base[1:]])
    assert digest(base)["x"] != digest([("x", "p", 1.0), ("x", None, None)])["x"]
    assert digest(base)["x"] != digest([*base, base[0]])["x"]
    assert digest([*base, base[0], base[0]])["x"] != digest(base)["x"]
    assert digest(base)[None] == digest(base[2:])[None]


def test_cut_sources_are_pruned_in_the_scan(spark, tmp_path, tables):
    spark.createDataFrame(tables[0], HOUSING).write.parquet(str(tmp_path / "housing"))
    df = spark.read.parquet(str(tmp_path / "housing")).where(r.in_years("REF_DATE", ["2016", "2018", "2017"]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(REF_DATE), GreaterThanOrEqual(REF_DATE,2016), LessThan(REF_DATE,2019)]" in plan
    assert df.count() == 48 and df.where(r.in_years("REF_DATE", [])).count() == 0
