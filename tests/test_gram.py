"""Regressions from added-up moments against regressions on the rows."""

from __future__ import annotations

import numpy as np
import pytest

from panelwright.operators import gram
from panelwright.operators import regression as g


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = rng.uniform(size=(600, 3))
    y = 3 + 2 * x[:, 0] - x[:, 1] + 0.5 * x[:, 0] * x[:, 2] + 0.1 * rng.normal(size=600)
    data = [(f"r{i % 4}" if i % 9 else None, 2010 + i % 6, *map(float, x[i]), float(y[i])) for i in range(600)]
    data += [("r0", 2010, None, 0.0, 0.0, 9.0), ("r1", 2012, 0.1, 0.1, 0.1, None), ("r1", None, 0.5, 0.5, 0.5, 1.0)]
    return spark.createDataFrame(data, "region string, year int, a double, b double, c double, y double").repartition(7)


@pytest.mark.parametrize("degree, alpha", [(1, 0.5), (2, 0.01), (3, 2.0)])
def test_every_cut_equals_a_regression_on_its_rows(spark, rows, degree, alpha):
    columns = ["a", "b", "c"]
    sums = gram.moments(rows, columns, "y", ["region", "year"], degree)
    models = gram.rolling_ridge(sums, "year", alpha)
    cuts = {r["cut"]: r["n"] for r in models.collect()}
    complete = rows.dropna(subset=[*columns, "y"])
    assert set(cuts) == {2010, 2011, 2012, 2013, 2014, 2015}
    # a row without a year is before every cut
    scored = gram.rolling_forecast(complete.where("year IS NOT NULL"), models, sums, "year")
    for cut in (2011, 2015):
        train = complete.where(f"year < {cut} OR year IS NULL")
        assert cuts[cut] == train.count()
        model = g.polynomial_ridge(train, columns, "y", alpha, degree)
        expected = {(r["a"], r["b"]): r["prediction"] for r in g.predict(model, complete.where(f"year = {cut}")).collect()}
        got = {(r["a"], r["b"]): r["prediction"] for r in scored.where(f"year = {cut}").collect()}
        assert set(got) == set(expected)
        assert all(got[k] == pytest.approx(expected[k], abs=1e-6) for k in got)


def test_moments_add_up(rows):
    columns, by = ["a", "c"], ["region"]
    whole = gram.moments(rows, columns, "y", by, 2)
    parts = gram.merged(gram.moments(rows.where("year < 2013"), columns, "y", by, 2),
                        gram.moments(rows.where("year >= 2013 OR year IS NULL"), columns, "y", by, 2))

    def cells(sums):
        return {(r["region"], r["cell"]): r["value"] for r in sums.table.collect()}

    a, b = cells(whole), cells(parts)
    assert set(a) == set(b) and all(a[k] == pytest.approx(b[k]) for k in a)
    assert len(a) == 5 * whole.width * (whole.width + 1) // 2
    with pytest.raises(ValueError):
        gram.merged(whole, gram.moments(rows, columns, "y", by, 1))


def test_moments_of_nothing_and_of_columns_that_depend_on_each_other(spark):
    none = spark.createDataFrame([], "year int, a double, y double")
    assert gram.rolling_ridge(gram.moments(none, ["a"], "y", ["year"]), "year", 1.0).count() == 0
    twice = spark.createDataFrame([(y, float(i), 2.0 * i, 3.0 * i) for y in (1, 2) for i in range(5)], "year int, a double, b double, y double")
    sums = gram.moments(twice, ["a", "b"], "y", ["year"])
    scored = gram.rolling_forecast(twice, gram.rolling_ridge(sums, "year", 0.0), sums, "year")
    assert all(r["prediction"] == (None if r["year"] == 1 else pytest.approx(r["y"])) for r in scored.collect())


def test_rows_are_not_shuffled(rows):
    plan = gram.moments(rows.coalesce(2), ["a"], "y", ["year"]).table._jdf.queryExecution().executedPlan().toString()
    last = plan.rindex("MapInArrow")
    # the only exchange above the rows is that of the summed cells
    assert plan[:last].count("Exchange hashpartitioning") == 1 and "partial_sum" in plan[:last]
