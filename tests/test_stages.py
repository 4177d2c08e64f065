"""Fitted preparation: saved, loaded, and applied to rows that were not there when it was fitted."""

from __future__ import annotations

import numpy as np
import pytest

from panelwright.operators import regression as g
from panelwright.operators import stages as s
from panelwright.plans import forecast
from panelwright.sources import sinks

SCHEMA = "GEO string, DGUID string, REF_DATE string, income double, rate double, total_house_land double"


@pytest.fixture(scope="module")
def panel(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i, geo in enumerate(["Ontario", "Quebec", "Alberta"]):
        for m in range(60):
            income = 100.0 + 3 * m + 10 * i
            rows.append((geo, f"id{i}", f"{2014 + m // 12}-{m % 12 + 1:02d}", None if m % 7 == 0 else income,
                         float(rng.uniform()), 0.5 * income + 5 * i + float(rng.normal()) * 0.1))
    return spark.createDataFrame(rows, SCHEMA)


def test_lines_survive_saving(spark, panel, tmp_path):
    train, unseen = panel.where("REF_DATE < '2017-01'"), panel.where("REF_DATE >= '2017-01'")
    stages = [s.MonthNumber(period="REF_DATE", name="x"), s.LineImputer(group="DGUID", x="x", columns=["income"])]
    model, filled = s.fitted_in_turn(stages, train)
    assert filled.where("income IS NULL").count() == 0
    sinks.save_model(model, str(tmp_path / "model"))
    again = s.load_pipeline(spark, str(tmp_path / "model"))
    new = spark.createDataFrame([("Elsewhere", "id9", "2019-01", None, 0.5, None)], SCHEMA)
    got = {(r["DGUID"], r["REF_DATE"]): r["income"] for r in again.transform(unseen.union(new)).collect()}
    assert got["id9", "2019-01"] == 0.0
    for i in range(3):
        known = [(int(r["REF_DATE"].replace("-", "")), r["income"]) for r in train.where(f"DGUID = 'id{i}' AND income IS NOT NULL").collect()]
        slope, intercept = np.polyfit(*map(np.array, zip(*known)), 1)
        for r in unseen.where(f"DGUID = 'id{i}'").collect():
            expected = r["income"] if r["income"] is not None else intercept + slope * int(r["REF_DATE"].replace("-", ""))
            assert got[f"id{i}", r["REF_DATE"]] == pytest.approx(expected, rel=1e-6)


def test_ranges_and_levels_are_those_of_the_training_rows(spark, tmp_path):
    schema = "g string, a double, constant double, none double"
    train = spark.createDataFrame([("x", 1.0, 4.0, None), ("y", 3.0, 4.0, None), (None, None, None, None)], schema)
    model, _ = s.fitted_in_turn([s.LevelEncoder(column="g", prefix="G"), s.RangeScaler(columns=["a", "constant", "none"])], train)
    sinks.save_model(model, str(tmp_path / "model"))
    new = spark.createDataFrame([("z", 5.0, 6.0, 1.0), ("x", None, 4.0, None)], schema)
    got = s.load_pipeline(spark, str(tmp_path / "model")).transform(new)
    assert got.columns == ["g", "a", "constant", "none", "G_x", "G_y"]
    assert list(map(tuple, got.collect())) == [("z", 2.0, 2.0, None, 0, 0), ("x", None, 0.0, None, 1, 0)]


def test_a_saved_forecast_scores_months_without_target(spark, panel, tmp_path):
    train = panel.where("REF_DATE < '2018-01'")
    model = forecast.fitted_pipeline(train, ["income", "rate"], k=4, degree=2)
    sinks.save_model(model, str(tmp_path / "model"))
    unseen = panel.where("REF_DATE >= '2018-01'")
    again = s.load_pipeline(spark, str(tmp_path / "model"))
    scored = g.predict(again, unseen.drop("total_house_land"))
    here = g.predict(model, unseen)
    both = scored.join(here.withColumnRenamed("prediction", "p"), ["DGUID", "REF_DATE"])
    assert both.count() == 36 and both.where("abs(prediction - p) > 1e-9").count() == 0
    errors = g.regression_errors(here, "total_house_land", "prediction").first()
    assert errors["mae"] < 5
