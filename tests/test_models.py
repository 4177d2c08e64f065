from __future__ import annotations

import numpy as np
import pytest

from panelwright.operators import regression as g
from panelwright.plans import forecast
from panelwright.sources import sinks


def _closed_form(x, y, alpha):
    """Ridge with an unpenalised intercept."""
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
    return w, y.mean() - x.mean(0) @ w


def _expanded(x, degree):
    """All monomials of degree 1 to ``degree``, order as it comes."""
    from itertools import combinations_with_replacement

    return np.column_stack([
        x[:, list(c)].prod(1) for k in range(1, degree + 1) for c in combinations_with_replacement(range(x.shape[1]), k)
    ])


@pytest.fixture(scope="module")
def design():
    rng = np.random.default_rng(7)
    x = rng.uniform(size=(200, 3))
    y = 3 + 2 * x[:, 0] - x[:, 1] + 0.5 * x[:, 0] * x[:, 2] + 0.1 * rng.normal(size=200)
    return x, y


@pytest.mark.parametrize("alpha, degree", [(50.0, 1), (0.01, 1), (0.01, 3)])
def test_ridge_equals_closed_form(spark, design, alpha, degree):
    x, y = design
    rows = [(*map(float, r), float(t)) for r, t in zip(x, y)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double")
    model = g.polynomial_ridge(df, ["a", "b", "c"], "y", alpha, degree)
    got = np.array([r["prediction"] for r in g.predict(model, df).collect()])
    e = _expanded(x, degree)
    w, b = _closed_form(e, y, alpha)
    assert np.allclose(got, e @ w + b, atol=1e-6)


def test_simple_ridge(spark, design):
    x, y = design
    df = spark.createDataFrame([(float(a), float(t)) for a, t in zip(x[:, 0], y)], "x double, y double")
    line = g.simple_ridge(df, "x", "y", 5.0)
    w, b = _closed_form(x[:, :1], y, 5.0)
    row = line.first()
    assert row["slope"] == pytest.approx(w[0]) and row["intercept"] == pytest.approx(b)
    assert g.predict_line(line, df, "x").where("prediction IS NULL").count() == 0


def test_f_scores(spark, design):
    x, y = design
    rows = [(*map(float, r), 1.0, 2 * float(t), float(t)) for r, t in zip(x, y)]
    df = spark.createDataFrame(rows, "a double, b double, c double, constant double, twice double, y double")
    scores = {r["feature"]: r["f_score"] for r in g.f_scores(df, ["a", "b", "c", "constant", "twice"], "y").collect()}
    for i, name in enumerate("abc"):
        r2 = np.corrcoef(x[:, i], y)[0, 1] ** 2
        assert scores[name] == pytest.approx(r2 / (1 - r2) * 198)
    assert scores["constant"] == 0.0 and scores["twice"] > 1e12
    best = g.best_features(df, ["a", "b", "c", "constant", "twice"], "y", 2).collect()
    assert [r["feature"] for r in best] == ["twice", "a"]


def test_errors(spark):
    df = spark.createDataFrame([(1.0, 1.5, "t"), (3.0, 2.0, "t"), (5.0, 5.0, "v"), (6.0, None, "v")], "y double, p double, part string")
    row = g.regression_errors(df.where("part = 't'"), "y", "p").first()
    assert (row["n"], row["mae"], row["mse"]) == (2, 0.75, 0.625) and row["r2"] == pytest.approx(1 - 0.625)
    per = {r["part"]: r["n"] for r in g.regression_errors(df, "y", "p", ["part"]).collect()}
    assert per == {"t": 2, "v": 1}


def _panel(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i, geo in enumerate(["Ontario", "Quebec", "Alberta"]):
        for m in range(60):
            month = f"{2014 + m // 12}-{m % 12 + 1:02d}"
            income = 100.0 + 3 * m + 10 * i
            rows.append((geo, f"id{i}", month, None if m % 7 == 0 else income, 0.5 * income + 5 * i + float(rng.normal()) * 0.1))
    rows.append(("Ontario", "id0", "2019-01", 1.0, None))
    rows.append(("Elsewhere", "id9", "2018-01", 1.0, 1.0))
    return spark.createDataFrame(rows, "GEO string, DGUID string, REF_DATE string, income double, total_house_land double")


def test_ridge_forecast(spark, tmp_path):
    panel = _panel(spark)
    fit = forecast.ridge_forecast(panel, ["income"], regions=["id0", "id1", "id2"], k=3, degree=2)
    assert fit.predictions.count() == 180
    errors = {r["is_train"]: r for r in fit.errors.collect()}
    assert errors[True]["n"] == 144 and errors[True]["r2"] > 0.9 and errors[False]["n"] == 36
    sinks.save_model(fit.model, str(tmp_path / "model"))
    again = g.predict(sinks.load_model(str(tmp_path / "model")), fit.rows)
    assert again.join(fit.predictions.withColumnRenamed("prediction", "p2"), ["DGUID", "REF_DATE"]).where(
        "abs(prediction - p2) > 1e-9").count() == 0
    joined = forecast.with_predictions(panel, fit.predictions, "predicted_total_house_index")
    sinks.write_predictions(joined, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 180
    fit.rows.unpersist()


def test_look_back_forecast(spark):
    panel = _panel(spark)
    fit = forecast.look_back_forecast(panel, regions=["id0", "id1", "id2"])
    # the same by least squares over plain arrays
    series = {}
    for r in panel.where("DGUID <> 'id9' AND total_house_land IS NOT NULL").orderBy("DGUID", "REF_DATE").collect():
        series.setdefault(r["DGUID"], []).append((r["REF_DATE"], r["total_house_land"]))
    samples = [(g, s[i][0], [v for _, v in s[i - 6:i]], s[i][1]) for g, s in series.items() for i in range(6, len(s))]
    x = np.array([[*lags, *(float(g == h) for h in series)] for g, _, lags, _ in samples])
    y = np.array([t for *_, t in samples])
    train = np.array([month < "2018-01" for _, month, _, _ in samples])
    w, *_ = np.linalg.lstsq(x[train], y[train], rcond=None)
    got = {(r["DGUID"], r["REF_DATE"]): r["prediction"] for r in fit.predictions.collect()}
    assert np.allclose([got[g, m] for g, m, _, _ in samples], x @ w, atol=1e-4)
    assert fit.predictions.count() == 3 * (60 - 6)
    errors = {r["is_train"]: r for r in fit.errors.collect()}
    assert errors[False]["mae"] < 3
    fit.rows.unpersist()


def test_trees_follow_a_step_where_a_line_fails(spark, tmp_path):
    # the next value is low after a high one and high after two low ones
    rows = []
    for i in range(3):
        series = [1.0, 1.0]
        while len(series) < 60:
            series.append(9.0 if series[-1] < 5 and series[-2] < 5 else 1.0)
        rows += [(f"P{i}", f"id{i}", f"{2014 + m // 12}-{m % 12 + 1:02d}", v) for m, v in enumerate(series)]
    panel = spark.createDataFrame(rows, "GEO string, DGUID string, REF_DATE string, total_house_land double")
    # two previous values make it a line again, one does not
    trees = forecast.look_back_trees(panel, regions=None, n=3, trees=5)
    off = {r["is_train"]: r["mae"] for r in trees.errors.collect()}
    line = {r["is_train"]: r["mae"] for r in forecast.look_back_forecast(panel, regions=None, n=1, levels=["P0"]).errors.collect()}
    assert off[False] < 0.1 < 1 < line[False]
    sinks.save_model(trees.model, str(tmp_path / "trees"))
    again = g.predict(sinks.load_model(str(tmp_path / "trees")), trees.rows)
    assert again.join(trees.predictions.withColumnRenamed("prediction", "p"), ["DGUID", "REF_DATE"]).where("prediction <> p").count() == 0
