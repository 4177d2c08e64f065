"""Encoding, imputing, scaling, splitting, look-back and regression over the nation x month spine."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions.dates import calendar_year, month_number, year_of
from panelwright.operators import features as f
from panelwright.operators import gram
from panelwright.operators import regression as g
from panelwright.operators import stages as s
from panelwright.plans import forecast
from panelwright.registry.support import SPINE, r, read, spine, tidy
from panelwright.session import landed, scratch_path
from panelwright.sources import sinks

CUT = "2000-01"


def _spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spine in the shared folder: the operators below read it more than once."""
    return landed(spine(spark, sf_dir))


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spine(spark, sf_dir).withColumn("month_number", month_number("REF_DATE"))


_DATED = f"""{SPINE}, dated AS (
  SELECT *, replace("REF_DATE", '-', '')::INTEGER AS month_number FROM spine)"""


def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = read(spark, sf_dir, "part").select("p_partkey", "p_type")
    return f.one_hot(parts, "p_type", "Type", TYPES)


def one_hot_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The position of each part's name among all names, as the sparse vector has it."""
    parts = read(spark, sf_dir, "part").select("p_partkey", "p_name")
    coded = f.sparse_parts(f.one_hot_vector(parts, "p_name", "hot"), "hot")
    return coded.select(
        "p_partkey", "p_name", F.col("size").alias("levels"), F.get("indices", F.lit(0)).cast("long").alias("position")
    )


_ONE_HOT_VECTOR = """SELECT p_partkey, p_name, (SELECT count(DISTINCT p_name) FROM part)::INTEGER AS levels,
  dense_rank() OVER (ORDER BY p_name) - 1 AS position FROM part"""


# The part types of the benchmark tables.
TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
_ONE_HOT = "SELECT p_partkey, p_type, " + ", ".join(
    f"(p_type = '{t}')::INTEGER AS \"Type_{t}\"" for t in TYPES
) + " FROM part"


def _with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feature with gaps, one without any value in nation 1 and with a single one in nation 2."""
    rows = _dated(spark, sf_dir)
    gap = F.col("REF_DATE").endswith("-03") | (F.col("DGUID") == 1)
    single = (F.col("DGUID") == 2) & (F.col("REF_DATE") != "1996-05")
    return rows.select("DGUID", "REF_DATE", "month_number", F.when(~gap & ~single, F.col("price")).alias("price"))


_GAPS = f"""{_DATED}, gaps AS (
  SELECT "DGUID", "REF_DATE", month_number, CASE WHEN NOT ("REF_DATE" LIKE '%-03' OR "DGUID" = 1)
    AND NOT ("DGUID" = 2 AND "REF_DATE" <> '1996-05') THEN price END AS price FROM dated)"""


def impute_regr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(f.impute_regression(_with_gaps(spark, sf_dir), "DGUID", "month_number", ["price"]), 2)


_IMPUTE = f"""WITH {_GAPS},
lines AS (SELECT "DGUID" AS k, regr_slope(price, month_number) AS b, regr_intercept(price, month_number) AS a,
  avg(price) AS m, regr_sxx(price, month_number) AS spread FROM gaps GROUP BY 1)
SELECT "DGUID", "REF_DATE", month_number,
  {r('coalesce(price, CASE WHEN spread > 0 THEN a + b * month_number END, m, 0)', 2)} AS price
FROM gaps JOIN lines ON "DGUID" = k"""


def min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _dated(spark, sf_dir).withColumn("constant", F.lit(3.0))
    return tidy(f.min_max(rows, ["price", "month_number", "constant"]), 6)


def _scaled(c: str) -> str:
    return f"({c} - (SELECT min({c}) FROM dated)) / (SELECT (max({c}) - min({c}))::DOUBLE FROM dated)"


_MIN_MAX = f"""WITH {_DATED} SELECT "GEO", "DGUID", "REF_DATE", {r(_scaled('price'), 6)} AS price,
  {r(_scaled('month_number'), 6)} AS month_number, 0.0::DOUBLE AS constant FROM dated"""


def time_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, valid = f.time_split(_spine(spark, sf_dir), "REF_DATE", CUT)
    return tidy(train.withColumn("part", F.lit("train")).unionByName(valid.withColumn("part", F.lit("valid"))))


_TIME_SPLIT = f"""WITH {SPINE} SELECT "GEO", "DGUID", "REF_DATE", {r('price')} AS price,
  CASE WHEN "REF_DATE" < '{CUT}' THEN 'train' ELSE 'valid' END AS part FROM spine"""

NUMBERS = ["l_quantity", "l_discount", "l_tax", "l_linenumber", "l_partkey", "l_suppkey"]


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select(*NUMBERS, "l_extendedprice")


def f_scores_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = g.best_features(_lines(spark, sf_dir), NUMBERS, "l_extendedprice", 3)
    return tidy(best.select("feature", "r", "f_score"))


_F_SCORES = f"""WITH s AS ({' UNION ALL '.join(
    f"SELECT '{c}' AS feature, {i} AS i, corr({c}, l_extendedprice) AS r, count(*) AS n FROM lineitem"
    for i, c in enumerate(NUMBERS))})
SELECT feature, {r('r')} AS r, {r('r * r / (1 - r * r) * (n - 2)')} AS f_score
FROM s ORDER BY r * r DESC, i DESC LIMIT 3"""


def look_back_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(f.lags(spine(spark, sf_dir), "DGUID", "REF_DATE", "price", 6))


_LAGS = f"""WITH {SPINE}, l AS (SELECT *, {', '.join(
    f'lag(price, {k}) OVER w AS lag{k}' for k in range(1, 7))}, row_number() OVER w AS n FROM spine
  WINDOW w AS (PARTITION BY "DGUID" ORDER BY "REF_DATE"))
SELECT "GEO", "DGUID", "REF_DATE", {r('price')} AS price,
  {', '.join(f"{r(f'lag{k}')} AS price_lag{k}" for k in range(1, 7))} FROM l WHERE n > 6"""


def _sequence(rows: DataFrame) -> DataFrame:
    values = F.transform("history", lambda s: F.concat(s["REF_DATE"], F.lit("="), s["cents"].cast("string")))
    return rows.select("DGUID", "REF_DATE", F.array_join(values, ";").alias("history"))


def _cents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(_spine(spark, sf_dir)).withColumn("cents", F.round(F.col("price")).cast("bigint"))


def look_back_seq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sequence(f.look_back(_cents(spark, sf_dir), "DGUID", "REF_DATE", ["REF_DATE", "cents"], 6))


def look_back_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through the path for groups of unbounded size, in chunks of 16 rows."""
    rows = f.look_back(
        _cents(spark, sf_dir), "DGUID", "REF_DATE", ["REF_DATE", "cents"], 6, bucket=year_of("REF_DATE"), chunk=16
    )
    return _sequence(rows)


_SEQ = f"""WITH {SPINE}, c AS (
  SELECT "DGUID", "REF_DATE", "REF_DATE" || '=' || round({r('price')})::BIGINT AS item FROM spine),
l AS (SELECT "DGUID", "REF_DATE", string_agg(item, ';') OVER f AS history, count(*) OVER f AS n FROM c
  WINDOW f AS (PARTITION BY "DGUID" ORDER BY "REF_DATE" ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING))
SELECT "DGUID", "REF_DATE", history FROM l WHERE n = 6"""


def _calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spine with the month counted from January 1995."""
    x = (calendar_year("REF_DATE") - 1995) * 12 + F.substring("REF_DATE", 6, 2).cast("int") - 1
    return _spine(spark, sf_dir).withColumn("x", x)


_ALPHA = 0.5


def _fitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _calendar(spark, sf_dir)
    train, _ = f.time_split(rows, "REF_DATE", CUT)
    return g.predict_line(g.simple_ridge(train, "x", "price", _ALPHA), rows, "x")


_FIT = f"""{SPINE}, t AS (
  SELECT *, (substr("REF_DATE", 1, 4)::INTEGER - 1995) * 12 + substr("REF_DATE", 6, 2)::INTEGER - 1 AS x FROM spine),
m AS (SELECT avg(x) AS mx, avg(price) AS my FROM t WHERE "REF_DATE" < '{CUT}'),
s AS (SELECT sum((x - mx) * (price - my)) AS sxy, sum((x - mx) * (x - mx)) AS sxx FROM t, m WHERE "REF_DATE" < '{CUT}'),
p AS (SELECT t.*, my + sxy / (sxx + {_ALPHA}) * (x - mx) AS prediction, "REF_DATE" < '{CUT}' AS is_train FROM t, m, s)"""


def ridge_uni(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(_fitted(spark, sf_dir), 2)


def forecast_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _fitted(spark, sf_dir).withColumn("is_train", F.col("REF_DATE") < CUT)
    return tidy(g.regression_errors(scored, "price", "prediction", ["is_train"]), 2)


def actual_vs_predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, valid = f.time_split(_fitted(spark, sf_dir), "REF_DATE", CUT)
    return tidy(g.actual_vs_predicted(valid, "DGUID", "REF_DATE", "price", "prediction"), 2)


def _plane(u: str, v: str, y: str, alpha: float, rows: str, where: str) -> str:
    """CTEs up to ``w``: the ridge plane of y on u and v over some rows, by Cramer's rule."""
    return f"""m AS (SELECT avg({u}) AS mu, avg({v}) AS mv, avg({y}) AS my FROM {rows} WHERE {where}),
s AS (SELECT sum(({u} - mu) * ({u} - mu)) + {alpha} AS uu, sum(({v} - mv) * ({v} - mv)) + {alpha} AS vv,
  sum(({u} - mu) * ({v} - mv)) AS uv, sum(({u} - mu) * ({y} - my)) AS uy, sum(({v} - mv) * ({y} - my)) AS vy
  FROM {rows}, m WHERE {where}),
w AS (SELECT mu, mv, my, (uy * vv - vy * uv) / (uu * vv - uv * uv) AS a, (vy * uu - uy * uv) / (uu * vv - uv * uv) AS b FROM m, s)"""


def ridge_square(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polynomial ridge of degree 2 on one feature, predictions of all rows."""
    rows = _calendar(spark, sf_dir).withColumn("x", F.col("x") / 10.0)
    train, _ = f.time_split(rows, "REF_DATE", CUT)
    model = g.polynomial_ridge(train, ["x"], "price", _ALPHA, degree=2)
    return tidy(g.predict(model, rows).select("DGUID", "REF_DATE", "prediction"), 2)


_RIDGE_SQUARE = f"""WITH {SPINE}, t AS (SELECT *, x * x AS z FROM (
  SELECT *, ((substr("REF_DATE", 1, 4)::INTEGER - 1995) * 12 + substr("REF_DATE", 6, 2)::INTEGER - 1) / 10.0::DOUBLE AS x FROM spine)),
{_plane('x', 'z', 'price', _ALPHA, 't', f""""REF_DATE" < '{CUT}'""")}
SELECT "DGUID", "REF_DATE", {r('my + a * (x - mu) + b * (z - mv)', 2)} AS prediction FROM t, w"""


def _lag_line(spark: SparkSession, sf_dir: str) -> forecast.Forecast:
    return forecast.look_back_forecast(
        _spine(spark, sf_dir), regions=None, target="price", cut=CUT, n=2, levels=[], bucket=year_of("REF_DATE")
    )


def lag_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Look-back forecast from the two previous values, joined to the panel."""
    found = forecast.with_predictions(_spine(spark, sf_dir), _lag_line(spark, sf_dir).predictions, "predicted_price")
    return tidy(found.select("DGUID", "REF_DATE", "predicted_price"), 2)


def lag_line_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(_lag_line(spark, sf_dir).errors, 2)


_LAG_FIT = f"""{SPINE}, l AS (SELECT * FROM (SELECT *, lag(price) OVER o AS u, lag(price, 2) OVER o AS v FROM spine
  WINDOW o AS (PARTITION BY "DGUID" ORDER BY "REF_DATE")) WHERE v IS NOT NULL),
{_plane('u', 'v', 'price', 0.0, 'l', f""""REF_DATE" < '{CUT}'""")},
p AS (SELECT *, my + a * (u - mu) + b * (v - mv) AS prediction, "REF_DATE" < '{CUT}' AS is_train FROM l, w)"""
_LAG_LINE = f"""WITH {_LAG_FIT} SELECT "DGUID", "REF_DATE", {r('prediction', 2)} AS predicted_price FROM p"""
_LAG_LINE_ERRORS = f"""WITH {_LAG_FIT} SELECT is_train, count(*) AS n, {r('avg(abs(price - prediction))', 2)} AS mae,
  {r('avg((price - prediction) * (price - prediction))', 2)} AS mse,
  {r('1 - avg((price - prediction) * (price - prediction)) / var_pop(price)', 2)} AS r2 FROM p GROUP BY is_train"""


def _model_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spine with two further features per nation and month, one of them with gaps, in the shared folder."""
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    monthly = (
        read(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_nationkey").alias("DGUID"), F.trunc("o_orderdate", "month").alias("month"))
        .agg(F.avg("o_totalprice").alias("price"), F.count(F.lit(1)).cast("double").alias("orders"),
             F.avg("c_acctbal").alias("balance"))
    )
    nations = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("DGUID"), F.col("n_name").alias("GEO"))
    panel = monthly.join(nations, "DGUID").withColumn("REF_DATE", F.date_format("month", "yyyy-MM")).drop("month")
    return landed(
        panel.withColumn("balance", F.when(~F.col("REF_DATE").endswith("-02"), F.col("balance")))
    )


def ridge_poly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best 4 features, degree 2, ridge; the predictions of all rows joined to the panel."""
    panel = _model_panel(spark, sf_dir)
    fit = forecast.ridge_forecast(
        panel, ["orders", "balance"], regions=None, target="price", cut=CUT, k=4, degree=2, alpha=0.01
    )
    return tidy(forecast.with_predictions(panel, fit.predictions, "predicted_price"), 2)


def ridge_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same path with the best 2 of 3 features and degree 1, small enough for a closed form."""
    panel = _model_panel(spark, sf_dir)
    fit = forecast.ridge_forecast(
        panel, ["orders", "balance"], regions=None, target="price", cut=CUT, k=2, degree=1, alpha=_ALPHA, levels=[]
    )
    found = forecast.with_predictions(panel, fit.predictions, "predicted_price")
    return tidy(found.select("DGUID", "REF_DATE", "predicted_price"), 2)


_RIDGE_BEST = f"""WITH raw AS (
  SELECT c_nationkey AS k, strftime(o_orderdate, '%Y-%m') AS ym, strftime(o_orderdate, '%Y%m')::INTEGER AS x,
         avg(o_totalprice) AS y, count(*)::DOUBLE AS n, CASE WHEN month(any_value(o_orderdate)) <> 2 THEN avg(c_acctbal) END AS balance
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3),
lines AS (
  SELECT k AS lk, avg(x) FILTER (WHERE balance IS NOT NULL) AS mx, avg(balance) AS mb,
         regr_sxy(balance, x) / nullif(regr_sxx(balance, x), 0) AS slope FROM raw GROUP BY k),
filled AS (
  SELECT raw.* EXCLUDE (balance), coalesce(balance, mb + slope * (x - mx), mb, 0) AS balance FROM raw LEFT JOIN lines ON k = lk),
scaled AS (
  SELECT k, ym, y, {', '.join(f"({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ())::DOUBLE AS f{i}" for i, c in enumerate(['n', 'balance', 'x']))}
  FROM filled),
worst AS (
  SELECT arg_min(i, r2) AS i FROM ({' UNION ALL '.join(
    f"SELECT {i} AS i, pow(corr(f{i}, y), 2) AS r2 FROM scaled WHERE ym < '{CUT}'" for i in range(3))})),
t AS (SELECT k, ym, y, CASE WHEN i = 0 THEN f1 ELSE f0 END AS p, CASE WHEN i = 2 THEN f1 ELSE f2 END AS q FROM scaled, worst),
{_plane('p', 'q', 'y', _ALPHA, 't', f"ym < '{CUT}'")}
SELECT k AS "DGUID", ym AS "REF_DATE", {r('my + a * (p - mu) + b * (q - mv)', 2)} AS predicted_price FROM t, w"""


def lag_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regression on the six previous values; the predictions joined to the panel."""
    panel = _spine(spark, sf_dir)
    fit = forecast.look_back_forecast(panel, regions=None, target="price", cut=CUT)
    return tidy(forecast.with_predictions(panel, fit.predictions, "predicted_price"), 2)


def lag_forecast_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(forecast.look_back_forecast(_spine(spark, sf_dir), regions=None, target="price", cut=CUT).errors, 2)


def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, ranges and ridge fitted before the cut, saved, loaded, and applied to the months from it on, gaps and all."""
    rows = _model_panel(spark, sf_dir)
    train, unseen = f.time_split(rows, "REF_DATE", CUT)
    stages = [
        s.MonthNumber(period="REF_DATE", name="month_number"),
        s.LineImputer(group="DGUID", x="month_number", columns=["balance"]),
    ]
    prepared, filled = s.fitted_in_turn(stages, train)
    scaled, ready = s.fitted_in_turn([s.RangeScaler(columns=["balance", "orders"])], landed(filled, "filled"))
    ridge = g.polynomial_ridge(ready, ["balance", "orders"], "price", _ALPHA)
    path = scratch_path(spark, "model")
    sinks.save_model(PipelineModel([*prepared.stages, *scaled.stages, *ridge.stages]), path)
    scored = g.predict(s.load_pipeline(spark, path), unseen.drop("price"))
    return tidy(scored.select("DGUID", "REF_DATE", "balance", "orders", "prediction"), 2)


_MODEL_ROUNDTRIP = f"""WITH raw AS (
  SELECT c_nationkey AS k, strftime(o_orderdate, '%Y-%m') AS ym, strftime(o_orderdate, '%Y%m')::INTEGER AS x,
         avg(o_totalprice) AS y, count(*)::DOUBLE AS v, CASE WHEN month(any_value(o_orderdate)) <> 2 THEN avg(c_acctbal) END AS balance
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3),
lines AS (
  SELECT k AS lk, avg(x) FILTER (WHERE balance IS NOT NULL) AS mx, avg(balance) AS mb,
         regr_sxy(balance, x) / nullif(regr_sxx(balance, x), 0) AS slope FROM raw WHERE ym < '{CUT}' GROUP BY k),
filled AS (
  SELECT raw.* EXCLUDE (balance), coalesce(balance, mb + slope * (x - mx), mb, 0) AS balance FROM raw LEFT JOIN lines ON k = lk),
ranges AS (
  SELECT min(balance) AS bl, max(balance) - min(balance) AS bw, min(v) AS vl, max(v) - min(v) AS vw FROM filled WHERE ym < '{CUT}'),
t AS (
  SELECT k, ym, y, (balance - bl) / CASE WHEN bw = 0 THEN 1 ELSE bw END AS b, (v - vl) / CASE WHEN vw = 0 THEN 1 ELSE vw END AS v
  FROM filled, ranges),
{_plane('b', 'v', 'y', _ALPHA, 't', f"ym < '{CUT}'").replace('AS b FROM m, s', 'AS beta FROM m, s')}
SELECT k AS "DGUID", ym AS "REF_DATE", {r('t.b', 2)} AS balance, {r('v', 2)} AS orders,
  {r('my + a * (t.b - mu) + beta * (v - mv)', 2)} AS prediction FROM t, w WHERE ym >= '{CUT}'"""


_ROLLING = ["x", "orders"]


def ridge_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of each year's forecast from all years before it, every cut solved from one table of moments."""
    x = ((calendar_year("REF_DATE") - 1995) * 12 + F.substring("REF_DATE", 6, 2).cast("int") - 1) / 10.0
    rows = _model_panel(spark, sf_dir).withColumns({"x": x, "year": calendar_year("REF_DATE")})
    sums = gram.moments(rows, _ROLLING, "price", ["DGUID", "year"])
    models = landed(gram.rolling_ridge(sums, "year", _ALPHA), "models")
    scored = gram.rolling_forecast(rows, models, sums, "year").where("prediction IS NOT NULL")
    errors = g.regression_errors(scored, "price", "prediction", ["year"]).select(
        F.col("year").alias("cut"), F.col("n").alias("n_valid"), "mae"
    )
    return tidy(errors.join(models.select("cut", F.col("n").alias("n_train")), "cut"), 2)


_RIDGE_ROLLING = f"""WITH t AS (
  SELECT year(o_orderdate) AS yr, ((year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1) / 10.0::DOUBLE AS u,
         count(*)::DOUBLE AS v, avg(o_totalprice) AS y
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey, year(o_orderdate), month(o_orderdate)),
c AS (SELECT DISTINCT yr AS cut FROM t WHERE yr > (SELECT min(yr) FROM t)),
m AS (SELECT cut, count(*) AS n_train, avg(u) AS mu, avg(v) AS mv, avg(y) AS my FROM c JOIN t ON yr < cut GROUP BY cut),
s AS (SELECT cut, n_train, mu, mv, my, sum((u - mu) * (u - mu)) + {_ALPHA} AS uu, sum((v - mv) * (v - mv)) + {_ALPHA} AS vv,
  sum((u - mu) * (v - mv)) AS uv, sum((u - mu) * (y - my)) AS uy, sum((v - mv) * (y - my)) AS vy
  FROM m JOIN t ON yr < cut GROUP BY ALL),
w AS (SELECT *, (uy * vv - vy * uv) / (uu * vv - uv * uv) AS a, (vy * uu - uy * uv) / (uu * vv - uv * uv) AS b FROM s)
SELECT cut::INTEGER AS cut, n_train, count(*) AS n_valid, {r('avg(abs(y - my - a * (u - mu) - b * (v - mv)))', 2)} AS mae
FROM w JOIN t ON yr = cut GROUP BY cut, n_train"""


QUERIES = {
    "one_hot": (one_hot, _ONE_HOT),
    "one_hot_vector": (one_hot_vector, _ONE_HOT_VECTOR),
    "impute_regr": (impute_regr, _IMPUTE),
    "min_max": (min_max, _MIN_MAX),
    "time_split": (time_split, _TIME_SPLIT),
    "f_scores_topk": (f_scores_topk, _F_SCORES),
    "look_back_lags": (look_back_lags, _LAGS),
    "look_back_seq": (look_back_seq, _SEQ),
    "look_back_chunks": (look_back_chunks, _SEQ),
    "ridge_uni": (
        ridge_uni,
        f'WITH {_FIT} SELECT "GEO", "DGUID", "REF_DATE", {r("price", 2)} AS price, x, {r("prediction", 2)} AS prediction FROM p',
    ),
    "forecast_errors": (
        forecast_errors,
        f"""WITH {_FIT} SELECT is_train, count(*) AS n, {r('avg(abs(price - prediction))', 2)} AS mae,
  {r('avg((price - prediction) * (price - prediction))', 2)} AS mse,
  {r('1 - avg((price - prediction) * (price - prediction)) / var_pop(price)', 2)} AS r2 FROM p GROUP BY is_train""",
    ),
    "actual_vs_predicted": (
        actual_vs_predicted,
        f"""WITH {_FIT} SELECT "DGUID", "REF_DATE", {r('price', 2)} AS actual, {r('prediction', 2)} AS predicted
FROM p WHERE NOT is_train ORDER BY 1, 2""",
    ),
    "ridge_square": (ridge_square, _RIDGE_SQUARE),
    "lag_line": (lag_line, _LAG_LINE),
    "lag_line_errors": (lag_line_errors, _LAG_LINE_ERRORS),
    "model_roundtrip": (model_roundtrip, _MODEL_ROUNDTRIP),
    "ridge_rolling": (ridge_rolling, _RIDGE_ROLLING),
    "ridge_poly": (ridge_poly, None),
    "ridge_best": (ridge_best, _RIDGE_BEST),
    "lag_forecast": (lag_forecast, None),
    "lag_forecast_errors": (lag_forecast_errors, None),
}
