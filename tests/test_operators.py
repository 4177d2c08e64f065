from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from panelwright.operators import extremes as x
from panelwright.operators import features as f
from panelwright.operators import lookups
from panelwright.operators.panel import Feature, build_panel
from panelwright.operators.reshape import pivot_mean


def test_pivot_drops_null_keys_and_empty_groups(spark):
    long = spark.createDataFrame(
        [("2018-01", "A", "b", 1.0), ("2018-01", "A", "b", 3.0), ("2018-01", "A", "a", 5.0), ("2018-01", None, "a", 1.0),
         ("2018-01", "B", "a", None), ("2018-01", "C", "other", 2.0), ("2018-02", "A", "b", 4.0)],
        "REF_DATE string, GEO string, kind string, VALUE double",
    )
    # the names are not in the order of the categories
    out = pivot_mean(long, ["REF_DATE", "GEO"], "kind", {"b": "alpha", "a": "beta"})
    assert sorted(map(tuple, out.collect())) == [("2018-01", "A", 2.0, 5.0), ("2018-02", "A", 4.0, None)]


def _spine(spark):
    return spark.createDataFrame(
        [("A", "1", "2018-01"), ("A", "1", "2018-02"), ("B", "2", "2018-01"), ("C", None, "2018-01")],
        "GEO string, DGUID string, REF_DATE string",
    )


def test_panel_joins_every_grain(spark):
    yearly = spark.createDataFrame([("1", "2018", 24.0, "$"), ("1", "2017", 99.0, "$"), (None, "2018", 1.0, "$")],
                                   "DGUID string, REF_DATE string, income double, unit string")
    monthly = spark.createDataFrame([("2", "2018-01", 7.0)], "DGUID string, REF_DATE string, work double")
    national = spark.createDataFrame([("2018-01", 1.0), ("2018-01", 3.0), ("header", 9.0)], "REF_DATE string, cpi double")
    panel = build_panel(_spine(spark), [
        Feature(yearly, ["unit", "income"], grain="year", annual=["income"]),
        Feature(national, ["cpi"], by="national", duplicates="mean"),
        Feature(monthly, ["work"], tags={"uom_work": "Persons"}),
    ])
    assert panel.columns == ["GEO", "DGUID", "REF_DATE", "unit", "income", "cpi", "uom_work", "work"]
    assert sorted(map(str, (tuple(r) for r in panel.collect()))) == sorted(map(str, [
        ("A", "1", "2018-01", "$", 2.0, 2.0, None, None), ("A", "1", "2018-02", "$", 2.0, None, None, None),
        ("B", "2", "2018-01", None, None, 2.0, "Persons", 7.0), ("C", None, "2018-01", None, None, 2.0, None, None),
    ]))


def test_panel_refuses_duplicate_keys(spark):
    twice = spark.createDataFrame([("1", "2018-01", 1.0), ("1", "2018-01", 3.0)], "DGUID string, REF_DATE string, v double")
    with pytest.raises(Exception, match="several rows of one key"):
        build_panel(_spine(spark), [Feature(twice, ["v"])]).collect()
    merged = build_panel(_spine(spark), [Feature(twice, ["v"], duplicates="mean")])
    assert merged.count() == 4 and merged.where("GEO = 'A' AND REF_DATE = '2018-01'").first()["v"] == 2.0
    with pytest.raises(ValueError):
        build_panel(_spine(spark), [Feature(twice, ["v"], duplicates="maybe")])
    with pytest.raises(ValueError):
        build_panel(_spine(spark), [Feature(twice, ["v"], grain="week")])


def test_code_lookup_between_text_and_number(spark):
    rows = spark.createDataFrame([("1", 10), ("01", 11), ("x", 12), (None, 13)], "uom_id string, id int")
    codes = spark.createDataFrame([(1, "Dollars")], "code int, text string")
    out = lookups.code_lookup(rows, "uom_id", codes, "code", "text", "uom")
    assert sorted((r["id"], r["uom"]) for r in out.collect()) == [(10, "Dollars"), (11, "Dollars")]


def test_averages_do_not_repeat_detail(spark):
    detail = spark.createDataFrame([("A", "1", 1.0), ("P", "9", 5.0)], "GEO string, DGUID string, v double")
    averages = spark.createDataFrame([("P", "9", 3.0), ("Q", "8", 4.0)], "GEO string, DGUID string, v double")
    once = lookups.detail_and_average(detail, averages, ["DGUID"])
    assert sorted(map(tuple, once.collect())) == [("A", "1", 1.0), ("P", "9", 5.0), ("Q", "8", 4.0)]
    assert lookups.detail_and_average(detail, averages, ["DGUID"], keep_duplicates=True).count() == 4


def test_extremes_keep_ties_and_stay_in_their_group(spark):
    rows = spark.createDataFrame(
        [("a", 5, 1), ("a", 5, 2), ("a", 3, 3), ("b", 9, 4), ("b", 5, 5), ("c", 5, 6), ("c", None, 7)],
        "g string, v int, id int",
    )
    assert sorted(r["id"] for r in x.extremes(rows, "g", "v").collect()) == [1, 2, 4, 6]
    assert sorted(r["id"] for r in x.extremes(rows, "g", "v", "min").collect()) == [3, 5, 6]
    # by value only: 5 is the extreme of groups a and c, so the row of group b that holds it is found, too, and each row once
    crossed = sorted((r["id"], r["max_v"], r["max_groups"]) for r in x.extremes_by_value(rows, "g", "v").collect())
    assert crossed == [(1, 5, 2), (2, 5, 2), (4, 9, 1), (5, 5, 2), (6, 5, 2)]
    with pytest.raises(ValueError):
        x.extremes(rows, "g", "v", "median")


def test_correlation_uses_complete_pairs(spark):
    rows = spark.createDataFrame([(1, 2.0), (2, 4.1), (3, 5.9), (50, None)], "a int, p double")
    a = x.correlation(rows, "a", "p").first()
    b = x.correlation_of_moments(x.moments(rows, "a", "p")).first()
    assert a["r"] == pytest.approx(3.9 / (2 * 7.62) ** 0.5) and a["r_squared"] == pytest.approx(a["r"] ** 2)
    assert b["r"] == pytest.approx(a["r"])
    constant = spark.createDataFrame([(1, 2.0), (1, 4.0)], "a int, p double")
    assert x.correlation(constant, "a", "p").first()["r"] is None
    assert x.correlation_of_moments(x.moments(constant, "a", "p")).first()["r"] is None


def test_distinct_counts(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("a", None), ("b", 1)], "g string, v int")
    assert sorted(map(tuple, x.distinct_count(rows, ["g"], ["v"]).collect())) == [("a", 2), ("b", 1)]
    assert sorted(map(tuple, x.distinct_count(rows, ["g"], ["v"], approximate=True).collect())) == [("a", 2), ("b", 1)]


def test_mean_fill(spark):
    rows = spark.createDataFrame([(1, 1200.0), (2, 800.0), (3, None)], "id int, area double")
    assert sorted(map(tuple, f.fill_mean(rows, "area").collect())) == [(1, 1200.0), (2, 800.0), (3, 1000.0)]


def test_one_hot(spark):
    rows = spark.createDataFrame([("b",), ("a",), (None,)], "GEO string")
    out = f.one_hot(rows, "GEO", "Province", f.levels_of(rows, "GEO"))
    assert out.columns == ["GEO", "Province_a", "Province_b"]
    assert sorted(map(str, map(tuple, out.collect()))) == ["('a', 1, 0)", "('b', 0, 1)", "(None, 0, 0)"]
    many = spark.range(1500).selectExpr("lpad(cast(id AS string), 4, '0') AS level").unionAll(spark.sql("SELECT cast(NULL AS string)"))
    coded = f.one_hot_vector(many, "level", "hot").collect()
    assert {r["hot"].size for r in coded} == {1500}
    assert all(list(r["hot"].indices) == ([] if r["level"] is None else [int(r["level"])]) for r in coded)


def test_imputation_edge_cases(spark):
    rows = spark.createDataFrame(
        [("none", 1, None), ("none", 2, None), ("one", 1, 7.0), ("one", 2, None),
         ("still", 4, 1.0), ("still", 4, 3.0), ("still", 5, None),
         ("line", 1, 2.0), ("line", 2, None), ("line", 3, 6.0), ("line", 10, None)],
        "g string, x int, y double",
    )
    out = {(r["g"], r["x"]): r["y"] for r in f.impute_regression(rows, "g", "x", ["y"]).collect() if r["x"] != 4}
    assert out == {
        ("none", 1): 0.0, ("none", 2): 0.0, ("one", 1): 7.0, ("one", 2): 7.0, ("still", 5): 2.0,
        ("line", 1): 2.0, ("line", 2): pytest.approx(4.0), ("line", 3): 6.0, ("line", 10): pytest.approx(20.0),
    }


def test_min_max(spark):
    rows = spark.createDataFrame([(1, 3.0, 5), (2, 3.0, 15), (3, 3.0, None)], "id int, constant double, v int")
    out = {r["id"]: (r["constant"], r["v"]) for r in f.min_max(rows, ["constant", "v"]).collect()}
    assert out == {1: (0.0, 0.0), 2: (0.0, 1.0), 3: (0.0, None)}
    held_out = {r["id"]: r["v"] for r in f.min_max(rows, ["v"], fit_on=rows.where("id < 2").withColumn("v", F.lit(10))).collect()}
    assert held_out[2] == 5.0


def test_look_back(spark):
    rows = spark.createDataFrame(
        [("long", f"2018-{m:02d}", float(m)) for m in range(1, 8)] + [("short", f"2018-{m:02d}", 0.0) for m in range(1, 7)],
        "DGUID string, REF_DATE string, v double",
    )
    out = f.look_back(rows, "DGUID", "REF_DATE", ["v"], 6).collect()
    assert len(out) == 1 and out[0]["REF_DATE"] == "2018-07" and [s["v"] for s in out[0]["history"]] == [1, 2, 3, 4, 5, 6]
    lagged = f.lags(rows, "DGUID", "REF_DATE", "v", 6).first()
    assert [lagged[f"v_lag{k}"] for k in range(1, 7)] == [6, 5, 4, 3, 2, 1]


@pytest.mark.parametrize("n, chunk", [(1, 1), (3, 3), (3, 7), (6, 10), (6, 1000)])
def test_look_back_in_chunks_equals_brute_force(spark, n, chunk):
    # one group holds most rows; years differ in length, some shorter than the look-back
    groups = {"hot": [y * 1000 + i for y, size in ((2001, 40), (2002, 2), (2003, 1), (2005, 57)) for i in range(size)],
              "cold": [2001000, 2003001, 2003002, 2004000], "tiny": [2001000], None: [2001000 + i for i in range(9)]}
    rows = [(g, o) for g, orders in groups.items() for o in orders]
    df = spark.createDataFrame(rows, "g string, o int").repartition(5)
    out = f.look_back(df, "g", "o", ["o"], n, bucket=F.floor(F.col("o") / 1000), chunk=chunk)
    assert out.columns == ["g", "o", "history"]
    found = {(r["g"], r["o"]): [s["o"] for s in r["history"]] for r in out.collect()}
    expected = {(g, o[i]): o[i - n:i] for g, o in groups.items() for i in range(n, len(o))}
    assert found == expected


def test_time_split(spark):
    rows = spark.createDataFrame([("2017-12",), ("2018-01",), ("2018-02",)], "REF_DATE string")
    train, valid = f.time_split(rows, "REF_DATE", "2018-01")
    assert train.count() == 1 and valid.count() == 2
