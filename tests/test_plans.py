"""What the physical plans look like, and what a hot key does to them."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from panelwright.operators import extremes as x
from panelwright.operators import features as f
from panelwright.operators.panel import Feature, build_panel, co_located
from panelwright.operators.reshape import pivot_mean
from panelwright.registry import all_queries
from panelwright.session import settings
from panelwright.sources.sinks import write_observed_panel

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """The plan after a run, without the initial one and without shared parts printed twice."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    return execution.executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def lineitem(spark):
    return spark.read.parquet(f"{SF}/lineitem.parquet")


def test_pivot_takes_one_shuffle_after_map_side_means(lineitem):
    text = plan(pivot_mean(lineitem, ["l_linestatus"], "l_returnflag", {"A": "a", "N": "n", "R": "r"}, "l_quantity"))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_avg" in text
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string,l_linestatus:string>" in text
    assert re.search(r"PushedFilters: \[.*In\(l_returnflag", text)


def test_extremes_are_thinned_before_the_shuffle(lineitem):
    text = plan(x.extremes(lineitem.select("l_returnflag", "l_quantity", "l_orderkey"), "l_returnflag", "l_quantity"))
    exchange = text.index("Exchange hashpartitioning(l_returnflag", text.index("WindowGroupLimit"))
    assert "WindowGroupLimit" in text[exchange:] and "Partial" in text[exchange:]
    assert "_slice" in text[exchange:exchange + 120]


def test_many_copies_of_the_best_row_stay_apart(spark):
    rows = spark.range(0, 9000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), F.col("id") % 5)).alias("g"),
        F.when(F.col("id") % 3 == 0, F.lit(99)).otherwise(F.col("id") % 50).cast("int").alias("v"),
    )
    everything = [tuple(r) for r in rows.collect()]
    for how, pick, spread in (("max", max, 64), ("min", min, 3)):
        best = {g: pick(v for h, v in everything if h == g) for g, _ in everything}
        expected = sorted((g, v) for g, v in everything if v == best[g])
        assert sum(g == "hot" for g, _ in expected) == 3000
        assert sorted(map(tuple, x.extremes(rows, "g", "v", how, spread).collect())) == expected


def test_global_statistics_are_one_subquery(lineitem):
    scaled = f.min_max(lineitem.select("l_quantity", "l_tax", "l_discount"), ["l_quantity", "l_tax", "l_discount"])
    text = plan(scaled)
    assert text.count("Subquery subquery") <= 2 and "Join" not in text and "CartesianProduct" not in text
    filled = plan(f.fill_mean(lineitem.select("l_quantity", "l_tax"), "l_quantity", "l_tax"))
    assert filled.count("Subquery subquery") <= 2 and "Join" not in filled


def test_time_split_reaches_the_scan(lineitem):
    train, _ = f.time_split(lineitem.select("l_orderkey", "l_shipdate"), "l_shipdate", "1997-01-01")
    assert re.search(r"PushedFilters: \[.*LessThan\(l_shipdate", plan(train))


def test_top_rows_do_not_sort_everything(lineitem):
    assert "TakeOrderedAndProject" in plan(x.first_rows(lineitem, ["l_orderkey", "l_linenumber"]))


def test_distinct_count_shuffles_by_value_first(lineitem):
    text = plan(x.distinct_count(lineitem, ["l_returnflag"], ["l_extendedprice"]))
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    assert any("l_extendedprice" in k for k in keys)


def test_features_with_the_same_key_share_the_shuffle_of_the_spine(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        month = F.date_format(F.timestamp_seconds(F.col("id") * 86400), "yyyy-MM")
        base = spark.range(1000).select(F.col("id").cast("string").alias("DGUID"), month.alias("REF_DATE"), F.rand().alias("v"))
        features = [
            Feature(base.withColumnRenamed("v", "a"), ["a"]),
            Feature(base.withColumnRenamed("v", "y").withColumn("REF_DATE", F.substring("REF_DATE", 1, 4)), ["y"], grain="year"),
            Feature(base.withColumnRenamed("v", "b"), ["b"]),
            Feature(base.withColumnRenamed("v", "c"), ["c"]),
        ]
        text = plan(build_panel(base, features))
        # each feature once for its check; the spine once per kind of key
        assert text.count("Exchange hashpartitioning") == len(features) + 2
        assert text.count("SortMergeJoin") == len(features)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_a_hot_customer_is_split(spark, tmp_path):
    """A third of the orders on one key: the partition is split, and the result is whole."""
    n = 30_000
    orders = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 997).alias("k"),
        (F.col("id") % 84).cast("int").alias("month"), F.repeat(F.lit("x"), 200).alias("pad"),
        F.lit(1.0).alias("price"),
    )
    orders.write.parquet(str(tmp_path / "orders"))
    spark.range(997).select(F.col("id").alias("ck"), (F.col("id") % 25).alias("nation"), F.repeat(F.lit("y"), 50).alias("name")).write.parquet(
        str(tmp_path / "customers"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.shuffle.partitions": "16", "spark.sql.files.maxPartitionBytes": "32KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        left, right = spark.read.parquet(str(tmp_path / "orders")), spark.read.parquet(str(tmp_path / "customers"))
        joined = left.join(right, F.col("k") == F.col("ck")).groupBy("nation", "month").agg(
            F.avg("price").alias("p"), F.count("*").alias("n"), F.max("pad"), F.max("name"))
        text = final_plan(joined)
        assert "skew=true" in text
        assert joined.agg(F.sum("n")).first()[0] == n
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_no_python_in_any_registered_query(spark):
    for name, query in all_queries().items():
        if name in ("ridge_poly", "lag_forecast", "lag_forecast_errors", "panel_roundtrip") or name.startswith("regional_panel"):
            continue
        text = plan(query(spark, SF))
        assert "Python" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_imputation_does_not_shuffle_the_wide_rows(spark, tmp_path):
    spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 40).alias("g"), F.col("id").alias("x"),
        F.when(F.col("id") % 7 > 0, F.col("id") * 2.0).alias("y"),
    ).write.parquet(str(tmp_path / "rows"))
    filled = f.impute_regression(spark.read.parquet(str(tmp_path / "rows")), "g", "x", ["y"])
    text = final_plan(filled)
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    assert filled.where("abs(y - x * 2) > 1e-6").isEmpty() and filled.count() == 9000


def test_national_rows_join_on_any_form_of_period(spark):
    spine = spark.createDataFrame([("r", "2018-Q1"), ("r", "2018-01"), ("s", "2018")], "DGUID string, REF_DATE string")
    national = spark.createDataFrame([("2018-Q1", 1.0), ("2018-01", 2.0), ("2018", 3.0)], "REF_DATE string, v double")
    out = build_panel(spine, [Feature(national, ["v"], by="national", duplicates="raise")])
    assert sorted(r["v"] for r in out.collect()) == [1.0, 2.0, 3.0]
    assert "broadcast" not in out._jdf.queryExecution().logical().toString().lower()


def test_archives_are_not_read_again_by_the_panel(spark, tmp_path):
    import json
    import zipfile

    from panelwright.jobs import scan_tables
    from panelwright.plans.regional_panel import load_all, regional_panel
    from panelwright.sources.schemas import PRODUCTS, RATE_VALUES, statistics_columns

    for table, (product, _) in PRODUCTS.items():
        (tmp_path / "s" / product).mkdir(parents=True)
        with zipfile.ZipFile(tmp_path / "s" / product / "a.zip", "w") as archive:
            archive.writestr("t.csv", ",".join(f'"{c}"' for c in statistics_columns(table)) + "\n")
    (tmp_path / "codes.json").write_text(json.dumps({"object": {"uom": [], "scalar": []}}))
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "Ontario_weather.csv").write_text("Date/Time\n")
    (tmp_path / "rates.csv").write_text("date," + ",".join(RATE_VALUES) + "\n")
    tables = scan_tables(spark, f"{tmp_path}/s", f"{tmp_path}/codes.json", f"{tmp_path}/w", f"{tmp_path}/rates.csv")
    text = plan(regional_panel(load_all(tables)))
    assert "MapInPandas" not in text and "binaryFile" not in text
    # the spine and the fuel pivot are plain scans of what was written once
    assert text.count("New housing price indexes") == 0 and text.count("Type of fuel") == 0


def test_co_located_tables_are_joined_where_they_lie(spark):
    months = [(g, f"{y}-{m:02d}") for g in "abc" for y in (2016, 2017) for m in range(1, 13)]
    spine = spark.createDataFrame([(*k, float(i)) for i, k in enumerate(months)], "DGUID string, REF_DATE string, price double")
    monthly = spark.createDataFrame([(*k, i) for i, k in enumerate(months[::2])], "DGUID string, REF_DATE string, n int")
    annual = spark.createDataFrame([(g, "2017", 12.0 * i) for i, g in enumerate("abd")], "DGUID string, REF_DATE string, income double")
    national = spark.createDataFrame([("2016-05", 0.5)], "REF_DATE string, rate double")
    features = [
        Feature(monthly, ["n"]), Feature(annual, ["income"], grain="year", annual=["income"], tags={"uom_income": "Dollars"}),
        Feature(national, ["rate"], by="national", duplicates="unique"),
    ]
    got = co_located(spine, features, 4, "panel_co_located")
    plain = build_panel(spine, features)
    assert got.columns == plain.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
    with settings(spark, spark__sql__requireAllClusterKeysForCoPartition="false", spark__sql__autoBroadcastJoinThreshold="-1"):
        table = lambda part: spark.table(f"panel_co_located_{part}")
        regional = [Feature(table("feature_0"), ["n"]), Feature(table("feature_1"), ["income"], grain="year")]
        text = plan(build_panel(table("spine"), regional, year="_panel_year"))
        assert text.count("SortMergeJoin") == 2 and "Exchange" not in text and "Bucketed: true" in text
        assert "Exchange" in plan(build_panel(spine, regional[:1]))


def test_the_observed_panel_is_read_once(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    rows = spark.createDataFrame([(f"{y}-0{m}", None if m == 2 else 1.0) for y in (2016, 2017) for m in (1, 2, 3)], "REF_DATE string, v double")
    seen = write_observed_panel(rows.mapInArrow(count, rows.schema), f"{tmp_path}/panel", "v")
    assert seen == {"n_rows": 6, "n_without_target": 2, "first_period": "2016-01", "last_period": "2017-03"}
    assert reads.value == 6 and spark.read.parquet(f"{tmp_path}/panel").count() == 6
