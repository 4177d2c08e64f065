"""Filters, labels, pivots, group means, lookups, unions and distinct counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions.dates import month_number, month_of, year_of
from panelwright.functions.labels import after_last_comma, province_of, region_of_file, rewrite_border_cities, strip_code
from panelwright.functions.numbers import round_half_up, scaled_by_base, unit_base
from panelwright.operators import extremes as x
from panelwright.operators.features import fill_constant, fill_mean
from panelwright.operators.lookups import code_lookup, detail_and_average, name_to_id
from panelwright.operators.reshape import (
    distinct_rows, group_mean, keep_all_equal, keep_in, keep_not_null, pivot_mean, with_tags,
)
from panelwright.plans import workbook
from panelwright.registry.support import SPINE, r, read, spine, tidy
from panelwright.session import landed

FLAGS = {"A": "mean_a", "N": "mean_n", "R": "mean_r"}
PRIORITIES = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium"}


def pivot_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").select(
        F.trunc("l_shipdate", "month").alias("month"), "l_returnflag", "l_extendedprice"
    )
    wide = pivot_mean(lines, ["month"], "l_returnflag", FLAGS, "l_extendedprice")
    return tidy(wide.select(F.date_format("month", "yyyy-MM").alias("REF_DATE"), *FLAGS.values()))


_PIVOT_FLAGS = f"""SELECT strftime(l_shipdate, '%Y-%m') AS "REF_DATE",
{', '.join(r(f"avg(CASE WHEN l_returnflag = '{k}' THEN l_extendedprice END)") + f' AS {v}' for k, v in FLAGS.items())}
FROM lineitem WHERE l_returnflag IN ('A', 'N', 'R') AND l_extendedprice IS NOT NULL AND l_shipdate IS NOT NULL GROUP BY 1"""


def pivot_three_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    orders = read(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    long = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).withColumn(
        "month", F.trunc("o_orderdate", "month")
    )
    keys = ["month", "c_nationkey", "c_mktsegment"]
    wide = pivot_mean(long, keys, "o_orderpriority", PRIORITIES, "o_totalprice")
    return tidy(wide.withColumn("REF_DATE", F.date_format("month", "yyyy-MM")).drop("month"))


_PIVOT_THREE = f"""SELECT strftime(o_orderdate, '%Y-%m') AS "REF_DATE", c_nationkey, c_mktsegment,
{', '.join(r(f"avg(CASE WHEN o_orderpriority = '{k}' THEN o_totalprice END)") + f' AS {v}' for k, v in PRIORITIES.items())}
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY 1, 2, 3"""


def daily_to_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem")
    days = lines.groupBy(F.to_date("l_shipdate").alias("day")).agg(
        F.avg("l_discount").alias("discount"), F.avg("l_tax").alias("tax")
    )
    # the step itself takes dates as texts, one row per day
    daily = days.withColumn("date", F.date_format("day", "yyyy-MM-dd"))
    return tidy(group_mean(daily, [month_of("date").alias("REF_DATE")], ["discount", "tax"]), 6)


_DAILY_TO_MONTH = f"""WITH daily AS (
  SELECT strftime(l_shipdate, '%Y-%m-%d') AS d, avg(l_discount) AS discount, avg(l_tax) AS tax FROM lineitem GROUP BY 1)
SELECT substr(d, 1, 7) AS "REF_DATE", {r('avg(discount)', 6)} AS discount, {r('avg(tax)', 6)} AS tax
FROM daily GROUP BY 1"""


def group_trimmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    nations = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    padded = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).withColumn(
        "label", F.when(F.col("c_acctbal") < 0, F.concat(F.lit("  "), "n_name")).otherwise(F.concat("n_name", F.lit(" ")))
    )
    return tidy(group_mean(padded, [F.trim("label").alias("label")], {"c_acctbal": "balance"}))


_GROUP_TRIMMED = f"""SELECT trim(label) AS label, {r('avg(c_acctbal)')} AS balance FROM (
  SELECT CASE WHEN c_acctbal < 0 THEN '  ' || n_name ELSE n_name || ' ' END AS label, c_acctbal
  FROM customer JOIN nation ON c_nationkey = n_nationkey) GROUP BY 1"""


def distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_linestatus", F.trunc("l_shipdate", "month").alias("month")
    )
    kept = distinct_rows(lines, ["l_returnflag", "l_linestatus", "month"])
    return kept.withColumn("ship_month", F.date_format("month", "yyyy-MM")).drop("month")


def code_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = read(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("string").alias("uom_id")
    )
    nations = read(spark, sf_dir, "nation")
    regions = read(spark, sf_dir, "region")
    named = code_lookup(customers, "uom_id", nations, "n_nationkey", "n_name", "uom")
    keys = nations.select(F.col("n_name").alias("uom"), F.col("n_regionkey").cast("string").alias("scalar_id"))
    return code_lookup(named.join(keys, "uom"), "scalar_id", regions, "r_regionkey", "r_name", "scalar")


def name_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = read(spark, sf_dir, "nation").select(F.col("n_name").alias("GEO"), F.col("n_nationkey").alias("DGUID"))
    suppliers = read(spark, sf_dir, "supplier").select(
        "s_suppkey", F.concat(F.lit("NATION_"), "s_nationkey").alias("GEO")
    )
    return name_to_id(suppliers, nations)


def filter_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return keep_in(orders, "o_orderpriority", ["1-URGENT", "5-LOW"])


def filter_all_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem")
    kept = keep_all_equal(lines, l_returnflag="R", l_linestatus="F", l_linenumber=1)
    return kept.select("l_orderkey", "l_partkey", "l_quantity")


def filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
    )
    return keep_not_null(orders, "status", "priority")


def tagged_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("VALUE"))
    return with_tags(suppliers, uom="Dollars", scalar="unit", statistic="Balance")


def label_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = read(spark, sf_dir, "nation")
    regions = read(spark, sf_dir, "region")
    suppliers = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    rows = suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).join(
        regions, F.col("n_regionkey") == F.col("r_regionkey")
    )
    label = (
        F.when(F.col("n_regionkey") == 0, F.col("r_name"))
        .when(F.col("n_regionkey") == 1, F.lit("Ottawa-Gatineau, Quebec part, Ontario/Quebec"))
        .otherwise(F.concat("n_name", F.lit(", "), "r_name", F.lit(" ["), "n_nationkey", F.lit("]")))
    )
    file_name = F.concat(F.lit("/data/"), "r_name", F.lit("%20"), "n_nationkey", F.lit("_weather.csv"))
    return rows.select("s_suppkey", label.alias("label"), file_name.alias("file_name")).select(
        "s_suppkey",
        rewrite_border_cities("label").alias("rewritten"),
        after_last_comma("label").alias("tail"),
        strip_code("label").alias("without_code"),
        province_of("label").alias("province"),
        region_of_file("file_name").alias("file_region"),
    )


_LABELS = """SELECT s_suppkey, CASE WHEN n_regionkey = 0 THEN r_name
    WHEN n_regionkey = 1 THEN 'Ottawa-Gatineau, Quebec part, Ontario/Quebec'
    ELSE n_name || ', ' || r_name || ' [' || n_nationkey || ']' END AS label,
  '/data/' || r_name || '%20' || n_nationkey || '_weather.csv' AS file_name
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
_REWRITTEN = "replace(label, 'Ottawa-Gatineau, Quebec part, Ontario/Quebec', 'Ottawa,Quebec')"
_LABEL_REGION = f"""SELECT s_suppkey, {_REWRITTEN} AS rewritten, trim(split_part(label, ',', -1)) AS tail,
  regexp_replace(label, ' *\\[[^\\]]*\\]$', '') AS without_code,
  trim(split_part(regexp_replace({_REWRITTEN}, ' *\\[[^\\]]*\\]$', ''), ',', -1)) AS province,
  split_part(replace(split_part(file_name, '/', -1), '%20', ' '), '_', 1) AS file_region
FROM ({_LABELS})"""


def period_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = read(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"))
    return dates.select(
        "o_orderkey", year_of("date").alias("year"), month_of("date").alias("month"),
        month_number(month_of("date")).alias("month_number"),
    )


def unit_base_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = read(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice").withColumn(
        "uom", F.when(F.col("p_size") > 40, F.lit("Dollars")).otherwise(F.concat(F.lit("Index, 201612="), "p_size"))
    )
    return tidy(parts.select(
        "p_partkey", unit_base("uom").alias("base"), scaled_by_base("p_retailprice", "uom").alias("scaled"),
        round_half_up(F.col("p_retailprice") / 12, 2).alias("share"),
    ))


_UNIT_BASE = f"""SELECT p_partkey, base, {r('p_retailprice * base')} AS scaled, {r('p_retailprice / 12', 2)} AS share FROM (
  SELECT p_partkey, p_retailprice, try_cast(split_part(uom, '=', -1) AS DOUBLE) AS base FROM (
    SELECT *, CASE WHEN p_size > 40 THEN 'Dollars' ELSE 'Index, 201612=' || p_size END AS uom FROM part))"""


def mean_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = read(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(F.col("p_size") > 10, F.col("p_size").cast("double")).alias("area"),
        F.nullif("p_type", F.lit("PROMO")).alias("kind"),
    )
    return tidy(fill_constant(fill_mean(parts, "area"), kind="unknown"))


_MEAN_FILL = f"""WITH t AS (SELECT p_partkey, CASE WHEN p_size > 10 THEN p_size::DOUBLE END AS area, p_type FROM part)
SELECT p_partkey, {r('coalesce(area, (SELECT avg(area) FROM t))')} AS area,
  coalesce(nullif(p_type, 'PROMO'), 'unknown') AS kind FROM t"""


def detail_union_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = read(spark, sf_dir, "customer").select("c_nationkey", "c_acctbal")
    nations = read(spark, sf_dir, "nation")
    regions = read(spark, sf_dir, "region")
    # read as detail, for the averages and for the keys that both have: pass over the customers once
    balances = landed(customers.groupBy("c_nationkey").agg(F.avg("c_acctbal").alias("balance")))
    named = balances.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).join(
        regions, F.col("n_regionkey") == F.col("r_regionkey")
    )
    detail = named.select(
        F.concat("n_name", F.lit(", "), "r_name").alias("GEO"),
        F.concat(F.lit("N"), "n_nationkey").alias("DGUID"), "balance",
    )
    ids = regions.select(F.col("r_name").alias("GEO"), F.concat(F.lit("R"), "r_regionkey").alias("DGUID"))
    averages = name_to_id(group_mean(detail, [province_of("GEO").alias("GEO")], ["balance"]), ids)
    return tidy(detail_and_average(detail, averages, ["DGUID"]))


_DETAIL_UNION = f"""WITH detail AS (
  SELECT n_name || ', ' || r_name AS geo, 'N' || n_nationkey AS dguid, r_name, r_regionkey, avg(c_acctbal) AS balance
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2, 3, 4)
SELECT geo AS "GEO", dguid AS "DGUID", {r('balance')} AS balance FROM detail
UNION ALL SELECT r_name, 'R' || r_regionkey, {r('avg(balance)')} FROM detail GROUP BY r_name, r_regionkey"""


def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = read(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand", "p_retailprice")
    return x.first_rows(parts, [F.desc("p_retailprice"), "p_partkey"], 20)


def sorted_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(spine(spark, sf_dir).orderBy("REF_DATE", "GEO"))


def _index_panel(spark: SparkSession, sf_dir: str, *more: Column) -> DataFrame:
    """Orders as panel rows: nation, year, unit (segment) and prices."""
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nations = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    orders = read(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    return (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("n_name").alias("GEO"), F.year("o_orderdate").alias("year"), F.col("c_mktsegment").alias("uom_houseindex"),
            F.col("o_totalprice").alias("total_house_land"), F.floor("o_totalprice").alias("house_only"),
            F.floor(F.col("o_totalprice") / 1000).alias("land_only"), *more,
        )
    )


_INDEX_PANEL = """panel AS (
  SELECT n_name AS "GEO", year(o_orderdate)::INTEGER AS "year", c_mktsegment AS uom_houseindex, o_totalprice,
    floor(o_totalprice) AS house_only, floor(o_totalprice / 1000) AS land_only
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def bi_distinct_by_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workbook.distinct_by_unit(_index_panel(spark, sf_dir), year=1998)


def bi_distinct_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workbook.distinct_by_year(_index_panel(spark, sf_dir), region="NATION_3")


def bi_distinct_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workbook.distinct_by_year(_index_panel(spark, sf_dir))


def bi_distinct_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workbook.distinct_by_unit(_index_panel(spark, sf_dir), measures=("house_only", "land_only"))


MAP = [f"NATION_{i}" for i in range(10)]


def bi_distinct_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workbook.distinct_on_map(_index_panel(spark, sf_dir), MAP)


def bi_distinct_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact counts per unit and region, and whether the counts out of stored monthly sketches are within 5 per cent."""
    panel = landed(_index_panel(spark, sf_dir, F.date_format("o_orderdate", "yyyy-MM").alias("REF_DATE")), "panel")
    sketches = landed(workbook.stored_sketches(panel), "sketches")
    groups = ["uom_houseindex", "GEO"]
    exact = x.distinct_count(panel, groups, ["total_house_land"])
    near = workbook.sheet_of_sketches(sketches, groups).withColumnRenamed("distinct_total_house_land", "estimate")
    off = F.abs(F.col("estimate") - F.col("distinct_total_house_land"))
    return exact.join(near, groups).select(
        *groups, "distinct_total_house_land", (20 * off <= F.col("distinct_total_house_land")).alias("within_5_percent")
    )


_DISTINCT = 'SELECT "year", uom_houseindex, "GEO", count(DISTINCT o_totalprice) AS distinct_total_house_land FROM panel'


QUERIES = {
    "pivot_mean": (pivot_flags, _PIVOT_FLAGS),
    "pivot_three_keys": (pivot_three_keys, _PIVOT_THREE),
    "daily_to_month": (daily_to_month, _DAILY_TO_MONTH),
    "group_trimmed": (group_trimmed, _GROUP_TRIMMED),
    "distinct_keys": (
        distinct_keys,
        "SELECT DISTINCT l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m') AS ship_month FROM lineitem",
    ),
    "code_lookup": (
        code_lookups,
        "SELECT c_custkey, c_nationkey::VARCHAR AS uom_id, n_name AS uom, n_regionkey::VARCHAR AS scalar_id, r_name AS scalar "
        "FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
    ),
    "name_to_id": (
        name_ids,
        'SELECT s_suppkey, n_name AS "GEO", n_nationkey AS "DGUID" FROM supplier JOIN nation '
        "ON 'NATION_' || s_nationkey = n_name",
    ),
    "filter_in": (
        filter_in,
        "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')",
    ),
    "filter_all_equal": (
        filter_all_equal,
        "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem "
        "WHERE l_returnflag = 'R' AND l_linestatus = 'F' AND l_linenumber = 1",
    ),
    "filter_not_null": (
        filter_not_null,
        "SELECT * FROM (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status, nullif(o_orderpriority, '5-LOW') "
        "AS priority FROM orders) WHERE status IS NOT NULL AND priority IS NOT NULL",
    ),
    "tag_columns": (
        tagged_columns,
        "SELECT s_suppkey AS id, s_acctbal AS \"VALUE\", 'Dollars' AS uom, 'unit' AS scalar, 'Balance' AS statistic "
        "FROM supplier",
    ),
    "label_region": (label_region, _LABEL_REGION),
    "period_parts": (
        period_parts,
        "SELECT o_orderkey, strftime(o_orderdate, '%Y') AS \"year\", strftime(o_orderdate, '%Y-%m') AS \"month\", "
        "strftime(o_orderdate, '%Y%m')::INTEGER AS month_number FROM orders",
    ),
    "unit_base_scale": (unit_base_scale, _UNIT_BASE),
    "mean_fill": (mean_fill, _MEAN_FILL),
    "detail_union_avg": (detail_union_avg, _DETAIL_UNION),
    "first_rows": (
        first_rows,
        "SELECT p_partkey, p_type, p_brand, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 20",
    ),
    "sorted_panel": (
        sorted_panel,
        f'WITH {SPINE} SELECT "GEO", "DGUID", "REF_DATE", {r("price")} AS price FROM spine ORDER BY "REF_DATE", "GEO"',
    ),
    "bi_distinct_by_unit": (
        bi_distinct_by_unit, f'WITH {_INDEX_PANEL} {_DISTINCT} WHERE "year" = 1998 GROUP BY 1, 2, 3'
    ),
    "bi_distinct_by_year": (
        bi_distinct_by_year, f"WITH {_INDEX_PANEL} {_DISTINCT} WHERE \"GEO\" = 'NATION_3' GROUP BY 1, 2, 3"
    ),
    "bi_distinct_all": (bi_distinct_all, f"WITH {_INDEX_PANEL} {_DISTINCT} GROUP BY 1, 2, 3"),
    "bi_distinct_parts": (
        bi_distinct_parts,
        f"""WITH {_INDEX_PANEL} SELECT "year", uom_houseindex, "GEO", count(DISTINCT house_only) AS distinct_house_only,
  count(DISTINCT land_only) AS distinct_land_only FROM panel GROUP BY 1, 2, 3""",
    ),
    "bi_distinct_sketch": (
        bi_distinct_sketch,
        f"""WITH {_INDEX_PANEL} SELECT uom_houseindex, "GEO", count(DISTINCT o_totalprice) AS distinct_total_house_land,
  true AS within_5_percent FROM panel GROUP BY 1, 2""",
    ),
    "bi_distinct_filtered": (
        bi_distinct_filtered,
        f"WITH {_INDEX_PANEL} {_DISTINCT} WHERE \"GEO\" IN ({', '.join(repr(n) for n in MAP)}) GROUP BY 1, 2, 3",
    ),
}
