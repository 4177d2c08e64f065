"""Panels around the nation x month spine."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions.labels import province_of
from panelwright.functions.numbers import net_flow as net
from panelwright.operators.panel import Feature, build_panel, co_located
from panelwright.operators.refresh import Refresh, refresh_panel
from panelwright.registry.support import SPINE, r, read, tidy
from panelwright.sources.files import keys_and_numbers, read_panel
from panelwright.sources.sinks import write_observed_panel, write_panel
from panelwright.session import landed, scratch_path


def order_facts(spark: SparkSession, sf_dir: str, which: str = "true") -> DataFrame:
    """Sums of the orders per nation and month: the only pass over the orders that a panel makes.

    Spine, annual prices and flows all come from this table of nations x
    months.  Written to the shared folder, it is neither computed once per
    use nor lost with an executor.  Months are grouped as dates, which is
    cheaper than as texts.
    """
    orders = read(spark, sf_dir, "orders").where(which).select("o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus")
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    counts = [
        F.count(F.when(F.col("o_orderstatus") == status, F.lit(1))).alias(f"n_{status.lower()}") for status in "FOP"
    ]
    return landed(
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_nationkey").alias("DGUID"), F.trunc("o_orderdate", "month").alias("start"))
        .agg(F.sum("o_totalprice").alias("total"), F.count("o_totalprice").alias("n"), *counts)
    )


def _named(df: DataFrame, pattern: str = "yyyy-MM") -> DataFrame:
    """The date column ``start`` as the text REF_DATE."""
    return df.withColumn("REF_DATE", F.date_format("start", pattern)).drop("start")


def _spine(spark: SparkSession, sf_dir: str, facts: DataFrame) -> DataFrame:
    nations = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("DGUID"), F.col("n_name").alias("GEO"))
    return _named(facts).join(nations, "DGUID").select(
        "GEO", "DGUID", "REF_DATE", F.try_divide("total", "n").alias("price")
    )


def _annual_total(facts: DataFrame) -> DataFrame:
    per_year = facts.groupBy("DGUID", F.trunc("start", "year").alias("start"))
    return _named(per_year.agg(F.try_divide(F.sum("total"), F.sum("n")).alias("annual_price")), "yyyy")


def panel_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = order_facts(spark, sf_dir)
    annual = Feature(_annual_total(facts), ["annual_price"], grain="year", annual=["annual_price"], duplicates="unique")
    return tidy(build_panel(_spine(spark, sf_dir, facts), [annual]))


_ANNUAL = """annual AS (
  SELECT c_nationkey AS dguid, strftime(o_orderdate, '%Y') AS yr, avg(o_totalprice) AS annual_price
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""

_PANEL_MIN = f"""WITH {SPINE}, {_ANNUAL}
SELECT s."GEO", s."DGUID", s."REF_DATE", {r('s.price')} AS price, {r('a.annual_price / 12.0', 2)} AS annual_price
FROM spine s LEFT JOIN annual a ON s."DGUID" = a.dguid AND substr(s."REF_DATE", 1, 4) = a.yr"""


def panel_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel_min(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_rows"))


def panel_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "panel")
    write_panel(panel_min(spark, sf_dir), path)
    return read_panel(spark, path).drop("panel_year")


def panel_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys_and_numbers(panel_min(spark, sf_dir).withColumn("unit", F.lit("Dollars")), ["REF_DATE"])


def line_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of the line items per nation of the supplier and day, in the shared folder: one pass over the lines."""
    lines = read(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_quantity", "l_discount", "l_tax")
    suppliers = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return landed(
        lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(F.col("s_nationkey").alias("DGUID"), F.to_date("l_shipdate").alias("day"))
        .agg(F.sum("l_quantity").alias("quantity"), F.sum("l_discount").alias("discount"), F.sum("l_tax").alias("tax"),
             F.count(F.lit(1)).alias("n"))
    )


def _flows(facts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Order counts per nation and month: finished and pending ones, and open ones; NULL where there are none."""
    named = _named(facts)
    keys = ["DGUID", "REF_DATE"]
    moves = named.select(
        *keys, F.nullif("n_f", F.lit(0)).alias("in_migrants"), F.nullif("n_p", F.lit(0)).alias("out_migrants")
    )
    return moves, named.select(*keys, F.nullif("n_o", F.lit(0)).alias("arrivals"))


def _full_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[Feature]]:
    orders, lines = order_facts(spark, sf_dir), line_facts(spark, sf_dir)
    month = F.trunc("day", "month").alias("start")

    def mean(column: str):
        return F.try_divide(F.sum(column), F.sum("n"))

    shipments = _named(lines.groupBy("DGUID", month).agg(mean("quantity").alias("quantity")))
    daily = lines.groupBy("day").agg(mean("discount").alias("rate"))
    national = _named(daily.groupBy(month).agg(F.avg("rate").alias("rate")))
    taxes = _named(lines.groupBy(month).agg(mean("tax").alias("tax_index")))
    moves, arrivals = _flows(orders)
    features = [
        Feature(_annual_total(orders), ["annual_price"], grain="year", annual=["annual_price"]),
        Feature(shipments, ["quantity"], tags={"uom_quantity": "Persons"}),
        Feature(taxes, ["tax_index"], by="national", duplicates="mean"),
        Feature(moves, ["in_migrants", "out_migrants"]),
        Feature(arrivals, ["arrivals"]),
        Feature(national, ["rate"], by="national", duplicates="unique"),
    ]
    return _spine(spark, sf_dir, orders), features


def _full(panel: DataFrame) -> DataFrame:
    flow = net("in_migrants", "arrivals", "out_migrants").alias("immigrants")
    return tidy(panel.select(
        "GEO", "DGUID", "REF_DATE", "price", "annual_price", "uom_quantity", "quantity", "tax_index", flow, "rate"
    ))


def panel_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _full(build_panel(*_full_parts(spark, sf_dir)))


def panel_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same panel over tables in buckets of region and year."""
    return _full(co_located(*_full_parts(spark, sf_dir), buckets=8, name=f"panel_{uuid.uuid4().hex}"))


def panel_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The figures that were counted while the panel was written, as one row."""
    seen = write_observed_panel(panel_min(spark, sf_dir), scratch_path(spark, "panel"), "annual_price")
    return spark.createDataFrame([seen], "n_rows long, n_without_target long, first_period string, last_period string")


_FLOWS = """moves AS (
  SELECT c_nationkey AS dguid, strftime(o_orderdate, '%Y-%m') AS ym,
         nullif(count(*) FILTER (WHERE o_orderstatus = 'F'), 0) AS in_migrants,
         nullif(count(*) FILTER (WHERE o_orderstatus = 'P'), 0) AS out_migrants,
         nullif(count(*) FILTER (WHERE o_orderstatus = 'O'), 0) AS arrivals
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""

_PANEL_FULL = f"""WITH {SPINE}, {_ANNUAL}, {_FLOWS},
shipments AS (
  SELECT s_nationkey AS dguid, strftime(l_shipdate, '%Y-%m') AS ym, avg(l_quantity) AS quantity
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2),
daily AS (SELECT cast(l_shipdate AS DATE) AS d, avg(l_discount) AS rate FROM lineitem GROUP BY 1),
national AS (SELECT strftime(d, '%Y-%m') AS ym, avg(rate) AS rate FROM daily GROUP BY 1),
taxes AS (SELECT strftime(l_shipdate, '%Y-%m') AS ym, avg(l_tax) AS tax_index FROM lineitem GROUP BY 1)
SELECT s."GEO", s."DGUID", s."REF_DATE", {r('s.price')} AS price, {r('a.annual_price / 12.0', 2)} AS annual_price,
       CASE WHEN q.dguid IS NOT NULL THEN 'Persons' END AS uom_quantity, {r('q.quantity')} AS quantity,
       {r('t.tax_index')} AS tax_index, m.in_migrants + m.arrivals - m.out_migrants AS immigrants,
       {r('n.rate')} AS rate
FROM spine s
LEFT JOIN annual a ON s."DGUID" = a.dguid AND substr(s."REF_DATE", 1, 4) = a.yr
LEFT JOIN shipments q ON s."DGUID" = q.dguid AND s."REF_DATE" = q.ym
LEFT JOIN moves m ON s."DGUID" = m.dguid AND s."REF_DATE" = m.ym
LEFT JOIN taxes t ON s."REF_DATE" = t.ym
LEFT JOIN national n ON s."REF_DATE" = n.ym"""


def panel_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = read(spark, sf_dir, "nation")
    regions = read(spark, sf_dir, "region")
    labels = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("DGUID"),
        F.concat("n_name", F.lit(", "), "r_name", F.lit(" ["), "n_nationkey", F.lit("]")).alias("label"),
    )
    facts = order_facts(spark, sf_dir)
    named = _spine(spark, sf_dir, facts).join(labels, "DGUID")
    by_province = named.groupBy(province_of("label").alias("province"), "REF_DATE").agg(F.avg("price").alias("avg_price"))
    annual = (
        _annual_total(facts).join(labels, "DGUID")
        .groupBy(province_of("label").alias("province"), "REF_DATE").agg(F.avg("annual_price").alias("avg_annual_price"))
    )
    feature = Feature(annual, ["avg_annual_price"], grain="year", annual=["avg_annual_price"])
    return tidy(build_panel(by_province, [feature], region="province"))


_PANEL_BY_NAME = f"""WITH {SPINE}, {_ANNUAL},
labels AS (
  SELECT n_nationkey AS dguid, n_name || ', ' || r_name || ' [' || n_nationkey || ']' AS label
  FROM nation JOIN region ON n_regionkey = r_regionkey),
names AS (SELECT dguid, trim(regexp_replace(split_part(label, ',', -1), ' *\\[[^\\]]*\\]$', '')) AS province FROM labels),
p AS (SELECT province, "REF_DATE", avg(price) AS avg_price FROM spine JOIN names USING ("DGUID") GROUP BY 1, 2),
a AS (SELECT province, yr, avg(annual_price) AS v FROM annual JOIN names USING (dguid) GROUP BY 1, 2)
SELECT p.province, p."REF_DATE", {r('avg_price')} AS avg_price, {r('v / 12.0', 2)} AS avg_annual_price
FROM p LEFT JOIN a ON p.province = a.province AND substr(p."REF_DATE", 1, 4) = a.yr"""


def net_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = order_facts(spark, sf_dir)
    moves, arrivals = _flows(facts)
    features = [Feature(moves, ["in_migrants", "out_migrants"]), Feature(arrivals, ["arrivals"])]
    joined = build_panel(_named(facts).select("DGUID", "REF_DATE"), features)
    return joined.select("DGUID", "REF_DATE", net("in_migrants", "arrivals", "out_migrants").alias("immigrants"))


_NET_FLOW = f"""WITH {SPINE}, {_FLOWS}
SELECT s."DGUID", s."REF_DATE", in_migrants + arrivals - out_migrants AS immigrants
FROM spine s LEFT JOIN moves m ON s."DGUID" = m.dguid AND s."REF_DATE" = m.ym"""


#: Orders that come after the panel was written: pending ones of one year, and the last months.
_LATE = "(o_orderstatus = 'P' AND o_orderdate >= '1996-01-01' AND o_orderdate < '1997-01-01') OR o_orderdate >= '2001-05-01'"


def refreshed_panel(spark: SparkSession, sf_dir: str, path: str) -> Refresh:
    """A panel written from the orders that are there in time, then refreshed when the late ones have come."""

    def sources(facts: DataFrame) -> dict[str, DataFrame]:
        return {"housing": _spine(spark, sf_dir, facts), "annual": _annual_total(facts)}

    def build(tables: Mapping[str, DataFrame]) -> DataFrame:
        annual = Feature(tables["annual"], ["annual_price"], grain="year", annual=["annual_price"], duplicates="unique")
        return tidy(build_panel(tables["housing"], [annual]))

    refresh_panel(path, sources(order_facts(spark, sf_dir, f"NOT ({_LATE})")), build)
    return refresh_panel(path, sources(order_facts(spark, sf_dir)), build)


def panel_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The refreshed panel, each row with what the refresh did to it."""
    path = scratch_path(spark, "panel")
    changes = refreshed_panel(spark, sf_dir, path).changes
    return read_panel(spark, path).drop("panel_year").join(changes, ["DGUID", "REF_DATE"], "left").withColumn(
        "change", F.coalesce("change", F.lit("none"))
    )


_PANEL_REFRESH = f"""WITH whole AS ({_PANEL_MIN}),
seen AS (
  SELECT c_nationkey AS dguid, strftime(o_orderdate, '%Y-%m') AS ym, bool_or(NOT ({_LATE})) AS early, bool_or({_LATE}) AS late
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
SELECT w.*, CASE WHEN NOT s.early THEN 'new'
  WHEN bool_or(s.late) OVER (PARTITION BY s.dguid, substr(s.ym, 1, 4)) THEN 'changed' ELSE 'none' END AS change
FROM whole w JOIN seen s ON w."DGUID" = s.dguid AND w."REF_DATE" = s.ym"""


QUERIES = {
    "panel_min": (panel_min, _PANEL_MIN),
    "panel_full": (panel_full, _PANEL_FULL),
    "panel_bucketed": (panel_bucketed, _PANEL_FULL),
    "panel_observed": (
        panel_observed,
        f"""SELECT count(*) AS n_rows, count(*) FILTER (annual_price IS NULL) AS n_without_target,
  min("REF_DATE") AS first_period, max("REF_DATE") AS last_period FROM ({_PANEL_MIN})""",
    ),
    "panel_by_name": (panel_by_name, _PANEL_BY_NAME),
    "panel_count": (panel_count, f"SELECT count(*) AS n_rows FROM ({_PANEL_MIN})"),
    "panel_roundtrip": (panel_roundtrip, _PANEL_MIN),
    "panel_refresh": (panel_refresh, _PANEL_REFRESH),
    "panel_numbers": (panel_numbers, f'SELECT "DGUID", "REF_DATE", price, annual_price FROM ({_PANEL_MIN})'),
    "net_flow": (net_flow, _NET_FLOW),
}
