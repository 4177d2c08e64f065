"""Sources and sinks: benchmark tables written in the form of a source and scanned back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.registry.support import derived, r, read, tidy
from panelwright.session import landed, scratch_path, settings
from panelwright.sources import files, sinks
from panelwright.sources.schemas import RATE_VALUES
from panelwright.sources.zipped import scan_archives


def rates_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A daily series of twelve columns, one of them with gaps, as headed CSV files."""
    days = read(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(
        *[F.max(F.col("o_custkey") * (i + 1)).alias(name) for i, name in enumerate(RATE_VALUES)]
    )
    gap = F.when(F.dayofmonth("date") != 1, F.col(f"`{RATE_VALUES[0]}`"))
    path = scratch_path(spark, "rates")
    days.withColumn(RATE_VALUES[0], gap).write.option("header", True).csv(path)
    return files.daily_rates(spark, path)


_RATES = "SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, " + ", ".join(
    f"{f'CASE WHEN day(any_value(o_orderdate)) <> 1 THEN max(o_custkey * {i + 1}) END' if i == 0 else f'max(o_custkey * {i + 1})'}::DOUBLE AS \"{name}\""
    for i, name in enumerate(RATE_VALUES)
) + " FROM orders GROUP BY 1"


def code_set_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalogue of codes, one JSON object, made of the nations (a table of fixed size)."""
    nations = read(spark, sf_dir, "nation")
    code = F.struct(
        F.col("n_nationkey").alias("memberUomCode"), F.col("n_name").alias("memberUomEn"),
        F.when(F.col("n_nationkey") % 2 == 0, F.lower("n_name")).alias("memberUomFr"),
    )
    path = scratch_path(spark, "codes")
    nations.agg(F.struct(F.collect_list(code).alias("uom")).alias("object")).write.json(path)
    return files.code_set(spark, path, "uom")


_CODES = """SELECT n_nationkey AS "memberUomCode", n_name AS "memberUomEn",
  CASE WHEN n_nationkey % 2 = 0 THEN lower(n_name) END AS "memberUomFr" FROM nation"""


def predictions_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions written by the sink and read again as texts and numbers."""
    rows = read(spark, sf_dir, "part").select("p_partkey", "p_name", F.nullif("p_size", F.lit(7)).alias("prediction"))
    path = scratch_path(spark, "predictions")
    sinks.write_predictions(rows, path)
    found = spark.read.option("header", True).csv(path)
    return tidy(found.select(F.col("p_partkey").cast("long").alias("p_partkey"), "p_name", F.col("prediction").cast("int").alias("prediction")))


def zip_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders as zipped CSV files, and some columns of the finished ones scanned back."""
    path = scratch_path(spark, "zipped")
    sinks.write_zipped(read(spark, sf_dir, "orders").repartition(4), path)
    with settings(spark, spark__sql__python__filterPushdown__enabled="true"):
        rows = scan_archives(spark, path, ["o_orderkey", "o_totalprice", "o_orderstatus", "not_there"]).where("o_orderstatus = 'F'")
        found = rows.select(
            F.col("o_orderkey").cast("long").alias("o_orderkey"), F.col("o_totalprice").cast("double").alias("o_totalprice"), "not_there"
        )
        return tidy(landed(found, "scanned"))


_ZIP = f"""SELECT o_orderkey, {r('o_totalprice')} AS o_totalprice, NULL::VARCHAR AS not_there
FROM orders WHERE o_orderstatus = 'F'"""

# per nation: a preamble, a header, a month per line with prices, one with a text for a number, one cut off, one of garbage
_STATION_LINES = """
SELECT n_name AS name, concat_ws('\n', '"Station","' || n_name || '"', 'REF_DATE,Year,Month,rest', '',
  array_join(transform(array_sort(collect_list(struct(month, price, n))), m ->
    m.month || ',' || substr(m.month, 1, 4) || ',' || substr(m.month, 6, 2) || ',' ||
    CASE WHEN m.n % 5 = 0 THEN 'n/a' WHEN m.n % 5 = 1 THEN '' ELSE cast(m.price AS string) END || ',' ||
    CASE WHEN m.n % 5 = 1 THEN 'M' ELSE '' END || CASE WHEN m.n % 7 = 0 THEN '' ELSE repeat(',', 20) END), '\n'),
  'garbage ' || n_name) AS content
FROM (SELECT replace(n_name, '_', ' ') AS n_name, date_format(o_orderdate, 'yyyy-MM') AS month, cast(round(min(o_totalprice)) AS long) AS price, count(*) AS n
      FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey GROUP BY 1, 2)
GROUP BY n_name"""


def weather_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station files of the nations scanned into typed rows and reasons, both in one result."""
    path = scratch_path(spark, "stations")
    texts = derived(spark, sf_dir, _STATION_LINES)
    sinks.write_texts(texts.withColumn("name", F.concat("name", F.lit("_weather.csv"))), path)
    rows, wrong = files.weather_lines(spark, path)
    typed = rows.select("GEO", F.col("REF_DATE").alias("text"), F.col("Mean_Max_Temp").alias("value"), F.lit(None).cast("string").alias("reason"))
    bad = wrong.select("GEO", F.when(F.col("kept"), F.substring("line", 1, 7)).otherwise(F.col("line")).alias("text"),
                       F.lit(None).cast("double").alias("value"), "reason")
    return typed.unionByName(bad)


_WEATHER = """WITH m AS (
  SELECT replace(n_name, '_', ' ') AS "GEO", strftime(o_orderdate, '%Y-%m') AS month, round(min(o_totalprice))::BIGINT AS price, count(*) AS n
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)
SELECT "GEO", month AS text, CASE WHEN n % 5 > 1 THEN price END::DOUBLE AS value, NULL::VARCHAR AS reason FROM m
UNION ALL SELECT "GEO", month, NULL, CASE WHEN n % 7 = 0 THEN 'fields' ELSE 'no number' END FROM m WHERE n % 7 = 0 OR n % 5 = 0
UNION ALL SELECT DISTINCT "GEO", unnest(['"Station","' || "GEO" || '"', 'REF_DATE,Year,Month,rest', 'garbage ' || "GEO"]), NULL, 'no month' FROM m"""


QUERIES = {
    "zip_scan": (zip_scan, _ZIP),
    "weather_scan": (weather_scan, _WEATHER),
    "rates_scan": (rates_scan, _RATES),
    "code_set_scan": (code_set_scan, _CODES),
    "predictions_scan": (predictions_scan, "SELECT p_partkey, p_name, nullif(p_size, 7) AS prediction FROM part"),
}
