"""Reading the benchmark tables, and what queries and their SQL share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType

from panelwright.functions.numbers import round_half_up
from panelwright.operators.reshape import quoted

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "pages", "orders_by_month"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def tidy(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles rounded and decimals turned into doubles, for comparison across engines."""
    casts = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, DoubleType):
            casts[f.name] = round_half_up(quoted(f.name), digits)
        elif isinstance(f.dataType, DecimalType):
            casts[f.name] = F.col(quoted(f.name)).cast("double")
    return df.withColumns(casts)


def r(expression: str, digits: int = 4) -> str:
    """The rounding of :func:`tidy` in SQL."""
    return f"round(cast({expression} AS DECIMAL(38,{digits + 4})), {digits})::DOUBLE"


def spread(df: DataFrame) -> DataFrame:
    """The rows of a scan, dealt to as many tasks as a shuffle has, where it has fewer.

    For work that takes long by row: a file of narrow rows is few splits, however many rows it holds.
    """
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df if df.rdd.getNumPartitions() >= width else df.repartition(width)


def derived(spark: SparkSession, sf_dir: str, text: str, long_by_row: bool = False) -> DataFrame:
    """An input table derived from the benchmark tables by a SQL text that both engines accept.

    Tables are written ``{orders}`` in the text.  With ``long_by_row`` their rows are spread before.
    """
    used = {t: read(spark, sf_dir, t) for t in TABLES if f"{{{t}}}" in text}
    return spark.sql(text, **{t: spread(df) if long_by_row else df for t, df in used.items()})


def plain(text: str) -> str:
    """The text with bare table names."""
    for t in TABLES:
        text = text.replace(f"{{{t}}}", t)
    return text


def spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GEO, DGUID, REF_DATE and mean order price per nation and month.

    Rows are grouped by nation key and month before the names are looked up,
    so the shuffle after the join carries two short keys.
    """
    orders = read(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    monthly = (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", F.trunc("o_orderdate", "month").alias("month"))
        .agg(F.avg("o_totalprice").alias("price"))
    )
    nations = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return monthly.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("GEO"),
        F.col("n_nationkey").alias("DGUID"),
        F.date_format("month", "yyyy-MM").alias("REF_DATE"),
        "price",
    )


SPINE = """spine AS (
  SELECT n_name AS "GEO", n_nationkey AS "DGUID", strftime(o_orderdate, '%Y-%m') AS "REF_DATE",
         avg(o_totalprice) AS price
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2, 3)"""
