"""Reading the corpus tables, and words as the corpus operators take them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelwright.session import landed

#: A word: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def crc_mod(column: str, n: int) -> Column:
    """crc32 of the id's decimal text, modulo n."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def running(df: DataFrame, order: list[Column], sums: dict[str, str]) -> DataFrame:
    """Ranks and running sums over a total order, without one task that holds all rows.

    ``place`` is the rank from 0; ``sums`` maps a new column to the long column
    whose sum over all *earlier* rows it holds.  Rows are cut into ranges of the
    order; the sums of the ranges (one row each) are accumulated first.
    """
    ranged = landed(
        df.repartitionByRange(shuffle_width(df.sparkSession), *order).withColumn("_range", F.spark_partition_id()), "ranged"
    )
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    adds = {"place": F.lit(1), **{name: F.col(column) for name, column in sums.items()}}
    totals = ranged.groupBy("_range").agg(*[F.sum(c).alias(f"_{name}") for name, c in adds.items()])
    offsets = totals.select("_range", *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}") for n in adds])
    return (
        ranged.withColumns({n: F.coalesce(F.sum(c).over(inside), F.lit(0)) for n, c in adds.items()})
        .join(offsets, "_range")
        .withColumns({n: F.col(n) + F.col(f"_{n}") for n in adds})
        .drop("_range", *[f"_{n}" for n in adds])
    )
