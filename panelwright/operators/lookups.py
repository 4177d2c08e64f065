"""Dimension lookups.

No join hints: Spark broadcasts a dimension by itself where its files (or, at
run time, its shuffled size) are below ``spark.sql.autoBroadcastJoinThreshold``
and otherwise sorts and merges, splitting skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.operators.reshape import all_not_null, quoted


def code_lookup(df: DataFrame, code: str, codes: DataFrame, key: str, text: str, name: str) -> DataFrame:
    """Add the text of a code as ``name``; rows without a known code drop out.

    The code may be text and the key an integer, or the other way round.
    """
    side = codes.select(F.col(quoted(key)).try_cast("bigint").alias("_code"), F.col(quoted(text)).alias(name))
    keyed = df.withColumn("_code", F.col(quoted(code)).try_cast("bigint"))
    return keyed.join(side, "_code", "inner").drop("_code")


def region_ids(long: DataFrame, label: str = "GEO", region: str = "DGUID", value: str = "VALUE") -> DataFrame:
    """Distinct (label, id) pairs of a statistics table that carry a value in some period."""
    kept = long.where(all_not_null([label, region, value, "REF_DATE"]))
    return kept.select(quoted(label), quoted(region)).distinct()


def name_to_id(df: DataFrame, ids: DataFrame, label: str = "GEO") -> DataFrame:
    """Add the ids of the labels; rows with an unknown label drop out."""
    return df.join(ids, label, "inner")


def detail_and_average(detail: DataFrame, averages: DataFrame, keys: list[str], keep_duplicates: bool = False) -> DataFrame:
    """Detail rows followed by group averages under their own labels.

    An average whose key the detail already holds is left out, else it would
    multiply rows in a later join; ``keep_duplicates`` keeps it.
    """
    if not keep_duplicates:
        averages = averages.join(detail.select(*keys).distinct(), keys, "left_anti")
    return detail.unionByName(averages)
