"""Distinct counts from stored sketches, which add up over months, regions and units."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.operators.reshape import quoted

#: Base-2 logarithm of a sketch's cells; 14 gives a relative standard error of about 0.8 per cent in up to 16 KB.
PRECISION = 14


def sketch_table(df: DataFrame, groups: Sequence[str], columns: Sequence[str], precision: int = PRECISION) -> DataFrame:
    """The groups with ``sketch_<column>`` of the distinct values of each column, NULLs left out.

    Tasks build their own sketches first, so a group of any size shuffles one
    sketch per task.  Values are told apart by their text.
    """
    built = [F.hll_sketch_agg(F.col(quoted(c)).cast("string"), precision).alias(f"sketch_{c}") for c in columns]
    return df.groupBy(*[quoted(g) for g in groups]).agg(*built)


def merged_sketches(sketches: DataFrame, groups: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The sketches of coarser groups, or of two tables under one another: the union of the values, not the sum of the counts."""
    united = [F.hll_union_agg(quoted(f"sketch_{c}")).alias(f"sketch_{c}") for c in columns]
    return sketches.groupBy(*[quoted(g) for g in groups]).agg(*united)


def sketched_counts(sketches: DataFrame, groups: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``distinct_<column>`` per group, estimated from the union of its sketches."""
    counts = [F.hll_sketch_estimate(quoted(f"sketch_{c}")).alias(f"distinct_{c}") for c in columns]
    return merged_sketches(sketches, groups, columns).select(*[quoted(g) for g in groups], *counts)
