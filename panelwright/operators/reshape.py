"""Long to wide, group means and distinct keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return f"`{name}`"


def all_not_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(quoted(c)).isNotNull() for c in columns])


def pivot_mean(
    long: DataFrame, keys: Sequence[str], column: str, names: Mapping[str, str], value: str = "VALUE"
) -> DataFrame:
    """One row per key with the mean of ``value`` per category, under the name given for the category.

    Rows with a NULL key, a NULL value or another category are left out first,
    so a key whose values are all missing does not appear.  One conditional
    mean per category keeps this at a single shuffle with map-side
    aggregation; ``groupBy().pivot()`` takes two.
    """
    kept = long.where(all_not_null([*keys, value]) & F.col(quoted(column)).isin(list(names)))
    means = [
        F.avg(F.when(F.col(quoted(column)) == F.lit(category), F.col(quoted(value)))).alias(name)
        for category, name in names.items()
    ]
    return kept.groupBy(*[quoted(k) for k in keys]).agg(*means)


def group_mean(df: DataFrame, keys: Sequence[str | Column], columns: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Mean of each column per key (a key may be an expression); a mapping renames the results."""
    names = columns if isinstance(columns, Mapping) else {c: c for c in columns}
    grouping = [k if isinstance(k, Column) else F.col(quoted(k)) for k in keys]
    return df.groupBy(*grouping).agg(*[F.avg(quoted(c)).alias(name) for c, name in names.items()])


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct combinations of the columns (all of them by default)."""
    return (df.select(*[quoted(c) for c in columns]) if columns else df).distinct()


def with_tags(df: DataFrame, **tags: str) -> DataFrame:
    """Constant text columns such as the unit of a feature."""
    return df.withColumns({name: F.lit(text) for name, text in tags.items()})


def keep_all_equal(df: DataFrame, **values: object) -> DataFrame:
    """Rows in which every named column equals its value."""
    return df.where(reduce(lambda a, b: a & b, [F.col(quoted(c)) == F.lit(v) for c, v in values.items()]))


def keep_in(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    return df.where(F.col(quoted(column)).isin(list(values)))


def keep_not_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.dropna(subset=list(columns))
