"""Largest and smallest rows of groups, group summaries, averages of averages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions.numbers import round_half_up
from panelwright.operators.reshape import all_not_null, quoted
from panelwright.session import landed


def summary(df: DataFrame, group: str, value: str, measures: Sequence[str] = ("max", "min", "avg")) -> DataFrame:
    """``maxprice``-style summary columns ``max_<value>``, ... per group."""
    functions = {"max": F.max, "min": F.min, "avg": F.avg}
    return df.groupBy(quoted(group)).agg(
        *[functions[m](quoted(value)).alias(f"{m}_{value}") for m in measures]
    )


def _best_first(value: str, how: str) -> Column:
    if how not in ("max", "min"):
        raise ValueError(f"how must be max or min, not {how}")
    return F.col(quoted(value)).desc_nulls_last() if how == "max" else F.col(quoted(value)).asc_nulls_last()


def extremes(df: DataFrame, group: str, value: str, how: str = "max", spread: int = 64) -> DataFrame:
    """All rows that hold the extreme value of their group, ties included.

    Filtering on ``rank() = 1`` lets Spark drop every row that is not the best
    of its task before the shuffle.  The rank is taken per group and slice of
    the input tasks, so the ties of a hot group (or many copies of one row)
    do not meet in one task; the extreme of the whole group, an aggregation
    of two columns, then picks among the winners of the slices.  ``spread``
    only says into how many tasks the ties of one group go.
    """
    order = _best_first(value, how)
    known = df.where(all_not_null([value]))
    slices = known.withColumn("_slice", F.spark_partition_id() % F.lit(spread))
    rank = F.rank().over(Window.partitionBy(quoted(group), "_slice").orderBy(order))
    winners = slices.withColumn("_rank", rank).where("_rank = 1").drop("_rank", "_slice")
    best = (F.max if how == "max" else F.min)(quoted(value))
    per_group = known.groupBy(F.col(quoted(group)).alias("_group")).agg(best.alias("_best"))
    same = F.col(quoted(group)).eqNullSafe(F.col("_group")) & (F.col(quoted(value)) == F.col("_best"))
    return winners.join(per_group, same, "inner").drop("_group", "_best")


def extremes_by_value(df: DataFrame, group: str, value: str, how: str = "max") -> DataFrame:
    """Rows whose value equals the extreme of *any* group, each once.

    The column ``<how>_<value>`` repeats the value, and ``<how>_groups`` counts
    the groups that have it as their extreme.  The extremes, one row per group,
    are written once: the range they span is filtered first, which takes nearly
    all rows out before the join.
    """
    name, groups = f"{how}_{value}", f"{how}_groups"
    per_group = df.where(all_not_null([value])).groupBy(quoted(group)).agg(
        (F.max if how == "max" else F.min)(quoted(value)).alias("_extreme")
    )
    per_value = landed(per_group.groupBy("_extreme").agg(F.count(F.lit(1)).alias(groups)), "extremes")
    bound = per_value.agg((F.min if how == "max" else F.max)("_extreme")).scalar()
    candidates = df.where(F.col(quoted(value)) >= bound if how == "max" else F.col(quoted(value)) <= bound)
    return (
        candidates.join(per_value, F.col(quoted(value)) == F.col("_extreme"), "inner")
        .withColumnRenamed("_extreme", name)
    )


def top_member(
    df: DataFrame, group: str, member: str, value: str, extra: Sequence[str] = (), name: str = "maxprice",
    digits: int = 8, by_value_only: bool = False,
) -> DataFrame:
    """Members (say localities) with the largest average value among those seen in their group (say province).

    The average is taken over all rows of the member, in whatever group, and
    rounded to ``digits``, so that equal averages tie however their sums were
    added.  Returns the distinct (group, member, extra columns, average) of the
    winners.  ``by_value_only`` also returns members whose average happens to be
    the largest of another group.  The rows are read once and summed per place first.
    """
    v = F.col(quoted(value)).cast("double")
    known = df.where(all_not_null([member]))
    places = known.groupBy(*[quoted(c) for c in [group, member, *extra]]).agg(F.sum(v).alias("_sum"), F.count(v).alias("_n"))
    average = round_half_up(F.try_divide(F.sum("_sum"), F.sum("_n")), digits)
    members = places.groupBy(quoted(member)).agg(average.alias(name)).where(F.col(name).isNotNull())
    found = places.drop("_sum", "_n").join(members, member)
    best = found.groupBy(F.col(quoted(group)).alias("_group")).agg(F.max(name).alias("_best"))
    same = F.col(name) == F.col("_best")
    if not by_value_only:
        same = F.col(quoted(group)).eqNullSafe(F.col("_group")) & same
    return found.join(best, same, "left_semi")


def pearson(x: Column, y: Column) -> Column:
    """Aggregate: Pearson r over the rows in which both are present; NULL if one of them is constant.

    (``corr`` raises an error for a constant column in ANSI mode.)
    """
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def correlation(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row: Pearson r and its square over the rows in which both values are present."""
    r = df.agg(pearson(F.col(quoted(x)).cast("double"), F.col(quoted(y)).cast("double")).alias("r"))
    return r.withColumn("r_squared", F.col("r") * F.col("r"))


def moments(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row of sums: x, y, rows, squares and products, over complete pairs."""
    a, b = F.col(quoted(x)).cast("double"), F.col(quoted(y)).cast("double")
    return df.where(all_not_null([x, y])).agg(
        F.sum(a).alias("sum_x"), F.sum(b).alias("sum_y"), F.count(F.lit(1)).alias("n"),
        F.sum(a * a).alias("sum_x2"), F.sum(b * b).alias("sum_y2"), F.sum(a * b).alias("sum_xy"),
    )


def correlation_of_moments(sums: DataFrame) -> DataFrame:
    """Pearson r and its square from the row of :func:`moments`."""
    n, sx, sy = F.col("n"), F.col("sum_x"), F.col("sum_y")
    spread = F.sqrt(n * F.col("sum_x2") - F.pow(sx, F.lit(2))) * F.sqrt(n * F.col("sum_y2") - F.pow(sy, F.lit(2)))
    r = sums.select(F.try_divide(n * F.col("sum_xy") - sx * sy, spread).alias("r"))
    return r.withColumn("r_squared", F.col("r") * F.col("r"))


def distinct_count(
    df: DataFrame, groups: Sequence[str], columns: Sequence[str], approximate: bool = False
) -> DataFrame:
    """Number of distinct values of each column per group, as ``distinct_<column>``.

    The exact count first groups by (group, value), so a hot group is spread
    over its values; ``approximate`` trades exactness for one small sketch per group.
    """
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.groupBy(*[quoted(g) for g in groups]).agg(
        *[count(F.col(quoted(c))).alias(f"distinct_{c}") for c in columns]
    )


def first_rows(df: DataFrame, order: Sequence[Column | str], n: int = 20) -> DataFrame:
    """The first ``n`` rows in an order (a top-n per task and one merge, no full sort)."""
    return df.orderBy(*order).limit(n)
