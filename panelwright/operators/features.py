"""Filling, encoding, scaling, splitting and look-back windows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from panelwright.operators.reshape import quoted
from panelwright.session import landed


def fill_constant(df: DataFrame, **values: object) -> DataFrame:
    return df.fillna(values)


def fill_mean(df: DataFrame, *columns: str) -> DataFrame:
    """NULLs of each column replaced by its mean over all rows (one scalar subquery, no join)."""
    means = df.agg(F.struct(*[F.avg(quoted(c)).alias(c) for c in columns])).scalar()
    filled = {c: F.coalesce(F.col(quoted(c)), F.col("_means")[c]) for c in columns}
    return df.withColumn("_means", means).withColumns(filled).drop("_means")


def levels_of(df: DataFrame, column: str) -> list[str]:
    """The distinct values of a column, in order.  They come to the driver: for columns that become names of columns."""
    rows = df.select(F.col(quoted(column)).alias("level")).dropna().distinct().orderBy("level").collect()
    return [r["level"] for r in rows]


def level_ranks(df: DataFrame, column: str) -> DataFrame:
    """_level and _rank: the distinct values of a column numbered from 0 in their order, however many; landed.

    Levels are sorted in ranges; the ranges' sizes, one row each, are added up
    for the number at which a range begins.
    """
    levels = df.select(F.col(quoted(column)).alias("_level")).dropna().distinct()
    ranged = landed(levels.repartitionByRange("_level").withColumn("_range", F.spark_partition_id()), "levels")
    before = F.sum("_levels").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_levels"))
    # one row for each partition of the shuffle
    starts = F.broadcast(sizes.select("_range", F.coalesce(before, F.lit(0)).alias("_start")))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy("_level"))
    return landed(ranged.join(starts, "_range").select("_level", (F.col("_start") + inside - 1).alias("_rank")), "ranks")


def one_hot_vector(df: DataFrame, column: str, name: str) -> DataFrame:
    """A sparse 0/1 vector over all levels of a column, however many, in the order of the levels; NULL has no 1.

    Levels stay in tables: only their number comes to the driver.
    """
    ranks = level_ranks(df, column)
    levels = ranks.count()
    found = df.join(ranks, F.col(quoted(column)) == F.col("_level"), "left").drop("_level")
    # NULL takes the index after the last level, which has no position of its own
    sizes = {"ml_attr": {"type": "nominal", "num_vals": levels + 1}}
    coded = found.withColumn("_index", F.coalesce("_rank", F.lit(levels)).cast("double").alias("_index", metadata=sizes)).drop("_rank")
    return OneHotEncoder(inputCol="_index", outputCol=name, dropLast=True).fit(coded).transform(coded).drop("_index")


def sparse_parts(df: DataFrame, vector: str) -> DataFrame:
    """The table with the size and the indices of a sparse vector column in its place, which never becomes an array of its size."""
    kept = [f for f in df.schema.fields if f.name != vector]
    schema = StructType([*kept, StructField("size", IntegerType()), StructField("indices", ArrayType(IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column(vector)
            columns = [batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, parts.field("size"), parts.field("indices")], schema.names)

    return df.select(*[quoted(f.name) for f in kept], quoted(vector)).mapInArrow(run, schema)


def one_hot(df: DataFrame, column: str, prefix: str, levels: Sequence[str]) -> DataFrame:
    """A 0/1 column ``<prefix>_<level>`` per named level of a column; for any number of levels see :func:`one_hot_vector`."""
    return df.withColumns({
        f"{prefix}_{level}": F.coalesce((F.col(quoted(column)) == F.lit(level)).cast("int"), F.lit(0))
        for level in levels
    })


def fitted_lines(df: DataFrame, group: str, x: str, columns: Sequence[str]) -> DataFrame:
    """One row per group with slope and means of each column over x, over the rows that have a value; landed."""
    at = f"cast({quoted(x)} AS double)"
    stats = []
    for i, c in enumerate(columns):
        y = f"cast({quoted(c)} AS double)"
        stats += [
            F.expr(f"regr_slope({y}, {at}) AS _slope{i}"),
            F.expr(f"avg({y}) AS _mean{i}"),
            F.expr(f"avg(CASE WHEN {y} IS NOT NULL THEN {at} END) AS _middle{i}"),
        ]
    return landed(df.groupBy(F.col(quoted(group)).alias("_group")).agg(*stats), "lines")


def filled_by_lines(df: DataFrame, lines: DataFrame, group: str, x: str, columns: Sequence[str]) -> DataFrame:
    """NULLs of each column replaced by the value of the group's line, its mean, or 0; the lines are :func:`fitted_lines`."""
    at = f"cast({quoted(x)} AS double)"
    joined = df.join(lines, F.col(quoted(group)).eqNullSafe(F.col("_group")), "left")
    # a NULL slope (values at one x only) leaves the mean
    filled = {
        c: F.expr(f"coalesce(cast({quoted(c)} AS double), _mean{i} + _slope{i} * ({at} - _middle{i}), _mean{i}, 0.0D)")
        for i, c in enumerate(columns)
    }
    return joined.withColumns(filled).select(*[quoted(c) for c in df.columns])


def impute_regression(df: DataFrame, group: str, x: str, columns: Sequence[str]) -> DataFrame:
    """NULLs of each column replaced by a line fitted on x per group, over the rows that have a value.

    A group with values at one x only gets their mean, a group without any
    gets 0.  All lines come from one aggregation with one row per group, written
    to the shared folder: its size is known then, and below the threshold Spark
    broadcasts it, so that the wide rows are not shuffled.
    """
    return filled_by_lines(df, fitted_lines(df, group, x, columns), group, x, columns)


def min_max(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Columns scaled to [0, 1]; a constant column becomes 0.

    Ranges are taken over all rows, or over ``fit_on`` to keep held-out rows out of them.
    """
    source = df if fit_on is None else fit_on
    ranges = source.agg(F.struct(*[
        F.struct(F.min(quoted(c)).alias("lo"), F.max(quoted(c)).alias("hi")).alias(f"c{i}")
        for i, c in enumerate(columns)
    ])).scalar()

    def scaled(i: int, c: str) -> Column:
        found = F.col("_ranges")[f"c{i}"]
        lo = found["lo"].cast("double")
        width = found["hi"].cast("double") - lo
        # a NULL stays NULL, also in a constant column
        return (F.col(quoted(c)) - lo) / F.when(width == 0, F.lit(1.0)).otherwise(width)

    # one column holds all ranges, so the subquery is planned and run once
    with_ranges = df.withColumn("_ranges", ranges)
    return with_ranges.withColumns({c: scaled(i, c) for i, c in enumerate(columns)}).drop("_ranges")


def time_split(df: DataFrame, period: str, cut: str) -> tuple[DataFrame, DataFrame]:
    """Rows before a period and rows from it on."""
    return df.where(F.col(quoted(period)) < F.lit(cut)), df.where(F.col(quoted(period)) >= F.lit(cut))


def _positions(df: DataFrame, group: str, order: str, bucket: Column, name: str) -> DataFrame:
    """Add each row's position in its group, counted bucket by bucket so that no task sees a whole group.

    Buckets must follow the order and be fine enough for one task each.  Only
    the row counts of the buckets are summed over a whole group.  Counting and
    joining use the same key, so the rows are shuffled once.
    """
    # a struct is never NULL itself, so rows without a group find each other
    keyed = df.withColumn("_key", F.struct(F.col(quoted(group)).alias("group"), bucket.alias("bucket")))
    counts = keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy("_key.group").orderBy("_key.bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_key", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("_key").orderBy(quoted(order)))
    return (
        keyed.withColumn("_inside", inside)
        .join(offsets, "_key", "inner")
        .withColumn(name, F.col("_offset") + F.col("_inside") - 1)
        .drop("_key", "_offset", "_inside")
    )


def look_back(
    df: DataFrame,
    group: str,
    order: str,
    columns: Sequence[str],
    n: int,
    name: str = "history",
    bucket: Column | None = None,
    chunk: int = 100_000,
) -> DataFrame:
    """Add the ``columns`` of the previous ``n`` rows of the group as an array of structs, oldest first.

    Rows with fewer than ``n`` predecessors drop out; the row itself carries
    the target.  (group, order) must be unique, and a look-back counts rows,
    not calendar periods.

    A monthly panel holds at most one row per month and region, which bounds a
    group.  For finer data give a ``bucket`` that coarsens the order (say its
    year): groups are then cut into chunks of ``chunk`` rows, each with the
    last ``n`` rows of the chunk before, and no task gets a whole group.
    """
    row = F.struct(*[F.col(quoted(c)) for c in columns])
    if bucket is None:
        frame = Window.partitionBy(quoted(group)).orderBy(quoted(order)).rowsBetween(-n, -1)
        return df.withColumn(name, F.collect_list(row).over(frame)).where(F.size(name) == n)
    if chunk < n:
        raise ValueError("a chunk must hold at least n rows")
    placed = _positions(df, group, order, bucket, "_position")
    own = F.floor(F.col("_position") / F.lit(chunk))
    # the last n rows of a chunk are also context for the next one
    lead = F.when(F.col("_position") % F.lit(chunk) >= F.lit(chunk - n), F.array(own, own + 1)).otherwise(F.array(own))
    spread = placed.withColumn("_own", own).withColumn("_chunk", F.explode(lead))
    frame = Window.partitionBy(quoted(group), "_chunk").orderBy("_position").rowsBetween(-n, -1)
    return (
        spread.withColumn(name, F.collect_list(row).over(frame))
        .where((F.col("_chunk") == F.col("_own")) & (F.size(name) == n))
        .drop("_position", "_own", "_chunk")
    )


def lags(df: DataFrame, group: str, order: str, column: str, n: int, bucket: Column | None = None) -> DataFrame:
    """The flat form: ``<column>_lag1`` ... ``<column>_lag<n>``, rows with fewer predecessors dropped."""
    history = look_back(df, group, order, [column], n, "_history", bucket)
    return history.withColumns({
        f"{column}_lag{k}": F.get("_history", F.lit(n - k))[column] for k in range(1, n + 1)
    }).drop("_history")
