"""Normal equations that add up: moments per group, from which ridge regressions of any training cut are solved."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from panelwright.operators.reshape import quoted


def monomials(n: int, degree: int) -> list[tuple[int, ...]]:
    """The products of ``n`` columns up to a degree, as column positions; (0, 0, 2) is x0 * x0 * x2."""
    return [c for d in range(1, degree + 1) for c in combinations_with_replacement(range(n), d)]


@dataclass(frozen=True)
class Moments:
    """Sums of products of 1, the monomials of the columns and the target, per group.

    ``table`` has the columns ``by``, then ``cell`` (a place in the upper triangle
    of the matrix of products, row by row) and ``value``.  It grows with the
    groups, not with the rows, and two tables of disjoint rows add up: see
    :func:`merged`.
    """

    table: DataFrame
    by: Sequence[str]
    columns: Sequence[str]
    degree: int

    @property
    def width(self) -> int:
        return len(monomials(len(self.columns), self.degree)) + 2


def moments(df: DataFrame, columns: Sequence[str], target: str, by: Sequence[str], degree: int = 1) -> Moments:
    """One pass over the rows without a NULL in any column or the target.

    A task multiplies the rows of a group in an Arrow batch by each other as
    matrices and adds the groups' products up before the shuffle, so a hot
    group sends one row per task and cell.  Choose groups that hold many rows
    each (regions and years, not days).  Columns should be of size one or so;
    products of large numbers lose digits.
    """
    products = monomials(len(columns), degree)
    upper = np.triu_indices(len(products) + 2)
    kept = df.select(
        *[F.col(quoted(c)) for c in by],
        *[F.col(quoted(c)).cast("double").alias(f"_x{i}") for i, c in enumerate(columns)],
        F.col(quoted(target)).cast("double").alias("_y"),
    ).dropna(subset=[*[f"_x{i}" for i in range(len(columns))], "_y"])
    fields = [kept.schema[c] for c in by]
    schema = StructType([*fields, StructField("cell", IntegerType()), StructField("value", DoubleType())])
    names = list(by)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch.to_pandas()
            x = [rows[f"_x{i}"].to_numpy() for i in range(len(columns))]
            parts = [np.ones(len(rows)), *[np.prod([x[i] for i in p], axis=0) for p in products], rows["_y"].to_numpy()]
            z = np.stack(parts, 1)
            groups = rows.groupby(names, dropna=False, sort=False).indices if names else {(): np.arange(len(rows))}
            first = np.array([g[0] for g in groups.values()])
            values = np.concatenate([(z[g].T @ z[g])[upper] for g in groups.values()])
            cells = len(upper[0])
            keys = batch.select(names).take(pa.array(np.repeat(first, cells)))
            yield pa.RecordBatch.from_arrays(
                [*keys.columns, pa.array(np.tile(np.arange(cells, dtype=np.int32), len(first))), pa.array(values)], schema.names
            )

    table = kept.mapInArrow(run, schema).groupBy(*[quoted(c) for c in by], "cell").agg(F.sum("value").alias("value"))
    return Moments(table, tuple(by), tuple(columns), degree)


def merged(a: Moments, b: Moments) -> Moments:
    """The moments of the rows of both, say of all months so far and of a new one."""
    if (a.by, a.columns, a.degree) != (b.by, b.columns, b.degree):
        raise ValueError("moments of different columns, groups or degrees do not add up")
    both = a.table.unionByName(b.table)
    return Moments(both.groupBy(*[quoted(c) for c in a.by], "cell").agg(F.sum("value").alias("value")), a.by, a.columns, a.degree)


def solved(gram: np.ndarray, alpha: float) -> tuple[float, np.ndarray]:
    """(intercept, weights) of the ridge regression whose products are ``gram``; the intercept is not penalised."""
    n = gram[0, 0]
    mean = gram[0, 1:] / n
    spread = gram[1:, 1:] - n * np.outer(mean, mean)
    system = spread[:-1, :-1] + alpha * np.eye(len(spread) - 1)
    weights, *_ = np.linalg.lstsq(system, spread[:-1, -1], rcond=None)
    return float(mean[-1] - mean[:-1] @ weights), weights


def rolling_ridge(sums: Moments, period: str, alpha: float) -> DataFrame:
    """cut, n, intercept and weights: the regression on all rows before each period that has rows before it.

    ``period`` is one of the columns of ``by``.  The sums of earlier periods are
    running sums over the table, so the rows themselves are not read again,
    however many cuts there are.  A cut is solved where its cells meet: their number
    is fixed by the columns and the degree.
    """
    width = sums.width
    upper = np.triu_indices(width)
    per_period = sums.table.groupBy(F.col(quoted(period)).alias("cut"), "cell").agg(F.sum("value").alias("value"))
    earlier = Window.partitionBy("cell").orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)
    before = per_period.withColumn("value", F.sum("value").over(earlier)).where("value IS NOT NULL")

    def solve(cut: pd.DataFrame) -> pd.DataFrame:
        gram = np.zeros((width, width))
        gram[upper] = cut.sort_values("cell")["value"].to_numpy()
        gram = gram + np.triu(gram, 1).T
        intercept, weights = solved(gram, alpha)
        return pd.DataFrame({"cut": [cut["cut"].iloc[0]], "n": [round(gram[0, 0])], "intercept": [intercept], "weights": [weights]})

    schema = f"cut {dict(before.dtypes)['cut']}, n long, intercept double, weights array<double>"
    return before.groupBy("cut").applyInPandas(solve, schema)


def fitted_value(columns: Sequence[str], degree: int, intercept: str = "intercept", weights: str = "weights") -> Column:
    """The value of a regression at a row, in the row's own columns."""
    x = [F.col(quoted(c)).cast("double") for c in columns]
    total = F.col(intercept)
    for k, places in enumerate(monomials(len(columns), degree)):
        product = x[places[0]]
        for i in places[1:]:
            product = product * x[i]
        total = total + F.element_at(F.col(weights), k + 1) * product
    return total


def rolling_forecast(df: DataFrame, models: DataFrame, sums: Moments, period: str) -> DataFrame:
    """Every row with ``prediction`` of the regression on the periods before its own; rows of the first one have none.

    The models are one row per period.
    """
    at = df.join(models.withColumnRenamed("cut", "_cut"), F.col(quoted(period)) == F.col("_cut"), "left")
    return at.withColumn("prediction", fitted_value(sums.columns, sums.degree)).drop("_cut", "n", "intercept", "weights")
