"""Feature scores, polynomial ridge regression, prediction and its errors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.operators.reshape import quoted


def f_scores(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """(position, feature, r, f_score) of the univariate regression of the target on each column.

    Taken over the rows without a NULL in any of them, in one pass: all
    correlations come from one global aggregation.  A constant column scores
    0, a perfect line scores the largest double.
    """
    complete = df.select(
        F.col(quoted(target)).cast("double").alias("y"),
        *[F.col(quoted(c)).cast("double").alias(f"x{i}") for i, c in enumerate(columns)],
    ).dropna()
    moments = complete.agg(
        F.count(F.lit(1)).alias("n"),
        F.stddev_pop("y").alias("spread"),
        *[F.covar_pop(f"x{i}", "y").alias(f"cov{i}") for i in range(len(columns))],
        *[F.stddev_pop(f"x{i}").alias(f"spread{i}") for i in range(len(columns))],
    )
    rows = moments.select("n", "spread", F.inline(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("feature"), F.col(f"cov{i}").alias("cov"),
                 F.col(f"spread{i}").alias("spread_x"))
        for i, c in enumerate(columns)
    ])))
    r = F.coalesce(F.try_divide(F.col("cov"), F.col("spread_x") * F.col("spread")), F.lit(0.0))
    scored = rows.select("position", "feature", "n", r.alias("r"))
    r2 = F.least(F.col("r") * F.col("r"), F.lit(1.0))
    largest = F.lit(1.7976931348623157e308)
    score = F.when(r2 >= 1.0, largest).otherwise(r2 / (F.lit(1.0) - r2) * (F.col("n") - 2))
    return scored.select("position", "feature", "r", score.alias("f_score"))


def best_features(df: DataFrame, columns: Sequence[str], target: str, k: int) -> DataFrame:
    """The ``k`` columns with the highest scores; of equal scores the later column wins."""
    ranked = f_scores(df, columns, target)
    return ranked.orderBy(F.desc("f_score"), F.desc("position")).limit(k)


def polynomial_ridge(
    train: DataFrame,
    columns: Sequence[str],
    target: str,
    alpha: float,
    degree: int = 1,
    k: int | None = None,
    prediction: str = "prediction",
) -> PipelineModel:
    """Fit: pick ``k`` columns, expand them to a degree, ridge regression with an unpenalised intercept.

    ``alpha`` weighs the squared coefficients against the sum of squared
    errors.  Spark minimises the mean error on a target divided by its standard
    deviation, hence the rescaled parameter.  The passes over the rows are
    distributed; the driver solves a system whose size depends on ``k`` and
    ``degree`` only.
    """
    chosen = list(columns)
    if k is not None and k < len(chosen):
        best = {r["feature"] for r in best_features(train, columns, target, k).collect()}
        chosen = [c for c in columns if c in best]
    facts = train.agg(F.count(quoted(target)).alias("n"), F.stddev_pop(quoted(target)).alias("spread")).first()
    if not facts["n"]:
        raise ValueError(f"no training row has a {target}")
    penalty = alpha / facts["n"] * facts["spread"]
    stages = [VectorAssembler(inputCols=chosen, outputCol="_inputs")]
    if degree > 1:
        stages.append(PolynomialExpansion(degree=degree, inputCol="_inputs", outputCol="_design"))
    stages.append(
        LinearRegression(
            featuresCol="_design" if degree > 1 else "_inputs",
            labelCol=target,
            predictionCol=prediction,
            regParam=penalty,
            elasticNetParam=0.0,
            standardization=False,
            solver="normal",
        )
    )
    return Pipeline(stages=stages).fit(train)


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """All rows with a prediction column."""
    return model.transform(df).drop("_inputs", "_design")


def simple_ridge(train: DataFrame, x: str, y: str, alpha: float) -> DataFrame:
    """One row (slope, intercept) of the ridge line of y on x, from one aggregation."""
    pairs = train.select(F.col(quoted(x)).cast("double").alias("x"), F.col(quoted(y)).cast("double").alias("y")).dropna()
    facts = pairs.agg(
        F.count(F.lit(1)).alias("n"), F.avg("x").alias("mx"), F.avg("y").alias("my"),
        F.var_pop("x").alias("vx"), F.covar_pop("x", "y").alias("cxy"),
    )
    line = facts.withColumn("slope", F.col("n") * F.col("cxy") / (F.col("n") * F.col("vx") + F.lit(alpha)))
    return line.select("slope", (F.col("my") - F.col("slope") * F.col("mx")).alias("intercept"))


def predict_line(line: DataFrame, df: DataFrame, x: str, name: str = "prediction") -> DataFrame:
    """All rows with the value of a one-row line, taken in as a scalar subquery."""
    fitted = line.select(F.struct("slope", "intercept")).scalar()
    line_at = F.col("_line")["intercept"] + F.col("_line")["slope"] * F.col(quoted(x))
    return df.withColumn("_line", fitted).withColumn(name, line_at).drop("_line")


def regression_errors(df: DataFrame, target: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """``n``, ``mae``, ``mse`` and ``r2`` over all rows or per group."""
    y, p = F.col(quoted(target)).cast("double"), F.col(quoted(prediction)).cast("double")
    known = df.where(y.isNotNull() & p.isNotNull())
    grouped = known.groupBy(*[quoted(c) for c in by]) if by else known.groupBy()
    sums = grouped.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(y - p)).alias("mae"),
        F.avg((y - p) * (y - p)).alias("mse"),
        F.var_pop(y).alias("_spread"),
    )
    return sums.withColumn("r2", F.lit(1.0) - F.try_divide("mse", "_spread")).drop("_spread")


def actual_vs_predicted(df: DataFrame, region: str, period: str, target: str, prediction: str) -> DataFrame:
    """The rows behind a chart of actual and predicted values per region over time, in that order."""
    return df.select(
        quoted(region), quoted(period), F.col(quoted(target)).alias("actual"),
        F.col(quoted(prediction)).alias("predicted"),
    ).orderBy(quoted(region), quoted(period))
