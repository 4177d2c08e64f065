"""Forecasts from the panel: polynomial ridge and look-back regression."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions.dates import month_number
from panelwright.operators.features import impute_regression, lags, levels_of, min_max, one_hot, time_split
from panelwright.operators.regression import polynomial_ridge, predict, regression_errors
from panelwright.operators.panel import one_row_per_key
from panelwright.operators.reshape import keep_in, keep_not_null, quoted
from panelwright.operators.stages import LevelEncoder, LineImputer, MonthNumber, RangeScaler, fitted_in_turn
from panelwright.session import landed

# Ids of the modelled provinces.
MODELLED_REGIONS = [
    "2016A000235", "2016A000259", "2016A000224", "2016A000248", "2016A000212", "2016A000247", "2016A000246",
]
# Target, cut and sizes of the two models.
TARGET = "total_house_land"
CUT = "2018-01"
BEST_FEATURES = 15
DEGREE = 3
ALPHA = 0.01
LOOK_BACK = 6


@dataclass(frozen=True)
class Forecast:
    """A fitted model, all rows with ``prediction`` and ``is_train``, and the errors of both parts.

    ``rows`` are the model rows in the shared folder, deleted by :func:`panelwright.session.clean`.
    """

    model: PipelineModel
    rows: DataFrame
    predictions: DataFrame
    errors: DataFrame


def prepare(
    panel: DataFrame,
    columns: Sequence[str],
    regions: Sequence[str] | None = MODELLED_REGIONS,
    target: str = TARGET,
    region: str = "DGUID",
    label: str = "GEO",
    period: str = "REF_DATE",
    levels: Sequence[str] | None = None,
) -> tuple[DataFrame, list[str]]:
    """Model rows and their feature columns.

    Rows of the regions with a target; the region label one-hot encoded, the
    month as integer, NULLs of ``columns`` filled by a line per region, and all
    features scaled to [0, 1] over all rows.
    """
    kept = keep_in(panel, region, regions) if regions is not None else panel
    dated = keep_not_null(kept, target).withColumn("REF_DATE_INT", month_number(period))
    coded = one_hot(dated, label, "Province", levels_of(dated, label) if levels is None else levels)
    # ranges and rows both need the filled rows
    filled = landed(impute_regression(coded, region, "REF_DATE_INT", columns), "filled")
    features = [*columns, "REF_DATE_INT", *[c for c in coded.columns if c.startswith("Province_")]]
    return min_max(filled, features), features


def _fitted(
    rows: DataFrame, features: Sequence[str], target: str, period: str, cut: str,
    alpha: float, degree: int, k: int | None,
) -> Forecast:
    # fitting reads the rows several times
    rows = landed(rows, "model")
    train, _ = time_split(rows, period, cut)
    model = polynomial_ridge(train, features, target, alpha, degree, k)
    scored = predict(model, rows).withColumn("is_train", F.col(quoted(period)) < F.lit(cut))
    return Forecast(model, rows, scored, regression_errors(scored, target, "prediction", by=["is_train"]))


def ridge_forecast(
    panel: DataFrame,
    columns: Sequence[str],
    regions: Sequence[str] | None = MODELLED_REGIONS,
    target: str = TARGET,
    period: str = "REF_DATE",
    cut: str = CUT,
    k: int = BEST_FEATURES,
    degree: int = DEGREE,
    alpha: float = ALPHA,
    **names,
) -> Forecast:
    """Best features, polynomial expansion and ridge regression, fitted on rows before the cut."""
    rows, features = prepare(panel, columns, regions, target, period=period, **names)
    return _fitted(rows, features, target, period, cut, alpha, degree, k)


def fitted_pipeline(
    train: DataFrame,
    columns: Sequence[str],
    target: str = TARGET,
    region: str = "DGUID",
    label: str = "GEO",
    period: str = "REF_DATE",
    k: int | None = BEST_FEATURES,
    degree: int = DEGREE,
    alpha: float = ALPHA,
) -> PipelineModel:
    """Preparation and regression as one model, fitted on the training rows only, that scores rows of a panel as they are.

    Lines, levels and ranges are those of the training rows; a row to be scored
    needs the ``columns``, region, label and period, but no target.  Save it with
    :func:`panelwright.sources.sinks.save_model`.
    """
    known = keep_not_null(train, target)
    month = "REF_DATE_INT"
    prepared, rows = fitted_in_turn([
        MonthNumber(period=period, name=month),
        LevelEncoder(column=label, prefix="Province"),
        LineImputer(group=region, x=month, columns=list(columns)),
    ], known)
    features = [*columns, month, *[c for c in rows.columns if c.startswith("Province_") and c not in known.columns]]
    # ranges and regression read the filled rows several times
    scaled, rows = fitted_in_turn([RangeScaler(columns=features)], landed(rows, "filled"))
    model = polynomial_ridge(rows, features, target, alpha, degree, k)
    return PipelineModel([*prepared.stages, *scaled.stages, *model.stages])


def look_back_forecast(
    panel: DataFrame,
    regions: Sequence[str] | None = MODELLED_REGIONS,
    target: str = TARGET,
    region: str = "DGUID",
    label: str = "GEO",
    period: str = "REF_DATE",
    cut: str = CUT,
    n: int = LOOK_BACK,
    alpha: float = 0.0,
    levels: Sequence[str] | None = None,
    bucket: Column | None = None,
) -> Forecast:
    """Linear regression of the target on its previous ``n`` values and the one-hot label.

    The first label has no column of its own: beside the intercept it would
    leave the system without a unique solution.  ``bucket`` is that of
    :func:`panelwright.operators.features.look_back`, for long groups.
    """
    kept = keep_in(panel, region, regions) if regions is not None else panel
    rows = keep_not_null(kept, target).select(region, label, period, target)
    levels = levels_of(rows, label) if levels is None else list(levels)
    samples = lags(one_hot(rows, label, "Province", levels[1:]), region, period, target, n, bucket)
    features = [f"{target}_lag{i}" for i in range(1, n + 1)] + [f"Province_{level}" for level in levels[1:]]
    return _fitted(samples, features, target, period, cut, alpha, 1, None)


def look_back_trees(
    panel: DataFrame,
    regions: Sequence[str] | None = MODELLED_REGIONS,
    target: str = TARGET,
    region: str = "DGUID",
    period: str = "REF_DATE",
    cut: str = CUT,
    n: int = LOOK_BACK,
    trees: int = 20,
    depth: int = 4,
    bucket: Column | None = None,
    seed: int = 1,
) -> Forecast:
    """Boosted regression trees over the previous ``n`` values, for series that do not follow a line."""
    kept = keep_in(panel, region, regions) if regions is not None else panel
    rows = keep_not_null(kept, target).select(region, period, target)
    samples = landed(lags(rows, region, period, target, n, bucket), "model")
    train, _ = time_split(samples, period, cut)
    features = [f"{target}_lag{i}" for i in range(1, n + 1)]
    boosted = GBTRegressor(featuresCol="_inputs", labelCol=target, maxIter=trees, maxDepth=depth, seed=seed)
    model = Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="_inputs"), boosted]).fit(train)
    scored = predict(model, samples).withColumn("is_train", F.col(quoted(period)) < F.lit(cut))
    return Forecast(model, samples, scored, regression_errors(scored, target, "prediction", by=["is_train"]))


def with_predictions(panel: DataFrame, predictions: DataFrame, name: str, keys: Sequence[str] = ("REF_DATE", "DGUID")) -> DataFrame:
    """Panel rows that have a prediction, with it as a column.

    Several predictions of one key fail the query; they would multiply panel rows.
    """
    found = predictions.select(*[quoted(c) for c in keys], F.col("prediction").alias(name))
    return panel.join(one_row_per_key(found, keys, [name], "raise"), list(keys), "inner")
