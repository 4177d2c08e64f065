"""Preparation as fitted stages: what is learned from the training rows is saved with the model and applied to new rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions.dates import month_number
from panelwright.operators.features import filled_by_lines, fitted_lines, levels_of, one_hot
from panelwright.operators.reshape import quoted


def _param(name: str, doc: str, converter=TypeConverters.toString) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=converter)


class _Lines(Params):
    group = _param("group", "column whose values have a line each")
    x = _param("x", "column that the lines are fitted on")
    columns = _param("columns", "columns whose NULLs are filled", TypeConverters.toListString)


class LineImputer(Estimator, _Lines, DefaultParamsReadable, DefaultParamsWritable):
    """Fits a line per group and column; see :func:`panelwright.operators.features.impute_regression`."""

    @keyword_only
    def __init__(self, *, group: str | None = None, x: str | None = None, columns: Sequence[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> LineImputerModel:
        group, x, columns = (self.getOrDefault(p) for p in ("group", "x", "columns"))
        return self._copyValues(LineImputerModel(fitted_lines(dataset, group, x, columns)))


class LineImputerModel(Model, _Lines, MLReadable, MLWritable):
    """The lines, one row per group: a table, as large as the groups are many, saved as Parquet beside the parameters.

    Groups that were not there when the lines were fitted are filled with 0, as those without a value.
    """

    def __init__(self, lines: DataFrame | None = None):
        super().__init__()
        self.lines = lines

    def _transform(self, dataset: DataFrame) -> DataFrame:
        group, x, columns = (self.getOrDefault(p) for p in ("group", "x", "columns"))
        return filled_by_lines(dataset, self.lines, group, x, columns)

    def write(self) -> MLWriter:
        return _LinesWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _LinesReader()


class _LinesWriter(MLWriter):
    def __init__(self, model: LineImputerModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.lines.write.parquet(f"{path}/lines")


class _LinesReader(MLReader):
    def load(self, path: str) -> LineImputerModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = LineImputerModel(self.sparkSession.read.parquet(f"{path}/lines"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class _Ranges(Params):
    columns = _param("columns", "columns to scale", TypeConverters.toListString)


class RangeScaler(Estimator, _Ranges, DefaultParamsReadable, DefaultParamsWritable):
    """Fits the range of each column, in one aggregation."""

    @keyword_only
    def __init__(self, *, columns: Sequence[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> RangeScalerModel:
        columns = self.getOrDefault("columns")
        bounds = [f(F.col(quoted(c)).cast("double")) for c in columns for f in (F.min, F.max)]
        found = [float("nan") if v is None else v for v in dataset.agg(*[b.alias(f"b{i}") for i, b in enumerate(bounds)]).first()]
        model = RangeScalerModel()
        model._set(lows=found[::2], highs=found[1::2])
        return self._copyValues(model)


class RangeScalerModel(Model, _Ranges, DefaultParamsReadable, DefaultParamsWritable):
    """Scales by the fitted ranges: values outside of them leave [0, 1]; a constant column becomes its distance from the constant.

    A column without a value when the ranges were fitted stays NULL.
    """

    lows = _param("lows", "smallest value of each column", TypeConverters.toListFloat)
    highs = _param("highs", "largest value of each column", TypeConverters.toListFloat)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        columns, lows, highs = (self.getOrDefault(p) for p in ("columns", "lows", "highs"))
        scaled = {}
        for c, low, high in zip(columns, lows, highs):
            value = (F.col(quoted(c)).cast("double") - F.lit(low)) / F.lit(high - low if high != low else 1.0)
            scaled[c] = value if low == low else F.lit(None).cast("double")
        return dataset.withColumns(scaled)


class _Levels(Params):
    column = _param("column", "column to encode")
    prefix = _param("prefix", "prefix of the new columns")


class LevelEncoder(Estimator, _Levels, DefaultParamsReadable, DefaultParamsWritable):
    """Fits the levels of a column that become names of columns, so they come to the driver."""

    @keyword_only
    def __init__(self, *, column: str | None = None, prefix: str | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> LevelEncoderModel:
        model = LevelEncoderModel()
        model._set(levels=levels_of(dataset, self.getOrDefault("column")))
        return self._copyValues(model)


class LevelEncoderModel(Model, _Levels, DefaultParamsReadable, DefaultParamsWritable):
    """Adds a 0/1 column per fitted level; a level that was not there when it was fitted has 0 in all of them."""

    levels = _param("levels", "levels in order", TypeConverters.toListString)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return one_hot(dataset, *(self.getOrDefault(p) for p in ("column", "prefix", "levels")))


class MonthNumber(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the month ``yyyy-MM`` as an integer column."""

    period = _param("period", "column with the month")
    name = _param("name", "new column")

    @keyword_only
    def __init__(self, *, period: str | None = None, name: str | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOrDefault("name"), month_number(self.getOrDefault("period")))


def fitted_in_turn(stages: Sequence[Estimator | Transformer], train: DataFrame) -> tuple[PipelineModel, DataFrame]:
    """The stages fitted one after the other, each on what the ones before it make of the rows, and these rows at the end."""
    fitted = []
    for stage in stages:
        model = stage.fit(train) if isinstance(stage, Estimator) else stage
        train = model.transform(train)
        fitted.append(model)
    return PipelineModel(fitted), train


def load_pipeline(spark: SparkSession, path: str) -> PipelineModel:
    """A saved pipeline of these stages and those of Spark."""
    return PipelineModel.read().session(spark).load(path)
