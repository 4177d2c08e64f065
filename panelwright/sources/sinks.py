"""Sinks for panels, listings, predictions and fitted models."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Sequence
from urllib.parse import unquote, urlparse

import pandas as pd
import pyarrow as pa
from pyarrow import csv, fs
from pyspark import TaskContext
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from panelwright.functions.dates import year_of
from panelwright.session import landed


def write_panel(panel: DataFrame, path: str, period: str = "REF_DATE", only_its_years: bool = False) -> None:
    """Write a panel as Parquet, one folder per year, so that a time cut prunes files.

    Rebalancing keeps the files of a year few and splits a year that is too big
    for one task.  ``only_its_years`` replaces the years that the panel has
    rows of and leaves the files of other years alone.
    """
    by_year = panel.withColumn("panel_year", year_of(period)).hint("rebalance", "panel_year")
    mode = "dynamic" if only_its_years else "static"
    by_year.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("panel_year").parquet(path)


def write_observed_panel(panel: DataFrame, path: str, target: str, period: str = "REF_DATE") -> dict[str, object]:
    """Write a panel and tell its rows, rows without target, and first and last period.

    The figures are counted while the rows are written: no second job, no second
    run of the plan.
    """
    watched = Observation("panel")
    observed = panel.observe(
        watched, F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(f"`{target}`").isNull()).alias("n_without_target"),
        F.min(period).alias("first_period"), F.max(period).alias("last_period"),
    )
    write_panel(observed, path, period)
    return dict(watched.get)


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> None:
    """Write a table in buckets of its keys, one file each, below a path.

    Tables with the same number of buckets over the same keys are joined and
    grouped by them without a shuffle.
    """
    placed = df.repartition(buckets, *[f"`{k}`" for k in keys])
    placed.write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)


def _created(place: str):
    if place.startswith("file:") or "://" not in place:
        local = unquote(urlparse(place).path) if place.startswith("file:") else place
        system, inner = fs.LocalFileSystem(), local
    else:
        system, inner = fs.FileSystem.from_uri(place)
    system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(inner)


def write_zipped(df: DataFrame, path: str, member: str = "table.csv") -> None:
    """Write a table as zip archives of one headed CSV file each, one archive per task.

    A task streams its rows into the archive.  A repeated task writes the same
    name again, so no rows are doubled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = f"{path}/part-{TaskContext.get().partitionId():05d}.zip"
        rows = 0
        with _created(place) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
            with archive.open(member, "w", force_zip64=True) as stream:
                for batch in batches:
                    if batch.num_rows:
                        part = io.BytesIO()
                        csv.write_csv(batch, part, csv.WriteOptions(include_header=rows == 0))
                        stream.write(part.getvalue())
                        rows += batch.num_rows
                if not rows:
                    stream.write((",".join(f'"{n}"' for n in names) + "\n").encode())
        yield pa.RecordBatch.from_arrays([pa.array([place]), pa.array([rows])], ["place", "rows"])

    names = df.columns
    landed(df.mapInArrow(run, "place string, rows long"), "archives")


def write_texts(files: DataFrame, path: str, name: str = "name", content: str = "content") -> None:
    """Write each row's ``content`` as the file of its ``name``; the rows must be small enough to be files of their own."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                with _created(f"{path}/{row.name}") as out:
                    out.write(row.content.encode())
            yield batch[["name"]]

    rows = files.select(F.col(f"`{name}`").alias("name"), F.col(f"`{content}`").alias("content"))
    landed(rows.mapInPandas(run, "name string"), "texts")


def write_panel_csv(panel: DataFrame, path: str, files: int | None = None) -> None:
    """Write a panel as CSV with header, in as many files as there are tasks unless a number is asked for.

    A single file is written by a single task: ask for it only where the panel is small.
    """
    out = panel.repartition(files) if files else panel
    out.write.mode("overwrite").option("header", True).csv(path)


def write_listings(listings: DataFrame, path: str) -> None:
    """Write cleaned listings as CSV without header, quotes doubled; an existing target is an error."""
    listings.write.mode("errorifexists").option("quote", '"').option("escape", '"').csv(path)


def write_predictions(predictions: DataFrame, path: str) -> None:
    """Write rows with their predictions as CSV with header."""
    predictions.write.mode("overwrite").option("header", True).csv(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
