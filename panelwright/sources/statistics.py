"""Long statistics tables: zipped CSV deliveries, plain CSV and the typed landing table."""

from __future__ import annotations

import zipfile
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.sources.schemas import statistics_columns, text_schema

_ROWS_PER_BATCH = 50_000


def read_zipped(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Rows of the first member of each zip archive below a path, all columns as text.

    Spark lists the archives, one row each; a task opens its archive by path and
    streams the member through, so it holds one batch of rows whatever the
    archive's size.  A zip member cannot be split.  Columns are matched by
    header name, an absent one is NULL.  The result is read once per use: land
    it before heavy use.

    Paths are opened with pyarrow's file systems (local, HDFS, S3, GCS).
    """

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for place in batch["path"]:
                with opened(place) as stream, zipfile.ZipFile(stream) as archive:
                    with archive.open(archive.infolist()[0]) as member:
                        reader = pd.read_csv(
                            member, dtype=str, chunksize=_ROWS_PER_BATCH, encoding="utf-8-sig"
                        )
                        for part in reader:
                            part = part.reindex(columns=columns).astype(object)
                            yield part.where(part.notna(), None)

    # only the paths are selected, so no content is read here; one archive per task
    archives = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path")
    return archives.repartition("path").mapInPandas(rows, text_schema(*columns))


def opened(place: str):
    """A seekable stream of a file that Spark names by its URI."""
    if place.startswith("file:"):
        return pa.OSFile(unquote(urlparse(place).path), "rb")
    system, path = fs.FileSystem.from_uri(place)
    return system.open_input_file(path)


def read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Headed CSV files below a path, all columns as text, in the order of ``columns``."""
    return (
        spark.read.schema(text_schema(*columns))
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def typed(long: DataFrame) -> DataFrame:
    """The table with VALUE as double (NULL where it is no number) and codes as integers."""
    casts = {"VALUE": F.col("VALUE").try_cast("double")}
    for code in ("UOM_ID", "SCALAR_ID"):
        if code in long.columns:
            casts[code] = F.col(code).try_cast("int")
    return long.withColumns(casts)


def statistics_table(spark: SparkSession, path: str, table: str, zipped: bool = True) -> DataFrame:
    """Typed scan of a known statistics table from a landing directory."""
    columns = statistics_columns(table)
    read = read_zipped if zipped else read_csv
    return typed(read(spark, path, columns))


def land(long: DataFrame, path: str, partitions: int | None = None) -> None:
    """Write a scanned table once as Parquet, spread over tasks, so that later scans split and prune."""
    spread = long.repartition(partitions) if partitions else long.repartition("REF_DATE", "GEO")
    spread.write.mode("overwrite").parquet(path)
