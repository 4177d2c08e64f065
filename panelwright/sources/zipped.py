"""Zipped CSV deliveries as a Spark data source: a partition per archive member, the asked columns, filters inside the task."""

from __future__ import annotations

import json
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import csv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull
from pyspark.sql.types import StructType

from panelwright.sources.schemas import text_schema
from panelwright.sources.statistics import opened

#: Bytes of a member that are parsed at a time.
BLOCK_BYTES = 8 << 20


@dataclass
class Member(InputPartition):
    """One member of one archive."""

    archive: str
    member: str


class ZippedCsv(DataSource):
    """``spark.read.format("zipped_csv")`` with the options ``archives`` (a JSON list of paths) and ``suffix`` of members to read.

    All columns are text, matched by header name; a column that a member does
    not have is NULL, and so is an empty field.
    """

    @classmethod
    def name(cls) -> str:
        return "zipped_csv"

    def reader(self, schema: StructType) -> DataSourceReader:
        kind = FilteringReader if self.options.get("filters") == "true" else ZippedCsvReader
        return kind(json.loads(self.options["archives"]), self.options.get("suffix", ".csv"), schema.names)


class ZippedCsvReader(DataSourceReader):
    def __init__(self, archives: list[str], suffix: str, columns: list[str]):
        self.archives, self.suffix, self.columns = archives, suffix, columns
        self.tests: list[Filter] = []

    def partitions(self) -> list[Member]:
        """The members of all archives, by their directories; no content is read."""
        found = []
        for archive in self.archives:
            with opened(archive) as stream, zipfile.ZipFile(stream) as content:
                found += [Member(archive, m.filename) for m in content.infolist() if m.filename.endswith(self.suffix)]
        return found

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        """The member's rows in blocks, so a task holds one block whatever the member's size."""
        # null types would fail on a first block without values, so all columns are told to be text
        convert = csv.ConvertOptions(
            column_types={c: pa.string() for c in self.columns}, include_columns=self.columns, include_missing_columns=True,
            strings_can_be_null=True, null_values=[""], quoted_strings_can_be_null=True,
        )
        parse = csv.ParseOptions(newlines_in_values=True)
        with opened(partition.archive) as stream, zipfile.ZipFile(stream) as content, content.open(partition.member) as member:
            for batch in csv.open_csv(member, csv.ReadOptions(block_size=BLOCK_BYTES), parse, convert):
                kept = pa.Table.from_batches([batch])
                for test in self.tests:
                    kept = kept.filter(_passing(kept.column(test.attribute[0]), test))
                yield from kept.to_batches()


class FilteringReader(ZippedCsvReader):
    """The reader for sessions that hand filters to Python sources."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Keeps equality, membership and not-NULL tests of a column, which need no types; gives the others back to Spark."""
        for test in filters:
            if isinstance(test, (EqualTo, In, IsNotNull)) and len(test.attribute) == 1 and test.attribute[0] in self.columns:
                self.tests.append(test)
            else:
                yield test


def _passing(column: pa.ChunkedArray, test: Filter) -> pa.ChunkedArray:
    if isinstance(test, IsNotNull):
        return pc.is_valid(column)
    wanted = [test.value] if isinstance(test, EqualTo) else list(test.value)
    return pc.is_in(column, pa.array([str(w) for w in wanted if w is not None], pa.string()))


def scan_archives(spark: SparkSession, path: str, columns: list[str], suffix: str = ".csv") -> DataFrame:
    """The CSV members of all zip archives below a path, as text columns.

    Spark lists the archives; their names go into the plan, like those of any
    file source.  Members cannot be split, but an archive of many members is read
    by many tasks.  Filters are applied inside the tasks where
    ``spark.sql.python.filterPushdown.enabled`` is set.
    """
    spark.dataSource.register(ZippedCsv)
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", True).load(path)
    archives = sorted(r["path"] for r in listing.select("path").collect())
    filters = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    return (
        spark.read.format("zipped_csv").schema(text_schema(*columns))
        .options(archives=json.dumps(archives), suffix=suffix, filters=filters).load()
    )
