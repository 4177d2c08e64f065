"""Refreshing a written panel by what changed in its sources, instead of rebuilding all of it.

A panel row of a year is made of source rows of that year only, so a digest per
source and year tells which years must be computed again, and a digest per panel
row which of them differ from what is written.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from panelwright.functions.dates import year_of
from panelwright.functions.numbers import round_half_up
from panelwright.operators.reshape import quoted
from panelwright.session import landed
from panelwright.sources.sinks import write_panel

#: Doubles are compared rounded to so many digits: sums differ in the last bits from run to run.
DIGITS = 6


@dataclass(frozen=True)
class Refresh:
    """What a refresh did.

    ``computed``: the years whose sources changed.  ``written``: those of them
    whose panel rows changed.  ``changes``: the keys of the rows that differ, with
    ``change`` (``new``, ``changed`` or ``removed``).
    """

    computed: list[str]
    written: list[str]
    changes: DataFrame


def row_digest(df: DataFrame, digits: int = DIGITS) -> Column:
    """A digest of all columns of a row; NULLs count, columns are told apart by name."""
    values = [
        (round_half_up(quoted(f.name), digits) if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(quoted(f.name))).alias(f.name)
        for f in sorted(df.schema.fields, key=lambda f: f.name)
    ]
    return F.md5(F.to_json(F.struct(*values), {"ignoreNullFields": "false"}))


def digests(df: DataFrame, keys: Mapping[str, Column], digits: int = DIGITS) -> DataFrame:
    """The keys with ``rows``, ``low`` and ``high``: a digest of all rows of a key, in whatever order they lie.

    Digests of rows are added, so tasks add up their own rows first and a key
    of any size takes one row per task.
    """
    digest = row_digest(df, digits)
    half = lambda start: F.conv(F.substring("_digest", start, 15), 16, 10).cast("decimal(38,0)")
    return (
        df.select(*[k.alias(name) for name, k in keys.items()], digest.alias("_digest"))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("rows"), F.sum(half(1)).alias("low"), F.sum(half(16)).alias("high"))
    )


def stamps(sources: Mapping[str, DataFrame], period: str = "REF_DATE") -> DataFrame:
    """source, year, rows, low, high: a digest of every year of every source."""
    parts = [
        digests(df, {"year": year_of(period)}).select(F.lit(name).alias("source"), "year", "rows", "low", "high")
        for name, df in sources.items()
    ]
    return reduce(DataFrame.unionAll, parts)


def compared(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys of two tables of :func:`digests` that differ, with ``change``: new, changed or removed."""
    named = [F.struct(*keys).alias("key"), F.struct("rows", "low", "high").alias("digest")]
    old, new = before.select(*named).alias("old"), after.select(*named).alias("new")
    # keys may hold NULL; a struct does not, so the join stays an equi-join
    both = old.join(new, F.col("old.key") == F.col("new.key"), "full_outer")
    change = (
        F.when(F.col("old.key").isNull(), "new").when(F.col("new.key").isNull(), "removed")
        .when(F.col("old.digest") != F.col("new.digest"), "changed")
    )
    key = F.coalesce("new.key", "old.key")
    return both.select(*[key[k].alias(k) for k in keys], change.alias("change")).where("change IS NOT NULL")


def in_years(period: str, years: Sequence[str]) -> Column:
    """True for periods of the years, as ranges of the text, which reach the scan of a Parquet source."""
    ranges: list[list[int]] = []
    for year in sorted({int(y) for y in years}):
        if ranges and ranges[-1][1] == year:
            ranges[-1][1] = year + 1
        else:
            ranges.append([year, year + 1])
    at = F.col(quoted(period))
    return reduce(
        lambda a, b: a | b, [(at >= F.lit(f"{low:04d}")) & (at < F.lit(f"{high:04d}")) for low, high in ranges], F.lit(False)
    )


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def refresh_panel(
    path: str,
    sources: Mapping[str, DataFrame],
    build: Callable[[Mapping[str, DataFrame]], DataFrame],
    keys: Sequence[str] = ("DGUID", "REF_DATE"),
    period: str = "REF_DATE",
) -> Refresh:
    """Bring the panel at ``path`` up to date with its sources.

    ``build`` makes the panel of the sources; it is given them cut to the years
    that changed since the last refresh, by the stamps kept at
    ``<path>_stamps``.  Its rows are compared with the written ones, and only years
    with a difference are written (dynamic partition overwrite); a year
    without rows is deleted.  The first call writes everything.  The driver
    gets the years, never rows.  Stamps are written last, so a refresh that
    was broken off is repeated by the next one and gives the same panel.

    Periods are texts that begin with a year of four digits; source rows of
    other periods are not compared.  Rows of equal keys are compared together.
    """
    spark = next(iter(sources.values())).sparkSession
    kept = f"{path}_stamps"
    present = landed(stamps(sources, period).where(F.col("year").rlike("^[0-9]{4}$")), "stamps")
    if not (_exists(spark, kept) and _exists(spark, path)):
        panel = landed(build(sources), "panel")
        write_panel(panel, path, period)
        new = landed(panel.select(*[quoted(k) for k in keys]).distinct().withColumn("change", F.lit("new")), "changes")
        years = [r["year"] for r in panel.select(year_of(period).alias("year")).distinct().orderBy("year").collect()]
        present.write.mode("overwrite").parquet(kept)
        return Refresh(years, years, new)
    differing = compared(spark.read.parquet(kept), present, ["source", "year"]).select("year").distinct()
    computed = [r["year"] for r in differing.orderBy("year").collect()]
    part = landed(build({name: df.where(in_years(period, computed)) for name, df in sources.items()}), "part")
    written = spark.read.parquet(path).where(F.col("panel_year").cast("string").isin(computed)).select(*part.columns)
    by_key = {k: F.col(quoted(k)) for k in keys}
    changes = landed(compared(digests(written, by_key), digests(part, by_key), list(keys)), "changes")
    years = [r["year"] for r in changes.select(year_of(period).alias("year")).distinct().orderBy("year").collect()]
    left = part.where(in_years(period, years))
    filled = {r["year"] for r in left.select(year_of(period).alias("year")).distinct().collect()}
    if filled:
        write_panel(left, path, period, only_its_years=True)
    for year in set(years) - filled:
        _delete(spark, f"{path}/panel_year={year}")
    present.write.mode("overwrite").parquet(kept)
    return Refresh(computed, years, changes)
