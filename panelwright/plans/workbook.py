"""Distinct-count sheets over the panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions.dates import calendar_year
from panelwright.operators.extremes import distinct_count
from panelwright.operators.reshape import keep_in
from panelwright.operators.sketches import sketch_table, sketched_counts

# The provinces on the map sheet.
MAP_PROVINCES = [
    "Alberta", "British Columbia", "Manitoba", "New Brunswick", "Newfoundland and Labrador",
    "Nova Scotia", "Ontario", "Prince Edward Island", "Quebec", "Saskatchewan",
]


def _dated(panel: DataFrame) -> DataFrame:
    """With the integer ``year``, taken from the month unless the panel has it."""
    return panel if "year" in panel.columns else panel.withColumn("year", calendar_year("REF_DATE"))


def distinct_by_unit(
    panel: DataFrame, year: int | None = None, measures: Sequence[str] = ("total_house_land",), approximate: bool = False
) -> DataFrame:
    """Distinct index values per unit and region, for one year or per year."""
    dated = _dated(panel)
    if year is not None:
        dated = dated.where(F.col("year") == year)
    return distinct_count(dated, ["year", "uom_houseindex", "GEO"], measures, approximate)


def distinct_by_year(
    panel: DataFrame, region: str | None = None, measures: Sequence[str] = ("total_house_land",), approximate: bool = False
) -> DataFrame:
    """Distinct index values per year, for one region or per region."""
    dated = _dated(panel)
    if region is not None:
        dated = dated.where(F.col("GEO") == region)
    return distinct_count(dated, ["year", "GEO", "uom_houseindex"], measures, approximate)


def distinct_on_map(
    panel: DataFrame, regions: Sequence[str] = MAP_PROVINCES,
    measures: Sequence[str] = ("total_house_land",), approximate: bool = False,
) -> DataFrame:
    """Distinct index values per year and unit of the listed regions."""
    kept = keep_in(panel, "GEO", regions)
    return distinct_by_unit(kept, measures=measures, approximate=approximate)


#: The finest groups whose values are sketched; every sheet merges them.
SKETCHED = ["year", "REF_DATE", "uom_houseindex", "GEO"]


def stored_sketches(panel: DataFrame, measures: Sequence[str] = ("total_house_land",)) -> DataFrame:
    """Sketches of the index values per month, unit and region, to be written and kept.

    A new month adds rows to the table; months that are there are not read again.
    """
    return sketch_table(_dated(panel), SKETCHED, measures)


def sheet_of_sketches(
    sketches: DataFrame, groups: Sequence[str] = ("year", "uom_houseindex", "GEO"), year: int | None = None,
    regions: Sequence[str] | None = None, measures: Sequence[str] = ("total_house_land",),
) -> DataFrame:
    """A sheet of distinct counts from stored sketches, for one year or all and for some regions or all."""
    kept = sketches if year is None else sketches.where(F.col("year") == year)
    kept = kept if regions is None else keep_in(kept, "GEO", regions)
    return sketched_counts(kept, groups, measures)
