"""Cleaning of scraped listings and the reports on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions.dates import capped_year, listing_date, listing_month
from panelwright.functions.numbers import plain_number, price
from panelwright.operators import extremes as x
from panelwright.operators.features import fill_mean
from panelwright.operators.reshape import keep_not_null
from panelwright.sources.files import raw_listings
from panelwright.sources.schemas import CLEAN_LISTING


def combine_listings(spark: SparkSession, parts: str | Sequence[str]) -> DataFrame:
    """Rows of all headed part files as one table."""
    return raw_listings(spark, parts if isinstance(parts, str) else list(parts), header=True)


def clean_listings(raw: DataFrame, as_of_year: int = 2018) -> DataFrame:
    """Typed listings with month, price per square foot, age and date.

    Rows need a province, a price and a date.  A missing area takes the mean
    area; a missing or later year built counts as ``as_of_year``.
    """
    kept = keep_not_null(raw, "province", "listprice", "date_added")
    typed = kept.withColumns({
        "listprice": price("listprice"),
        "year_built": capped_year("year_built", as_of_year),
        "Area": plain_number("Area"),
        "monthyr": listing_month("date_added"),
        "DateAdd": listing_date("date_added"),
    })
    filled = fill_mean(typed, "Area")
    return filled.withColumns({
        "PriceperSqft": F.try_divide(F.col("listprice").cast("double"), F.col("Area")),
        "Age": F.lit(as_of_year) - F.col("year_built"),
    }).select(*CLEAN_LISTING.names)


def age_price_correlation(listings: DataFrame) -> DataFrame:
    return x.correlation(listings, "Age", "listprice")


def price_range(listings: DataFrame, by: str) -> DataFrame:
    """Highest and lowest price per number of beds or baths, in numeric order of that number."""
    ranges = keep_not_null(listings, by).groupBy(by).agg(
        F.max("listprice").alias("maxprice"), F.min("listprice").alias("minprice")
    )
    return ranges.orderBy(F.col(by).try_cast("double"), by).select("maxprice", "minprice", by)


def most_expensive_localities(listings: DataFrame, by_value_only: bool = False) -> DataFrame:
    """Per province, the locality with the highest mean price per square foot and its postal codes."""
    top = x.top_member(listings, "province", "locality", "PriceperSqft", extra=["postal_code"], by_value_only=by_value_only)
    return top.select("locality", "postal_code", "province", "maxprice")


def province_summary(listings: DataFrame) -> DataFrame:
    return x.summary(listings, "province", "listprice").withColumnsRenamed(
        {"max_listprice": "maxprice", "min_listprice": "minprice", "avg_listprice": "avgprice"}
    )


def extreme_listings(listings: DataFrame, how: str = "max", by_value_only: bool = False) -> DataFrame:
    """Listings at the highest or lowest price of their province, with that price repeated.

    ``by_value_only`` also returns listings of other provinces that happen to have
    such a price, each listing once, with the number of provinces that have it.
    """
    name = f"{how}price"
    if by_value_only:
        return x.extremes_by_value(listings, "province", "listprice", how).withColumnRenamed(f"{how}_listprice", name)
    return x.extremes(listings, "province", "listprice", how).withColumn(name, F.col("listprice"))
