"""Periods as text: ``yyyy-MM`` months and ``yyyy`` years, and listing dates ``5-Nov-18``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelwright.functions.labels import _col


def year_of(period: Column | str) -> Column:
    """``'2018'`` for ``'2018-01'``, ``'2018-01-05'`` or ``'2018'``."""
    return F.substring_index(_col(period), "-", 1)


def month_of(date_text: Column | str) -> Column:
    """``'2018-01'`` for the text ``'2018-01-05'``."""
    return F.substring_index(_col(date_text), "-", 2)


def month_text(date: Column | str) -> Column:
    """``'2018-01'`` for a date or timestamp."""
    return F.date_format(_col(date), "yyyy-MM")


def month_number(period: Column | str) -> Column:
    """The integer 201801 for ``'2018-01'`` (months are not equidistant on this scale)."""
    return F.replace(_col(period), F.lit("-"), F.lit("")).try_cast("int")


def calendar_year(period: Column | str) -> Column:
    """Integer year of a ``yyyy-MM`` month, NULL where the text is no month."""
    return F.year(F.try_to_date(_col(period), "yyyy-MM"))


def is_month(period: Column | str) -> Column:
    """True for texts of the form ``yyyy-MM`` with a month from 01 to 12."""
    return _col(period).rlike(r"^\d{4}-(0[1-9]|1[0-2])$")


def listing_date(text: Column | str) -> Column:
    """Date of ``'5-Nov-18'``; NULL where the text is no such date."""
    return F.try_to_date(_col(text), "d-MMM-yy")


def listing_month(text: Column | str) -> Column:
    """``'Nov18'`` for ``'5-Nov-18'``."""
    return F.array_join(F.slice(F.split(_col(text), "-"), 2, 2), "")


def capped_year(year: Column | str, as_of_year: int) -> Column:
    """Year as integer, a missing or later one replaced by ``as_of_year``."""
    return F.least(F.coalesce(_col(year).try_cast("int"), F.lit(as_of_year)), F.lit(as_of_year))
