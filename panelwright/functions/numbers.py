"""Arithmetic on feature columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelwright.functions.labels import _col


def round_half_up(value: Column | str, digits: int) -> Column:
    """Round half up as double, independent of noise in the last bits of a sum.

    The order in which executors add doubles differs from run to run; rounding
    to a few more digits first keeps exact halves on one side.  The rule is the
    same for values of any size.
    """
    return F.round(F.round(_col(value).cast("double"), digits + 4), digits)


def monthly_share(annual: Column | str, digits: int = 2) -> Column:
    """Twelfth of an annual amount, rounded."""
    return round_half_up(_col(annual) / F.lit(12.0), digits)


def unit_base(unit: Column | str) -> Column:
    """The 100 of ``'Index, 201612=100'``; NULL where no number follows."""
    return F.substring_index(_col(unit), "=", -1).try_cast("double")


def scaled_by_base(value: Column | str, unit: Column | str) -> Column:
    """Value times the base named in its unit text."""
    return _col(value) * unit_base(unit)


def net_flow(inflow: Column | str, second_inflow: Column | str, outflow: Column | str) -> Column:
    """Sum of two inflows minus the outflow; NULL if any of them is."""
    return _col(inflow) + _col(second_inflow) - _col(outflow)


def plain_number(text: Column | str, to: str = "double") -> Column:
    """Number of a text with thousands commas, NULL where it is none."""
    return F.regexp_replace(_col(text), ",", "").try_cast(to)


def price(text: Column | str) -> Column:
    """``1234000.00`` for ``'$ 1,234,000'``: a two-character currency prefix and commas are dropped."""
    return plain_number(F.substring(_col(text), 3, 2147483647), "decimal(18,2)")
