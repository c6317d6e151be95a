"""Arithmetic that yields NULL where ANSI mode would raise."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom, NULL when bottom is 0."""
    return F.try_divide(top, bottom)


def percent(top: Column, bottom: Column) -> Column:
    return F.try_divide(top, bottom) * 100


def ieee_percent(top: Column, bottom: Column) -> Column:
    """As ``percent``, but a bottom of 0 gives an infinity, or NaN for 0 / 0, as plain doubles do."""
    nan, inf = F.lit(float("nan")), F.lit(float("inf"))
    limit = (F.when(F.isnan(top) | (top == 0), nan).when(top > 0, inf).when(top < 0, -inf))
    return F.when(bottom == 0, limit).otherwise(percent(top, bottom))


def finite(value: Column) -> Column:
    return F.abs(value) < float("inf")  # NaN is the largest value


def fixed(value: Column, places: int) -> Column:
    """Half-up rounding on the scaled double; the same in any IEEE engine."""
    scale = float(10 ** places)
    return F.floor(value * scale + 0.5) / scale


def number(text: Column, kind: str = "double") -> Column:
    """Parse a number; NULL when the text is not one."""
    return text.try_cast(kind)


def falsy_to_null(value: Column) -> Column:
    """A zero counts as missing, as in the document statistics."""
    return F.when(value != 0, value)
