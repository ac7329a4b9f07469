"""Arithmetic with the NULL and typing rules the reports need."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

WHOLE_NUMBER = r"^\s*[+-]?[0-9]+\s*$"


def at_least(value: Column, floor: int) -> Column:
    """Larger of the two, but NULL stays NULL (`greatest` alone would return the floor)."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(floor)))


def percent(part: Column, whole: Column, digits: int) -> Column:
    """`100 * part / max(whole, 1)` in floating point, rounded half away from zero."""
    return F.round(F.lit(100.0) * part / at_least(whole, 1), digits)


def count_or_zero(value: Column) -> Column:
    """A count as delivered (text) to bigint; missing or not a whole number gives 0.

    The form is checked before the cast, which otherwise raises and catches an exception per bad row.
    """
    return F.coalesce(F.when(value.rlike(WHOLE_NUMBER), value).try_cast("bigint"), F.lit(0).cast("bigint"))


def whole_div(value: Column, divisor: int) -> Column:
    """Integer division."""
    return F.call_function("div", value, F.lit(divisor))


def flag(value: Column) -> Column:
    """Missing flags count as false."""
    return F.coalesce(value, F.lit(False))
