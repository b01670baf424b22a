"""Column expressions shared by the operators. All built-in, all JVM side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def filled(column: str) -> Column:
    """Holds something other than spaces; never NULL."""
    return F.coalesce(F.trim(column) != "", F.lit(False))


def parse_price(column: str, price_type: str) -> Column:
    """Text with a decimal comma as a decimal, NULL where it is not one."""
    return F.translate(F.trim(column), ",", ".").try_cast(price_type)


def parse_date(column: str, pattern: str) -> Column:
    """Text as a date, NULL where it is not one of that pattern."""
    return F.try_to_date(F.trim(column), pattern)


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator as double; 0.0 when the denominator is 0 or NULL."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))
