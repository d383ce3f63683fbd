"""Column functions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: decimal and exponent notation, infinities and NaN; a letter suffix such as 1d is no number
NUMBER = r"(?i)^[+-]?((\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|inf(inity)?|nan)$"


def numeric(x: Column) -> Column:
    """x as a double, NULL where its trimmed text is no number."""
    text = F.trim(x.cast("string"))
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def no_nan(x: Column) -> Column:
    """NaN becomes NULL, so that aggregates skip it."""
    return F.when(~F.isnan(x), x)


def is_missing(x: Column) -> Column:
    return x.isNull() | F.isnan(x)


def all_finite(series: Column) -> Column:
    """False where an element is NULL, NaN or infinite; NULL for a NULL array."""
    return F.forall(series, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))


def square(x: Column) -> Column:
    return x * x


def rounded_key(*coordinates: Column, digits: int = 6) -> list[Column]:
    return [F.round(c, digits) for c in coordinates]


def wrap_positive(lon: Column) -> Column:
    return F.pmod(lon, F.lit(360.0))


def wrap_signed(lon: Column) -> Column:
    return F.pmod(lon + 180.0, F.lit(360.0)) - 180.0
