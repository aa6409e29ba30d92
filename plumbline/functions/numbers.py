"""Column expressions over numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(value: Column, digits: int) -> Column:
    """Half-to-even rounding."""
    return F.bround(value, digits)


def ratio(part: Column, whole: Column, otherwise: float | None = 0.0) -> Column:
    """part / whole, or `otherwise` when the divisor is zero."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(otherwise))


def ns_to_ms(value: Column) -> Column:
    return value / F.lit(1e6)


def ns_to_s(value: Column) -> Column:
    return value / F.lit(1e9)


def bytes_to_gb(value: Column) -> Column:
    return value / F.lit(1e9)


def number_or_zero(text: Column) -> Column:
    """Text as a double; text that is no number becomes 0."""
    return F.coalesce(text.try_cast("double"), F.lit(0.0))


def flag_to_int(value: Column) -> Column:
    """Yes/No, true/false or 0/1 text, or a boolean, as 0/1; anything else as NULL."""
    return value.try_cast("boolean").cast("int")
