"""Casts for data nobody vouches for: a bad value becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strftime codes used by the statement providers.
_STRFTIME = {"%d": "d", "%m": "M", "%Y": "yyyy", "%y": "yy", "%b": "MMM"}


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def safe_to_date(text: Column) -> Column:
    """ISO date or NULL. The shape is tested first: a bare cast also takes ``2026-01``."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))


def safe_int(text: Column) -> Column:
    return blank_to_null(F.trim(text)).try_cast("int")


def safe_decimal(text: Column, precision: int = 12, scale: int = 2) -> Column:
    return blank_to_null(F.trim(text)).try_cast(f"decimal({precision},{scale})")


def safe_boolean(text: Column) -> Column:
    return blank_to_null(F.trim(text)).try_cast("boolean")


def money(text: Column, precision: int = 12, scale: int = 2) -> Column:
    """``$1,234.50`` and ``(1,234.50)`` to DECIMAL; brackets mean a negative.

    One character pass: an opening bracket becomes a minus, the closing one,
    dollar signs, commas and blanks go.
    """
    return F.translate(text, "()$, \t", "-").try_cast(f"decimal({precision},{scale})")


def java_date_format(strftime: str) -> str:
    """``%d/%m/%Y`` to the pattern Spark reads."""
    out = strftime
    for code, pattern in _STRFTIME.items():
        out = out.replace(code, pattern)
    return out


def statement_date(text: Column, strftime: str) -> Column:
    """Date by a strftime pattern; two-digit years run from 1969 to 2068."""
    day = F.try_to_timestamp(F.trim(text), F.lit(java_date_format(strftime))).cast("date")
    if "%y" not in strftime:
        return day
    return F.when(F.year(day) >= 2069, F.add_months(day, -1200)).otherwise(day)


def exact_mean(value: Column, scale: int) -> Column:
    """Mean of a DECIMAL column rounded half away from zero.

    ``avg`` rounds to four more digits than the input first, and rounding twice
    can move the last digit; the plain quotient keeps enough digits.
    """
    return F.round(F.try_divide(F.sum(value), F.count(value)), scale)


def mean_double(value: Column) -> Column:
    """Unrounded mean: an exact DECIMAL sum divided as DOUBLE."""
    return F.sum(value).cast("double") / F.nullif(F.count(value), F.lit(0)).cast("double")
