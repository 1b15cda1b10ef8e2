"""Guarded arithmetic and lenient number parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, NumericType

_WHITESPACE = " \t\n\r\x0b\x0c"


def strip(text: Column) -> Column:
    """Remove surrounding whitespace of any kind (``trim`` alone removes spaces only)."""
    return F.btrim(text, F.lit(_WHITESPACE))


def safe_ratio(part: Column, whole: Column, scale: int, factor: int = 1) -> Column:
    """``round(part / whole * factor, scale)``, null when ``whole`` is zero (ANSI division would throw)."""
    return F.round(part / F.nullif(whole, F.lit(0)) * F.lit(factor), scale)


def as_double(value: Column, dtype: DataType) -> Column:
    """``value`` as a double, null where it does not read as a number.

    Typed numbers are cast. Text may have digit groups (``1_000``); the Java-only spellings that a cast
    would take, a type suffix (``5d``) and hexadecimal, are no numbers.
    """
    if isinstance(dtype, (NumericType, BooleanType)):
        return value.cast("double")
    text = F.lower(strip(value.cast("string")))
    suffixed = text.endswith("d") | (text.endswith("f") & ~text.endswith("inf"))
    return (
        F.when(suffixed | text.contains("x"), F.lit(None))
        .when(text.contains("_"), F.regexp_replace(text, r"(?<=\d)_(?=\d)", "").try_cast("double"))
        .otherwise(text.try_cast("double"))
    )


def safe_float(value: Column, dtype: DataType, default: float = 0.0) -> Column:
    return F.coalesce(as_double(value, dtype), F.lit(float(default)))


def safe_int(value: Column, dtype: DataType, default: int = 0) -> Column:
    """Integer part toward zero; ``default`` where the value is no number or does not fit."""
    return F.coalesce(as_double(value, dtype).try_cast("bigint"), F.lit(default).cast("bigint"))


def clamp(value: Column, low: int, high: int) -> Column:
    return F.greatest(F.lit(low), F.least(value, F.lit(high)))


def plain_number(value: Column) -> Column:
    """Two-decimal number as text without an exponent and with one trailing zero at most: 12.5, 300.0."""
    return F.regexp_replace(value.try_cast("decimal(38,2)").cast("string"), "0$", "")
