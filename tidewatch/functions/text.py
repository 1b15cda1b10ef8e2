"""Text signals and lookups."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType

from tidewatch.functions.numbers import strip

# Flag texts that count as true, risk keywords, the money pattern, the excerpt length. A currency
# sign may precede the number; it is left out of the pattern because it does not change which number is found.
TRUE_TEXTS = ("1", "true", "yes", "y", "anomaly", "failed", "error")
RISK_KEYWORDS = ("anomaly", "incident", "failed", "error", "risk", "urgent")
AMOUNT_PATTERN = r"\d{1,3}(?:,\d{3})*\.\d{2}|\d+(?:\.\d{2})?"
EXCERPT_LENGTH = 900


def sql_literal(value: object) -> str:
    """A string, number, boolean or tuple of them as SQL text."""
    if isinstance(value, tuple):
        return "(" + ", ".join(map(sql_literal, value)) + ")"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value).lower() if isinstance(value, bool) else str(value)


def lookup(mapping: Mapping[str, object], key: str) -> Column:
    """Value in a small fixed mapping for the SQL expression ``key``, null when absent.

    The mapping folds to one literal in the plan.
    """
    pairs = ", ".join(sql_literal(item) for entry in mapping.items() for item in entry)
    return F.expr(f"try_element_at(map({pairs}), {key})")


def truthy(value: Column, dtype: DataType) -> Column:
    """Flag reading of a loose value; null is false."""
    if isinstance(dtype, BooleanType):
        return F.coalesce(value, F.lit(False))
    return F.coalesce(F.lower(strip(value.cast("string"))).isin(*TRUE_TEXTS), F.lit(False))


def first_amount(text: Column) -> Column:
    """First money-like number in the text, 0 if there is none."""
    digits = F.replace(F.regexp_extract(text, AMOUNT_PATTERN, 0), F.lit(","), F.lit(""))
    return F.coalesce(digits.try_cast("double"), F.lit(0.0))


def has_risk_keyword(lowered: Column) -> Column:
    """Whether lower-cased text contains a risk keyword. Pass a column, so that it is lower-cased once."""
    found = F.lit(False)
    for keyword in RISK_KEYWORDS:
        found = found | lowered.contains(keyword)
    return F.coalesce(found, F.lit(False))


def excerpt(text: Column, length: int = EXCERPT_LENGTH) -> Column:
    return F.substring(text, 1, length)


def digest_key(*parts: Column, length: int = 32) -> Column:
    """Leading hex digits of the SHA-256 of the parts joined by ``|``; a null part reads ``None``."""
    joined = F.concat_ws("|", *(F.coalesce(p, F.lit("None")) for p in parts))
    return F.substring(F.sha2(joined, 256), 1, length)
