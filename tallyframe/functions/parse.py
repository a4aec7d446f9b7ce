"""Text to number: percents, money, markers, numeric inference."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import col, nan_to_null

# A value counts as a number only if it looks like one: a bare cast would accept '12d' and 'nan'.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def looks_numeric(c: Column | str) -> Column:
    return col(c).rlike(NUMBER)


def number_or_null(c: Column | str) -> Column:
    return F.when(looks_numeric(c), F.trim(col(c)).try_cast("double"))


def _to_double(c: Column, strict: bool) -> Column:
    return nan_to_null(c.cast("double") if strict else number_or_null(c))


def percent_to_fraction(c: Column | str, strict: bool = True) -> Column:
    """'93%' -> 0.93.  NULL stays NULL; malformed text raises, or gives NULL if not strict."""
    return _to_double(F.trim(F.btrim(col(c), F.lit("%"))), strict) / F.lit(100.0)


def money_to_number(c: Column | str, strict: bool = True) -> Column:
    """'$31,141.72 ' -> 31141.72."""
    return _to_double(F.translate(col(c), "$, ", ""), strict)


def strip_marker(c: Column | str, marker: str = "*") -> Column:
    """Remove every occurrence of a literal marker."""
    return F.replace(col(c), F.lit(marker), F.lit(""))


def merge_category(c: Column | str, rare: str, into: str) -> Column:
    return F.when(col(c) == rare, F.lit(into)).otherwise(col(c))


def ordinal(c: Column | str, codes: dict[str, int]) -> Column:
    """Dictionary encoding; labels outside the dictionary give NULL."""
    out = F.lit(None).cast("int")
    for label, code in codes.items():
        out = F.when(col(c) == label, F.lit(code)).otherwise(out)
    return out


def indicator(c: Column | str, value: str) -> Column:
    """1 where the column equals value, else 0 (NULL counts as 0)."""
    return col(c).eqNullSafe(F.lit(value)).cast("int")
