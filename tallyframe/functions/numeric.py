"""Arithmetic, rounding, correlation and hashing expressions."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    """A column by name; names with dots, spaces or signs need no quoting by the caller."""
    return F.col(quote(c)) if isinstance(c, str) else c


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def round_even(c: Column | str, digits: int = 0) -> Column:
    """Round half to even on the scaled double (Spark's ``round`` is half-up)."""
    scale = float(10**digits)
    return F.rint(col(c) * F.lit(scale)) / F.lit(scale)


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient; NULL where the denominator is zero."""
    return F.try_divide(col(numerator).cast("double"), col(denominator).cast("double"))


def nan_to_null(c: Column | str) -> Column:
    return F.nanvl(col(c), F.lit(None).cast("double"))


def pearson(x: Column | str, y: Column | str) -> Column:
    """Pearson r over pairs where both are present; NULL if either side is constant.

    ``corr`` raises on a constant column under ANSI, so r is built from the regression sums.
    """
    x, y = col(x).cast("double"), col(y).cast("double")
    spread = F.sqrt(F.regr_sxx(y, x) * F.regr_syy(y, x))
    return F.try_divide(F.regr_sxy(y, x), spread)


def slope(x: Column | str, y: Column | str) -> Column:
    """Slope of the least-squares line y ~ x; NULL if x is constant."""
    x, y = col(x).cast("double"), col(y).cast("double")
    return F.try_divide(F.regr_sxy(y, x), F.regr_sxx(y, x))


def intercept(x: Column | str, y: Column | str) -> Column:
    xd, yd = col(x).cast("double"), col(y).cast("double")
    return F.regr_avgy(yd, xd) - slope(x, y) * F.regr_avgx(yd, xd)


def in_years(c: Column | str, first: int, last: int) -> Column:
    """Date or timestamp within years, both included, as a range that a file scan can skip by."""
    return (col(c) >= F.lit(f"{first}-01-01")) & (col(c) < F.lit(f"{last + 1}-01-01"))


def total(*cols: Column | str) -> Column:
    """Row-wise sum; NULL if any part is NULL."""
    return reduce(add, [col(c) for c in cols])


def sum_or_zero(c: Column | str) -> Column:
    """Sum aggregate in which a group with no values gives 0, not NULL."""
    return F.coalesce(F.sum(col(c)), F.lit(0))


def hash_percent(key: Column | str, seed: int | str = "") -> Column:
    """A number 0..99 fixed by the key alone, so a split never depends on partitioning."""
    text = F.concat(F.coalesce(col(key).cast("string"), F.lit("")), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("bigint") % 100


def square_distance(a: Column | str, b: Column | str) -> Column:
    """Squared Euclidean distance of two numeric arrays, summed left to right."""
    squares = F.zip_with(col(a), col(b), lambda x, y: (x.cast("double") - y) * (x.cast("double") - y))
    return F.aggregate(squares, F.lit(0.0), lambda s, v: s + v)


def caption(pattern: str, *cols: Column | str) -> Column:
    """Formatted text for labels, ``printf`` style."""
    return F.format_string(pattern, *[col(c) for c in cols])
