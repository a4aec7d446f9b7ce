"""Numeric codes by cut points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import col

# Quintile limits for the two test-count columns.
ELA_CUTS = (176, 253, 324, 454)
MATH_CUTS = (173, 251, 325, 454)


def share_code(c: Column | str) -> Column:
    """0 -> 0, (0, .33] -> 1, (.33, .67] -> 2, everything else (also negative and NULL) -> 3."""
    x = col(c)
    return (
        F.when(x == 0, 0)
        .when((x > 0) & (x <= 0.33), 1)
        .when((x > 0.33) & (x <= 0.67), 2)
        .otherwise(3)
    )


def count_code(c: Column | str, keep_gap: bool = True) -> Column:
    """Steps of 15 up to 75, everything else -> 5.

    The original rule has no branch for (45, 60], which therefore falls to 5, and (60, 75] is 4.
    ``keep_gap=False`` codes (45, 75] as 4.
    """
    x = col(c)
    fourth = 60 if keep_gap else 45
    out = F.when(x == 0, 0)
    for code, low, high in ((1, 0, 15), (2, 15, 30), (3, 30, 45), (4, fourth, 75)):
        out = out.when((x > low) & (x <= high), code)
    return out.otherwise(5)


def cut_code(c: Column | str, cuts: Sequence[float]) -> Column:
    """Codes 1..len(cuts)+1, right-closed.  NULL stays NULL and negative values stay as they are."""
    x = col(c)
    out = F.when(x < 0, x)
    for code, limit in enumerate(cuts, start=1):
        out = out.when(x <= limit, F.lit(code))
    return out.when(x.isNotNull(), F.lit(len(cuts) + 1))


def edge_code(c: Column | str, edges: Column, bins: int) -> Column:
    """Codes 1..bins from an array of bins+1 edges: right-closed, lowest edge included."""
    x = col(c)
    out = F.when(x < F.get(edges, F.lit(0)), None)
    for code in range(1, bins + 1):
        out = out.when(x <= F.get(edges, F.lit(code)), F.lit(code))
    return out


def equal_width_bin(c: Column | str, low: Column, high: Column, bins: int) -> Column:
    """0-based equal-width bin; the top edge belongs to the last bin; a constant gives bin 0."""
    x = col(c).cast("double")
    position = F.try_divide((x - low) * F.lit(float(bins)), high - low)
    return F.when(
        x.isNotNull(), F.least(F.floor(F.coalesce(position, F.lit(0.0))), F.lit(bins - 1)).cast("int")
    )
