"""Domain metrics as column expressions over the usual box-score names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import col, ratio, round_even, total


def batting_average(digits: int = 3) -> Column:
    return round_even(ratio("H", "AB"), digits)


def total_bases() -> Column:
    singles = col("H") - col("HR") - col("3B") - col("2B")
    return col("2B") * 2 + col("3B") * 3 + col("HR") * 4 + singles


def on_base(digits: int = 3) -> Column:
    reached = total("H", "BB", "HBP")
    chances = total("AB", "BB", "HBP", "SF")
    return round_even(ratio(reached, chances), digits)


def slugging(bases: Column | str = "TB", digits: int = 3) -> Column:
    return round_even(ratio(bases, "AB"), digits)


def on_base_plus_slugging(digits: int = 3) -> Column:
    """Sum of the two already rounded rates, rounded again."""
    return round_even(col("OBP") + col("SLG"), digits)


def minutes_per_game(digits: int | None = 1) -> Column:
    """MP / G; ``digits=None`` leaves it unrounded."""
    value = ratio("MP", "G")
    return value if digits is None else round_even(value, digits)


def draft_class(rookie_year: Column | str = "Rookie Year") -> Column:
    return col(rookie_year) - F.lit(1)


GRADES = range(3, 9)


def tests_taken(subject: str) -> Column:
    """Tested students over grades 3 to 8; NULL if any grade is NULL.

    The source file spells the grade 3 Math column with a lower-case 'tested'.
    """
    names = [
        f"Grade {g} {subject} - All Students " + ("tested" if (subject, g) == ("Math", 3) else "Tested")
        for g in GRADES
    ]
    return total(*names)
