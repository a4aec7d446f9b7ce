"""Compare careers between rookie cohorts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from ..functions.metrics import draft_class, minutes_per_game
from ..functions.numeric import col
from ..functions.parse import strip_marker
from ..operators.bounded import join_lookup
from ..operators.frame import drop_value, keep_values
from ..operators.order import descending, with_position
from ..operators.rollup import aggregate_by
from ..sources.csvfiles import SEASON_RATES

MEANS = SEASON_RATES
SPEC = {"G": ["sum"], "MP": ["sum"], **{c: ["mean"] for c in MEANS}}


def regular_seasons(
    seasons: DataFrame, years: Sequence[int], min_mpg: float = 20, digits: int | None = 1
) -> DataFrame:
    """Seasons in the years, without subtotal rows, of players with enough minutes per game.

    ``digits=1`` rounds minutes per game before the comparison, ``None`` does not.
    """
    rows = keep_values(seasons, "Year", years).withColumn("MPG", minutes_per_game(digits))
    rows = drop_value(rows.where(col("MPG") >= min_mpg), "Tm", "TOT")
    return rows.withColumn("Player", strip_marker("Player"))


def rookies(players: DataFrame, rookie_years: Sequence[int]) -> DataFrame:
    return keep_values(players, "Rookie Year", rookie_years).withColumn("Player", strip_marker("Player"))


def cohort_table(
    seasons: DataFrame, rookie_players: DataFrame, spec: Mapping[str, Sequence[str]] = SPEC
) -> DataFrame:
    """Aggregate the seasons of each draft class (rookie year - 1)."""
    joined = join_lookup(seasons, rookie_players.select("Player", col("Rookie Year")), ["Player"])
    return aggregate_by(joined.withColumn("Draft Class", draft_class()), ["Draft Class"], spec)


def ranked_cohorts(cohorts: DataFrame, metric: str) -> DataFrame:
    """Cohorts from best to worst on a metric, with their position."""
    return with_position(cohorts, descending(metric, tie=["Draft Class"])).orderBy("position")


def compare_cohorts(
    seasons: DataFrame,
    players: DataFrame,
    years: Sequence[int],
    rookie_years: Sequence[int],
    min_mpg: float = 20,
    digits: int | None = 1,
    spec: Mapping[str, Sequence[str]] = SPEC,
) -> DataFrame:
    return cohort_table(regular_seasons(seasons, years, min_mpg, digits), rookies(players, rookie_years), spec)
