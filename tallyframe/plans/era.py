"""Compare batting between eras."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import metrics
from ..functions.numeric import col, round_even
from ..operators.order import top_k_by
from ..operators.relate import trend_by_stat
from ..operators.rollup import resum, sum_by
from ..session import durable
from .forecast import evaluate

COUNTS = ["G", "AB", "R", "H", "HR", "RBI", "BB", "2B", "3B", "HBP", "SF"]
RATES = ["AVG", "OPS", "OBP", "SLG"]
PREDICTORS = ["H", "HR", "RBI", "AVG", "OPS", "OBP", "SLG"]
# The two eras compared, first and last year included.
ERAS = {"steroid": (1990, 2003), "modern": (2004, 2016)}


def season_totals(batting: DataFrame, eras: Mapping[str, tuple[int, int]], min_games: int = 100) -> DataFrame:
    """Counts per era, player and year (stints merged), for seasons of more than min_games games.

    All eras come from one scan; the year limits reach it as a filter.  A season that lies in several eras
    is a row of each.
    """
    year = col("yearID")
    first, last = min(a for a, _ in eras.values()), max(b for _, b in eras.values())
    own = F.filter(F.array(*[F.when(year.between(a, b), F.lit(label)) for label, (a, b) in eras.items()]), lambda label: label.isNotNull())
    rows = batting.select("playerID", "yearID", *[col(c) for c in COUNTS]).where(year.between(first, last))
    seasons = sum_by(rows, ["playerID", "yearID"], COUNTS).where(col("G") > min_games)
    return seasons.withColumn("era", F.explode(own))


def career_totals(seasons: DataFrame) -> DataFrame:
    """Qualified seasons summed per era and player."""
    return resum(seasons, ["era", "playerID"], drop=["yearID"])


def with_rates(totals: DataFrame) -> DataFrame:
    """Add AVG, TB, OBP, SLG, OPS."""
    return (
        totals.withColumns({"AVG": metrics.batting_average(), "TB": metrics.total_bases(), "OBP": metrics.on_base()})
        .withColumn("SLG", metrics.slugging())
        .withColumn("OPS", metrics.on_base_plus_slugging())
    )


def fill_rates(rated: DataFrame, names: Sequence[str] = ("OBP", "SLG", "OPS")) -> DataFrame:
    """Replace missing rates by the era's mean, rounded to 3 digits (one row per era is broadcast)."""
    means = rated.groupBy("era").agg(*[round_even(F.avg(c), 3).alias(f"_{c}") for c in names])
    joined = rated.join(F.broadcast(means), "era")
    return joined.withColumns({c: F.coalesce(c, f"_{c}") for c in names}).drop(*[f"_{c}" for c in names])


def era_players(
    batting: DataFrame,
    eras: Mapping[str, tuple[int, int]] = ERAS,
    min_games: int = 100,
    grain: str = "career",
) -> DataFrame:
    """The analysis table: totals and rates per player ('career') or per player and year ('season').

    The totals are checkpointed: filling, ranking and fitting then read them, not the batting lines.
    """
    seasons = season_totals(batting, eras, min_games)
    return fill_rates(with_rates(durable(career_totals(seasons) if grain == "career" else seasons)))


def top_scorers(players: DataFrame, k: int = 100) -> DataFrame:
    """The k players (or seasons) with most runs in each era."""
    tie = [c for c in ("playerID", "yearID") if c in players.columns]
    return top_k_by(players, ["era"], "R", k, tie)


def era_compare(players: DataFrame, stats: Sequence[str] = RATES) -> DataFrame:
    """Per era and rate: number of rows, mean rate, and slope, intercept and r of runs against it."""
    return trend_by_stat(players, stats, "R", by=["era"])


def fit_runs(players: DataFrame, test_percent: int = 20, seed: int = 0) -> DataFrame:
    """R2 of runs predicted from the other totals on held-out players, per era."""
    out = None
    for era in sorted(r["era"] for r in players.select("era").distinct().collect()):  # one row per era
        rows = players.where(col("era") == era)
        scores = evaluate(rows, ["linear"], PREDICTORS, "playerID", "R", test_percent, seed)
        scores = scores.select(F.lit(era).alias("era"), "n", "train_r2", "r2")
        out = scores if out is None else out.unionByName(scores)
    return out
