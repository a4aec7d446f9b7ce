"""Scoring a new season with a fitted model."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import col, round_even
from ..operators.order import top_k


def forecast_top(scored: DataFrame, name: str, prediction: str, k: int = 10, digits: int = 2) -> DataFrame:
    """The k rows with the largest rounded prediction: (name, prediction)."""
    rounded = scored.select(col(name), round_even(prediction, digits).alias(prediction))
    return top_k(rounded, prediction, k, [name])


def with_actuals(top: DataFrame, actuals: DataFrame, name: str) -> DataFrame:
    """Forecast rows beside what happened; ``top`` is a top-k result, small by construction."""
    return actuals.join(F.broadcast(top), name)


def score_season(model: Model, season: DataFrame, name: str, actuals: DataFrame, k: int = 10) -> DataFrame:
    """Predict, keep the k best, join the actual values."""
    return with_actuals(forecast_top(model.transform(season), name, "prediction", k), actuals, name)
