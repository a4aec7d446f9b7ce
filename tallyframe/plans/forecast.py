"""Forecast a season total from rate statistics of a season: features, three models, top ten."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import col
from ..ml.kernel import KernelRegression
from ..ml.linear import least_squares
from ..ml.metrics import regression_metrics
from ..ml.neighbors import knn_regress
from ..ml.prep import assembler, hash_split
from ..ml.score import forecast_top, with_actuals
from ..operators.frame import rename_all
from ..session import durable

COLUMNS = ["Player", "Pos_x", "G_x", "MP_x", "PS/G", "AST", "TRB", "3P%", "FG%", "FT%", "eFG%", "VORP", "TS%", "BPM", "PER", "WS"]
NAMES = ["Player", "Pos", "G", "MP", *COLUMNS[4:]]
FEATURES = ["PS/G", "TS%", "TRB", "VORP", "PER", "MP"]
TARGET = "WS"
MODELS = ("linear", "kernel", "neighbors")


def season_stats(joined: DataFrame) -> DataFrame:
    """The columns used, under their short names."""
    return rename_all(joined.select(*[col(c) for c in COLUMNS]), NAMES)


def regulars(season: DataFrame, min_games: float = 30, min_minutes: float = 25) -> DataFrame:
    """Players with more than the given games and minutes (both strict)."""
    return season.where((col("G") > min_games) & (col("MP") > min_minutes))


def _vectors(season: DataFrame, features: Sequence[str], key: str, target: str) -> DataFrame:
    whole = season.select(col(key), *[col(f).cast("double") for f in features], col(target).cast("double").alias("label")).dropna()
    return assembler(features).transform(whole).select(col(key), "features", "label")


def fit(
    model: str, train: DataFrame, features: Sequence[str] = FEATURES, key: str = "Player", target: str = TARGET
) -> Callable[[DataFrame], DataFrame]:
    """Fit a model ('linear', 'kernel' or 'neighbors') and return how it scores a season: (key, label, prediction)."""
    known = durable(_vectors(train, features, key, target))  # models read it many times
    if model == "neighbors":
        def apply(rows: DataFrame) -> DataFrame:
            return knn_regress(known, rows, "features", "label", key)
    else:
        apply = (least_squares() if model == "linear" else KernelRegression()).fit(known).transform
    return lambda season: apply(_vectors(season, features, key, target)).select(col(key), "label", "prediction")


def evaluate(
    season: DataFrame, models: Sequence[str] = MODELS, features: Sequence[str] = FEATURES, key: str = "Player",
    target: str = TARGET, test_percent: int = 25, seed: int = 99,
) -> DataFrame:
    """R2 on the training rows and mse, mae, r2 on the held-out rows, per model."""
    train, test = hash_split(season, key, test_percent, seed)
    out = None
    for model in models:
        score = fit(model, train, features, key, target)
        fitted, held = (regression_metrics(score(part), "label", "prediction") for part in (train, test))
        row = held.withColumn("train_r2", fitted.select("r2").scalar()).withColumn("model", F.lit(model))
        out = row if out is None else out.unionByName(row)
    return out.select("model", "train_r2", "n", "mse", "mae", "r2")


def top_ten(
    model: str, train: DataFrame, season: DataFrame, actuals: DataFrame, features: Sequence[str] = FEATURES,
    key: str = "Player", target: str = TARGET,
) -> DataFrame:
    """The ten largest forecasts of a season beside the actual totals."""
    top = forecast_top(fit(model, train, features, key, target)(season), key, "prediction")
    return with_actuals(top.withColumnRenamed("prediction", f"{target}_pred"), actuals.select(col(key), col(target)), key)
