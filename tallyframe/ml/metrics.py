"""Scores of predictions, each from one grouped pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import col


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row: n, mse, mae, r2 (against the mean of the evaluated rows)."""
    y, p = col(actual).cast("double"), col(predicted).cast("double")
    return df.agg(
        F.count(y).alias("n"),
        F.avg((y - p) * (y - p)).alias("mse"),
        F.avg(F.abs(y - p)).alias("mae"),
        (1 - F.try_divide(F.avg((y - p) * (y - p)), F.var_pop(y))).alias("r2"),
    )


def confusion(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Rows (actual, predicted, n)."""
    return df.groupBy(
        col(actual).cast("double").alias("actual"), col(predicted).cast("double").alias("predicted")
    ).agg(F.count("*").alias("n"))


def class_scores(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Precision, recall and F1 per class seen among actual or predicted labels."""
    cells = confusion(df, actual, predicted)
    sides = F.array(
        F.struct(F.col("actual").alias("label"), F.col("n").alias("support"), F.lit(0).cast("long").alias("claimed")),
        F.struct(F.col("predicted").alias("label"), F.lit(0).cast("long").alias("support"), F.col("n").alias("claimed")),
    )
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    both = cells.select(F.explode(sides).alias("s"), hit.alias("hit")).select("s.*", "hit")
    totals = both.groupBy("label").agg(
        F.sum("support").alias("support"),
        F.sum("claimed").alias("claimed"),
        F.sum(F.when(F.col("support") > 0, F.col("hit")).otherwise(0)).alias("hits"),
    )
    return totals.select(
        "label",
        "support",
        F.coalesce(F.try_divide("hits", "claimed"), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide("hits", "support"), F.lit(0.0)).alias("recall"),
        (F.col("hits") * 2.0 / (F.col("support") + F.col("claimed"))).alias("f1"),
    )


def classification_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row: n, micro F1 (for one label per row the accuracy), macro F1 (plain mean over classes)."""
    scores = class_scores(df, actual, predicted)
    return scores.agg(
        F.sum("support").alias("n"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("f1_micro"),
        F.avg("f1").alias("f1_macro"),
    )


def group_metrics(cells: DataFrame, keys: list[str]) -> DataFrame:
    """The same per group, from counts (keys, actual, predicted, n)."""
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("actual").alias("label"), F.col("n").alias("support"), hit.alias("hits")),
        F.struct(F.col("predicted").alias("label"), F.lit(0).cast("long").alias("support"), F.lit(0).cast("long").alias("hits")),
    )
    both = cells.select(*keys, "n", F.explode(sides).alias("s")).select(*keys, "n", "s.*")
    classes = both.groupBy(*keys, "label").agg(F.sum("support").alias("support"), F.sum("hits").alias("hits"), F.sum("n").alias("either"))
    return classes.groupBy(*keys).agg(
        F.sum("support").alias("n"),
        (F.sum("hits") / F.sum("support")).alias("f1_micro"),
        F.avg(F.col("hits") * 2.0 / F.col("either")).alias("f1_macro"),
    )
