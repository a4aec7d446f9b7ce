"""Cross-validation and leaderboards."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import Estimator
from pyspark.ml.classification import NaiveBayes
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.order import descending
from ..operators.profile import score_summary
from ..session import durable
from . import folds
from .discriminant import DiscriminantAnalysis
from .labels import OnClassNumber
from .linear import LinearSvc, RidgeClassifier
from .metrics import group_metrics
from .prep import stratified_folds
from .trees import Forest


def cross_validate(
    df: DataFrame, models: Mapping[str, Estimator], label: str, key: str, k: int = 15, metric: str = "f1_micro"
) -> DataFrame:
    """Score of every model on every fold: rows (model, fold, score).

    Linear discriminants, Gaussian naive Bayes and ridge classifiers are solved for all folds from sums per fold; support
    vector classifiers take their steps, and forests grow, for all folds in the same passes.  Any other estimator
    is fitted k times.  Folds are fixed by the key and checkpointed; rows without a label take no part.
    """
    folded = durable(stratified_folds(df.where(F.col(label).isNotNull()), label, key, k))
    cells = []
    joint = {n: m for n, m in models.items() if isinstance(m, (DiscriminantAnalysis, RidgeClassifier, LinearSvc)) or _is_bayes(m)}
    for features in sorted({_features(m) for m in joint.values()}):
        rows = folds.labelled(folded, features, label, "fold")
        sums = folds.fold_sums(rows, k)
        cells.append(folds.held_out(rows, {n: _predictors(m, sums, rows, k) for n, m in joint.items() if _features(m) == features}))
    for name, estimator in models.items():
        if name in joint:
            continue
        if isinstance(estimator, Forest):
            own = {estimator.foldCol: "fold"} | ({} if estimator.getOrDefault("key") else {estimator.key: [key]})
            scored = estimator.copy(own).fit(folded).transform(folded)
        else:
            parts = [estimator.fit(folded.where(F.col("fold") != f)).transform(folded.where(F.col("fold") == f)) for f in range(k)]
            scored = parts[0].select("fold", label, "prediction")
            for part in parts[1:]:
                scored = scored.unionByName(part.select("fold", label, "prediction"))
        pair = [F.col(label).cast("double").alias("actual"), F.col("prediction").cast("double").alias("predicted")]
        cells.append(scored.groupBy(F.lit(name).alias("model"), "fold", *pair).agg(F.count("*").alias("n")))
    whole = cells[0]
    for part in cells[1:]:
        whole = whole.unionByName(part)
    return group_metrics(whole, ["model", "fold"]).select("model", "fold", F.col(metric).alias("score"))


def _is_bayes(model: Estimator) -> bool:
    return isinstance(model, OnClassNumber) and isinstance(model.estimator, NaiveBayes) and model.estimator.getModelType() == "gaussian"


def _features(model: Estimator) -> str:
    return (model.estimator if isinstance(model, OnClassNumber) else model).getFeaturesCol()


def _predictors(model: Estimator, sums: folds.FoldSums, rows: DataFrame, k: int) -> list[folds.Predictor]:
    """What a model predicts in each fold."""
    if isinstance(model, RidgeClassifier):
        return [folds.linear(*found) for found in folds.ridge(sums, rows, model.getOrDefault(model.alphas))]
    if isinstance(model, LinearSvc):
        get = model.getOrDefault
        w = folds.support_vectors(rows, sums.labels, len(sums.centre), sums.counts.sum(), get(model.C), get(model.iterations), k)
        return [folds.linear(sums.labels, w[f][:, :-1], w[f][:, -1]) for f in range(k)]
    sides = [sums.others(f) for f in range(k)]
    if isinstance(model, DiscriminantAnalysis):
        return [folds.linear(*folds.discriminant(one)) for one in sides]
    return [folds.naive_bayes(one) for one in sides]


def leaderboard(scores: DataFrame) -> DataFrame:
    """Mean and population deviation of the fold scores, best model first."""
    return score_summary(scores, ["model"], "score").orderBy(*descending("mean", tie=["model"]))
