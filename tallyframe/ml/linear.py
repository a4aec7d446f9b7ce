"""Least squares, ridge classification with exact leave-one-out, and linear scoring."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, Param, Params, TypeConverters
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .folds import support_vectors
from .moments import class_means, feature_array, matrix, one_hot, r_factor, summed_matrices


def dot(x: Column, weights: Sequence[float]) -> Column:
    products = F.zip_with(x, F.lit([float(w) for w in weights]), lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda s, v: s + v)


class _Line(HasFeaturesCol, HasLabelCol, HasPredictionCol):
    weights = Param(Params._dummy(), "weights", "one weight per feature", TypeConverters.toListFloat)
    offset = Param(Params._dummy(), "offset", "value where all features are 0", TypeConverters.toFloat)


class LeastSquares(Estimator, _Line, DefaultParamsReadable, DefaultParamsWritable):
    """Ordinary least squares from the triangle of the centred features and target: a pass for the means and one for it.

    Of directions without any spread the shortest solution is taken.  Rows with a NULL target take no part.
    """

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> LeastSquaresModel:
        both = F.concat(feature_array(dataset, self.getFeaturesCol()), F.array(F.col(self.getLabelCol()).cast("double")))
        rows = dataset.where(F.col(self.getLabelCol()).isNotNull()).select(both.alias("x"))
        n, mean = rows.agg(F.count("*"), Summarizer.mean(array_to_vector(F.col("x")))).first()
        if not n:
            raise ValueError("cannot fit on an empty table")
        mean = mean.toArray()
        r = r_factor(rows, lambda batch: matrix(batch["x"]) - mean, len(mean))
        w = np.linalg.lstsq(r[:, :-1], r[:, -1], rcond=np.finfo(float).eps * max(n, len(mean)))[0]
        names = {p: getattr(self, f"get{p[0].upper()}{p[1:]}")() for p in ("featuresCol", "labelCol", "predictionCol")}
        return LeastSquaresModel()._set(**names, weights=w.tolist(), offset=float(mean[-1] - mean[:-1] @ w))


class LeastSquaresModel(Model, _Line, DefaultParamsReadable, DefaultParamsWritable):
    @property
    def coefficients(self) -> DenseVector:
        return Vectors.dense(self.getOrDefault("weights"))

    @property
    def intercept(self) -> float:
        return self.getOrDefault("offset")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        value = dot(feature_array(dataset, self.getFeaturesCol()), self.getOrDefault("weights")) + F.lit(self.getOrDefault("offset"))
        return dataset.withColumn(self.getPredictionCol(), value)


def least_squares(features: str = "features", label: str = "label") -> LeastSquares:
    return LeastSquares(featuresCol=features, labelCol=label)


class LinearScores(HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """Parameters of a classifier that picks the class with the largest linear score."""

    classes = Param(Params._dummy(), "classes", "class labels in order", TypeConverters.toListFloat)
    weights = Param(Params._dummy(), "weights", "one row of weights per class", TypeConverters.toList)
    offsets = Param(Params._dummy(), "offsets", "one offset per class", TypeConverters.toListFloat)


class LinearScoreModel(Model, LinearScores, DefaultParamsReadable, DefaultParamsWritable):
    """Largest score wins; the lowest label wins a tie."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        x = feature_array(dataset, self.getFeaturesCol())
        scored = [
            F.struct((dot(x, w) + F.lit(b)).alias("score"), F.lit(-c).alias("neg"))
            for c, w, b in zip(self.getOrDefault("classes"), self.getOrDefault("weights"), self.getOrDefault("offsets"))
        ]
        best = F.greatest(*scored) if len(scored) > 1 else scored[0]
        return dataset.withColumn(self.getPredictionCol(), -best.getField("neg"))


def score_model(source: LinearScores, classes, weights, offsets) -> LinearScoreModel:
    return LinearScoreModel()._set(
        featuresCol=source.getFeaturesCol(), labelCol=source.getLabelCol(), predictionCol=source.getPredictionCol(),
        classes=[float(c) for c in classes], weights=[[float(v) for v in row] for row in weights],
        offsets=[float(b) for b in offsets],
    )


class RidgeClassifier(Estimator, LinearScores, DefaultParamsReadable, DefaultParamsWritable):
    """Ridge regression on +1/-1 targets, one per class; the penalty is chosen by exact leave-one-out.

    One pass sums the means, one the centred Gram matrix, and one the leave-one-out errors of all
    penalties: with leverage h, the error of a row left out is its residual / (1 - h).
    """

    alphas = Param(Params._dummy(), "alphas", "penalties to choose from", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", alphas=(0.1, 1.0, 10.0)):
        super().__init__()
        kwargs = dict(self._input_kwargs)
        kwargs["alphas"] = list(kwargs.get("alphas", alphas))
        self._set(**kwargs)

    def _fit(self, dataset: DataFrame) -> LinearScoreModel:
        labels, counts, means = class_means(dataset, self.getFeaturesCol(), self.getLabelCol())
        n, d, k = counts.sum(), means.shape[1], len(labels)
        centre = counts @ means / n
        y_mean = 2 * counts / n - 1
        index = {v: i for i, v in enumerate(labels)}
        rows = dataset.select(
            feature_array(dataset, self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y")
        )

        def centred(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
            return matrix(batch["x"]) - centre, 2 * one_hot(batch["y"], index) - 1 - y_mean

        def gram(batch: pd.DataFrame) -> dict[str, np.ndarray]:
            x, y = centred(batch)
            return {"xx": x.T @ x, "xy": x.T @ y}

        sums = summed_matrices(rows, gram, {"xx": (d, d), "xy": (d, k)})
        alphas = self.getOrDefault(self.alphas)
        inverses = [np.linalg.inv(sums["xx"] + a * np.eye(d)) for a in alphas]
        solutions = [inv @ sums["xy"] for inv in inverses]

        def left_out(batch: pd.DataFrame) -> dict[str, np.ndarray]:
            x, y = centred(batch)
            errors = []
            for inv, w in zip(inverses, solutions):
                leverage = 1 / n + np.einsum("ij,jk,ik->i", x, inv, x)
                errors.append((((y - x @ w) / (1 - leverage)[:, None]) ** 2).sum())
            return {"e": np.array(errors)}

        errors = summed_matrices(rows, left_out, {"e": (len(alphas),)})["e"]
        w = solutions[int(np.argmin(errors))]
        return score_model(self, labels, w.T, y_mean - centre @ w)


class LinearSvc(Estimator, LinearScores, DefaultParamsReadable, DefaultParamsWritable):
    """Linear support vector classifier, one against the rest, squared hinge loss.

    Minimises |w|^2 / 2 + C * sum of max(0, 1 - y w.x)^2 with the offset as one more weight.
    """

    C = Param(Params._dummy(), "C", "weight of the loss", TypeConverters.toFloat)
    iterations = Param(Params._dummy(), "iterations", "most passes over the data", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", C=1.0, iterations=30):
        super().__init__()
        self._setDefault(C=1.0, iterations=30)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> LinearScoreModel:
        rows = dataset.select(
            feature_array(dataset, self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y")
        )
        labels, counts, means = class_means(rows, "x", "y")
        w = support_vectors(rows, labels, means.shape[1], counts.sum(), self.getOrDefault(self.C), self.getOrDefault(self.iterations))[0]
        return score_model(self, labels, w[:, :-1], w[:, -1])
