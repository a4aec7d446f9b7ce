"""Linear discriminant analysis and Gaussian naive Bayes."""

from __future__ import annotations

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labels import OnClassNumber
from .folds import discriminants
from .linear import LinearScoreModel, LinearScores, score_model
from .moments import class_means, feature_array, matrix, one_hot, r_factor


def gaussian_bayes(features: str = "features", label: str = "label") -> OnClassNumber:
    return OnClassNumber(NaiveBayes(modelType="gaussian", featuresCol=features, labelCol=label), label)


class DiscriminantAnalysis(Estimator, LinearScores, DefaultParamsReadable, DefaultParamsWritable):
    """Classes share one covariance (pooled, divided by n - classes); priors are the class shares.

    Rows less their class mean are reduced to a triangle whose singular values whiten them, so nearly collinear columns do
    not lose what a covariance matrix would.
    """

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> LinearScoreModel:
        labels, counts, means = class_means(dataset, self.getFeaturesCol(), self.getLabelCol())
        index = {v: i for i, v in enumerate(labels)}
        rows = dataset.select(
            feature_array(dataset, self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y")
        )
        r = r_factor(rows, lambda batch: matrix(batch["x"]) - one_hot(batch["y"], index) @ means, means.shape[1])
        _, spread, axes = np.linalg.svd(r)
        return score_model(self, labels, *discriminants(counts, means, spread, axes))
