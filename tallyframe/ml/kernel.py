"""RBF support-vector regression on landmarks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .moments import feature_array, matrix, summed_matrices, width

CANDIDATES = 4  # rows looked at per landmark wanted
TOLERANCE = 1e-5  # of the objective


class _Kernel(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed):
    gamma = Param(Params._dummy(), "gamma", "RBF width", TypeConverters.toFloat)
    C = Param(Params._dummy(), "C", "weight of the loss", TypeConverters.toFloat)
    epsilon = Param(Params._dummy(), "epsilon", "half width of the tube without loss", TypeConverters.toFloat)
    components = Param(Params._dummy(), "components", "landmarks", TypeConverters.toInt)
    iterations = Param(Params._dummy(), "iterations", "most passes over the data", TypeConverters.toInt)


def rbf(x: np.ndarray, landmarks: np.ndarray, gamma: float) -> np.ndarray:
    away = (x**2).sum(axis=1)[:, None] + (landmarks**2).sum(axis=1) - 2 * x @ landmarks.T
    return np.exp(-gamma * np.maximum(away, 0))


def leverages(k: np.ndarray, c: float) -> np.ndarray:
    """How much each row of a kernel matrix weighs in its own ridge prediction: rows alone in their place weigh most."""
    return np.clip(np.diag(k @ np.linalg.inv(k + np.eye(len(k)) / c)), 1e-9, None)


def pick_landmarks(rows: DataFrame, m: int, gamma: float, c: float, seed: int) -> np.ndarray:
    """At most ``m`` distinct rows: of 4 m, first by a hash, those drawn by leverage without replacement."""
    first = rows.select("x").where("x is not null").orderBy(F.xxhash64("x", F.lit(seed)), F.col("x")).limit(CANDIDATES * m).collect()
    if not first:
        raise ValueError("cannot fit on an empty table")
    found = np.unique(np.array([r["x"] for r in first], float), axis=0)
    if len(found) <= m:
        return found
    wait = np.random.default_rng(seed).exponential(size=len(found)) / leverages(rbf(found, found, gamma), c)
    return found[np.sort(np.argsort(wait)[:m])]


class KernelRegression(Estimator, _Kernel, DefaultParamsReadable, DefaultParamsWritable):
    """Minimise |f|^2 / 2 + C * sum of losses beyond the tube, over functions spanned by the kernel at landmarks.

    With as many landmarks as distinct rows this is the kernel solution itself, with fewer its Nystroem approximation
    (landmarks drawn by leverage, Alaoui & Mahoney 2015).  Each iteration is one distributed pass that sums a weighted
    Gram matrix (iteratively reweighted least squares, Perez-Cruz et al. 2000).  A step that does not lower the objective is
    halved, and the fit ends when a full step lowers it by less than 1e-5 of its value.  Hand in a checkpointed table if its
    rows are costly to compute.
    """

    @keyword_only
    def __init__(
        self, *, featuresCol="features", labelCol="label", predictionCol="prediction", gamma=1e-3, C=150.0,
        epsilon=0.3, components=256, iterations=40, seed=99,
    ):
        super().__init__()
        self._setDefault(gamma=1e-3, C=150.0, epsilon=0.3, components=256, iterations=40, seed=99)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> Model:
        get = self.getOrDefault
        c, eps, gamma = get("C"), get("epsilon"), get("gamma")
        rows = dataset.select(
            feature_array(dataset, self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y")
        )
        if width(rows, "x") == 0:
            raise ValueError("no features")
        landmarks = pick_landmarks(rows, get("components"), gamma, c, get("seed"))
        values, vectors = np.linalg.eigh(rbf(landmarks, landmarks, gamma))
        good = values > 1e-10 * values[-1]
        basis = vectors[:, good] / np.sqrt(values[good])
        m = basis.shape[1]

        def one_pass(w: np.ndarray) -> dict[str, np.ndarray]:
            def partial(batch: pd.DataFrame) -> dict[str, np.ndarray]:
                y = batch["y"].to_numpy()
                z = np.hstack([rbf(matrix(batch["x"]), landmarks, gamma) @ basis, np.ones((len(y), 1))])
                residual = y - z @ w
                beyond = np.abs(residual) - eps
                a = np.where(beyond > 0, c / np.maximum(beyond, 1e-3), 0.0)
                target = y - np.sign(residual) * eps
                return {"zz": (z * a[:, None]).T @ z, "zy": z.T @ (a * target), "loss": np.array([np.maximum(beyond, 0).sum()])}

            return summed_matrices(rows, partial, {"zz": (m + 1, m + 1), "zy": (m + 1,), "loss": (1,)})

        penalty = np.eye(m + 1)
        penalty[m, m] = 1e-9
        w, best, best_value, step = np.zeros(m + 1), None, np.inf, 1.0
        w[m] = rows.agg(F.avg("y")).first()[0]
        for _ in range(get("iterations")):
            sums = one_pass(w)
            value = 0.5 * w[:m] @ w[:m] + c * sums["loss"][0]
            if value < best_value:
                settled = step == 1.0 and best_value - value <= TOLERANCE * value
                best, best_value, step = w, value, 1.0
                toward = np.linalg.solve(sums["zz"] + penalty, sums["zy"])
                if settled:
                    break
            else:
                step /= 2
                if step < 1e-3:
                    break
            w = best + step * (toward - best)
        return KernelRegressionModel()._set(
            featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol(), predictionCol=self.getPredictionCol(),
            gamma=gamma, landmarks=landmarks.tolist(), weights=[*(basis @ best[:m]).tolist(), float(best[m])],
        )


class KernelRegressionModel(Model, _Kernel, DefaultParamsReadable, DefaultParamsWritable):
    landmarks = Param(Params._dummy(), "landmarks", "one row of features per landmark", TypeConverters.toList)
    weights = Param(Params._dummy(), "weights", "one weight per landmark, then the offset", TypeConverters.toListFloat)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        gamma, landmarks = self.getOrDefault("gamma"), np.array(self.getOrDefault("landmarks"))
        weights = np.array(self.getOrDefault("weights"))

        @F.pandas_udf("double")
        def score(x: pd.Series) -> pd.Series:
            return pd.Series(rbf(matrix(x), landmarks, gamma) @ weights[:-1] + weights[-1] if len(x) else np.empty(0))

        return dataset.withColumn(self.getPredictionCol(), score(feature_array(dataset, self.getFeaturesCol())))
