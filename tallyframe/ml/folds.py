"""Cross-validation without refits: sums per fold, of which every training side is the total less its fold.

One pass gathers, per fold and class, the count, the sums and the sums of squares of all features, and per fold their
products.  Linear discriminants, Gaussian naive Bayes, ridge classification and least squares follow from them for every
fold at once.  What needs the rows themselves (leave-one-out errors of ridge, Newton steps of a support vector classifier)
takes one pass for all folds together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .moments import class_means, feature_array, matrix, one_hot, summed_matrices

PAIRS, PAIRS_BYTES = 1 << 13, 1 << 22  # products of two features that are made once for all folds, and bytes of them at a time

Predictor = Callable[[np.ndarray], np.ndarray]  # features of some rows -> their labels


@dataclass(frozen=True)
class FoldSums:
    """Sums over rows (x - centre), per fold."""

    labels: np.ndarray  # c
    centre: np.ndarray  # d
    counts: np.ndarray  # fold, c
    sums: np.ndarray  # fold, c, d
    squares: np.ndarray  # fold, c, d
    products: np.ndarray  # fold, d, d

    @property
    def folds(self) -> int:
        return len(self.counts)

    def others(self, fold: int) -> FoldSums:
        """The training side of a fold as sums of one fold; classes that have no row there are gone."""
        parts = [a.sum(axis=0) - a[fold] for a in (self.counts, self.sums, self.squares, self.products)]
        seen = parts[0] > 0
        return FoldSums(self.labels[seen], self.centre, *(p[seen][None] for p in parts[:3]), parts[3][None])


def labelled(df: DataFrame, features: str, label: str, fold: str) -> DataFrame:
    """Rows (x, y, fold) for the functions of this module."""
    return df.select(feature_array(df, features).alias("x"), F.col(label).cast("double").alias("y"), F.col(fold).cast("int").alias("fold"))


def fold_sums(rows: DataFrame, k: int) -> FoldSums:
    """The sums of rows (x, y, fold), folds 0 to k - 1: one pass for the centre, one for the rest."""
    labels, counts, means = class_means(rows, "x", "y")
    centre, c, d = counts @ means / counts.sum(), len(labels), means.shape[1]
    index = {v: i for i, v in enumerate(labels)}

    def partial(batch: pd.DataFrame) -> dict[str, np.ndarray]:
        x, y, fold = matrix(batch["x"]) - centre, one_hot(batch["y"], index), batch["fold"].to_numpy()
        own = (fold[:, None] == np.arange(k)).astype(float)
        cell = (own[:, :, None] * y[:, None, :]).reshape(len(x), k * c)
        products = np.vstack([(x * own[:, [f]]).T @ x for f in range(k)])
        return {"n": cell.sum(axis=0), "s": cell.T @ x, "q": cell.T @ x**2, "p": products}

    got = summed_matrices(rows, partial, {"n": (k * c,), "s": (k * c, d), "q": (k * c, d), "p": (k * d, d)})
    return FoldSums(labels, centre, got["n"].reshape(k, c), got["s"].reshape(k, c, d), got["q"].reshape(k, c, d), got["p"].reshape(k, d, d))


def linear(labels: np.ndarray, weights: np.ndarray, offsets: np.ndarray) -> Predictor:
    """The label with the largest linear score, the lowest of equals."""
    return lambda x: labels[(x @ weights.T + offsets).argmax(axis=1)]


def discriminants(counts: np.ndarray, means: np.ndarray, spread: np.ndarray, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and offsets of linear discriminants, from singular values and axes of the rows less their class means.

    Means count from the mean of all rows, which takes one term from the scores of all classes alike and keeps the weights
    small.  Axes without any spread are left out.
    """
    n = counts.sum()
    middle = counts @ means / n
    off = means - middle
    used = spread > spread.max(initial=0) * np.finfo(float).eps * max(n, len(spread))
    axes, spread = axes[: len(spread)][used], spread[used] / np.sqrt(n - len(counts))
    weights = (off @ axes.T / spread**2) @ axes
    return weights, np.log(counts / n) - weights @ middle - 0.5 * np.einsum("ij,ij->i", weights, off)


def discriminant(one: FoldSums) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labels, weights and offsets of the linear discriminants of one table's sums."""
    counts = one.counts[0]
    off = one.sums[0] / counts[:, None]
    values, vectors = np.linalg.eigh(one.products[0] - (off * counts[:, None]).T @ off)
    values = np.where(values > values[-1] * np.finfo(float).eps * len(values), values, 0)
    return one.labels, *discriminants(counts, off + one.centre, np.sqrt(values)[::-1], vectors.T[::-1])


def naive_bayes(one: FoldSums) -> Predictor:
    """Gaussian naive Bayes; a billionth of the largest feature variance is added to every variance."""
    counts, n = one.counts[0][:, None], one.counts[0].sum()
    off = one.sums[0] / counts
    whole = one.squares[0].sum(axis=0) / n - (one.sums[0].sum(axis=0) / n) ** 2
    variance = np.maximum(one.squares[0] / counts - off**2, 0) + 1e-9 * whole.max()
    prior = np.log(one.counts[0] / n) - 0.5 * np.log(2 * np.pi * variance).sum(axis=1)

    def predict(x: np.ndarray) -> np.ndarray:
        away = (x - one.centre)[:, None, :] - off
        return one.labels[(prior - 0.5 * (away**2 / variance).sum(axis=2)).argmax(axis=1)]

    return predict


def ridge(sums: FoldSums, rows: DataFrame, alphas: Sequence[float]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Labels, weights and offsets per fold; each takes the penalty of least leave-one-out error on its training side.

    The Gram matrices come from the sums; one pass adds up the errors of all penalties in all folds."""
    sides = [sums.others(f) for f in range(sums.folds)]
    fits = []
    for one in sides:
        n, counts = one.counts[0].sum(), one.counts[0]
        mean, target = one.sums[0].sum(axis=0) / n, 2 * counts / n - 1
        gram = one.products[0] - n * np.outer(mean, mean)
        cross = 2 * one.sums[0].T - 2 * np.outer(mean, counts)  # sum of (x - mean) times (+1 or -1)
        inverses = [np.linalg.inv(gram + a * np.eye(len(gram))) for a in alphas]
        fits.append((n, mean + one.centre, target, inverses, [inv @ cross for inv in inverses]))

    def errors(batch: pd.DataFrame) -> dict[str, np.ndarray]:
        x, fold, out = matrix(batch["x"]), batch["fold"].to_numpy(), np.zeros((len(sides), len(alphas)))
        for f, (one, (n, mean, target, inverses, solutions)) in enumerate(zip(sides, fits)):
            off = x[fold != f] - mean
            y = 2 * (batch["y"].to_numpy()[fold != f][:, None] == one.labels) - 1 - target
            for a, (inv, w) in enumerate(zip(inverses, solutions)):
                leverage = 1 / n + np.einsum("ij,ij->i", off @ inv, off)
                out[f, a] = (((y - off @ w) / (1 - leverage)[:, None]) ** 2).sum()
        return {"e": out}

    best = summed_matrices(rows, errors, {"e": (len(sides), len(alphas))})["e"].argmin(axis=1)
    out = []
    for one, (_, mean, target, _, solutions), a in zip(sides, fits, best):
        out.append((one.labels, solutions[a].T, target - mean @ solutions[a]))
    return out


def least_squares(sums: FoldSums, target: int) -> list[tuple[np.ndarray, float]]:
    """Weights and offset per fold of the regression of feature ``target`` on the others, from sums without classes."""
    out, rest = [], [i for i in range(len(sums.centre)) if i != target]
    for f in range(sums.folds):
        one = sums.others(f)
        n = one.counts[0].sum()
        mean = one.sums[0].sum(axis=0) / n
        gram = one.products[0] - n * np.outer(mean, mean)
        w = np.linalg.lstsq(gram[np.ix_(rest, rest)], gram[rest, target], rcond=None)[0]
        whole = mean + one.centre
        out.append((w, float(whole[target] - whole[rest] @ w)))
    return out


def support_vectors(rows: DataFrame, labels: np.ndarray, d: int, n: float, c: float, iterations: int, k: int | None = None) -> np.ndarray:
    """Weights (model, class, d + 1) of linear support vector classifiers, one against the rest, squared hinge loss.

    Without ``k`` there is one model, on all rows (x, y); else one per fold, on the rows of the others.  The loss is piecewise
    quadratic, so Newton steps on the rows inside the margin (Keerthi & DeCoste 2005) need few passes, and one pass
    serves all models and classes.  A class whose objective grew goes half the way back.
    """
    index, m, q = {v: i for i, v in enumerate(labels)}, k or 1, len(labels)

    def at(w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Objective, gradient and Hessian per model and class."""
        def partial(batch: pd.DataFrame) -> dict[str, np.ndarray]:
            every, sign = matrix(batch["x"]), 2 * one_hot(batch["y"], index) - 1
            every = np.hstack([every, np.ones((len(every), 1))])
            if k is not None and len(first) <= PAIRS:
                return joint(every, sign, batch["fold"].to_numpy())
            f, g, h = np.zeros((m, q)), np.zeros((m * q, d)), np.zeros((m * q * d, d))
            for i in range(m):
                use = np.ones(len(every), bool) if k is None else batch["fold"].to_numpy() != i
                x, y = every[use], sign[use]
                slack = np.maximum(0.0, 1 - y * (x @ w[i].T))
                f[i], g[i * q : (i + 1) * q] = (slack**2).sum(axis=0), (slack * y).T @ x
                h[i * q * d : (i + 1) * q * d] = np.vstack([(x * (slack[:, [j]] > 0)).T @ x for j in range(q)])
            return {"f": f, "g": g, "h": h}

        def joint(every: np.ndarray, sign: np.ndarray, fold: np.ndarray) -> dict[str, np.ndarray]:
            """The same for all folds at once: a row has no slack in its own, and its products serve every model."""
            f, g, h = np.zeros(m * q), np.zeros((m * q, d)), np.zeros((m * q, len(first)))
            flat, step = w.reshape(m * q, d), max(1, PAIRS_BYTES // (8 * len(first)))
            for at in range(0, len(every), step):
                x, y = every[at : at + step], np.tile(sign[at : at + step], m)
                slack = np.maximum(0.0, 1 - y * (x @ flat.T))
                slack *= np.repeat(fold[at : at + step, None] != np.arange(m), q, axis=1)
                f += (slack**2).sum(axis=0)
                g += (slack * y).T @ x
                columns = np.ascontiguousarray(x.T)
                h += (slack > 0).T.astype(float) @ (columns[first] * columns[second]).T
            whole = np.zeros((m * q, d, d))
            whole[:, first, second] = whole[:, second, first] = h
            return {"f": f.reshape(m, q), "g": g, "h": whole.reshape(m * q * d, d)}

        sums = summed_matrices(rows, partial, {"f": (m, q), "g": (m * q, d), "h": (m * q * d, d)})
        value = 0.5 * (w**2).sum(axis=2) + c * sums["f"]
        return value, w - 2 * c * sums["g"].reshape(m, q, d), np.eye(d) + 2 * c * sums["h"].reshape(m, q, d, d)

    d = d + 1
    first, second = np.triu_indices(d)
    w, best, best_value, steep = np.zeros((m, q, d)), np.zeros((m, q, d)), np.full((m, q), np.inf), np.full((m, q), np.inf)
    for _ in range(iterations):
        value, gradient, hessian = at(w)
        good = value <= best_value * (1 + 1e-12)
        best[good], best_value[good], steep[good] = w[good], value[good], np.abs(gradient[good]).max(axis=1)
        if steep.max() <= 1e-8 * max(1.0, 2 * c * n):
            break
        move = np.linalg.solve(hessian, gradient[..., None])[..., 0]
        w = np.where(good[..., None], w - move, 0.5 * (w + best))
    return best


def held_out(rows: DataFrame, predictors: Mapping[str, Sequence[Predictor]]) -> DataFrame:
    """(model, fold, actual, predicted, n): every row scored by the models of its own fold, counted in one pass."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for fold, part in batch.groupby("fold"):
                x = matrix(part["x"])
                for name, models in predictors.items():
                    pairs = pd.DataFrame({"actual": part["y"].to_numpy(), "predicted": models[int(fold)](x)})
                    counts = pairs.groupby(["actual", "predicted"]).size().rename("n").reset_index()
                    yield counts.assign(model=name, fold=int(fold))[["model", "fold", "actual", "predicted", "n"]]

    schema = "model string, fold int, actual double, predicted double, n long"
    return rows.mapInPandas(run, schema).groupBy("model", "fold", "actual", "predicted").agg(F.sum("n").alias("n"))
