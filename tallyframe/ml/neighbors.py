"""Exact k-nearest-neighbour regression.

The training table is joined by pivots (after Lu et al. 2012): every row belongs to the cell of its nearest
pivot; the distances of the k rows nearest to each pivot bound a query's k-th distance; by the triangle
inequality, and by the planes between pivots, a query needs only the cells it can reach within that bound.
There are as many pivots as a cell has rows on average.  Small cells share a block and large ones are cut into blocks,
queries of a block likewise; a query comes to a block once, with the cells it needs there, and a block sends on only
the k best rows per query.  Each distinct feature vector is asked once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import col
from ..session import durable
from .moments import feature_array, matrix

BLOCK_ROWS = 5_000  # of a block at least
CELL_NUMBERS = 2_000_000  # distances held at once inside a task
STEP_NUMBERS = 30_000  # distances that stay near the processor while their features are added
NEAR_CELLS = 16  # whose rows bound the distance of a query's neighbours
FEW_FEATURES = 8  # up to which distances are summed at once


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances, summed feature by feature (no cancellation)."""
    out = np.zeros((len(a), len(b)))
    for rows in steps(len(a), len(b), STEP_NUMBERS):
        part = out[rows]
        for j in range(a.shape[1]):
            part += (a[rows, j, None] - b[None, :, j]) ** 2
    return out


def steps(n: int, width: int, numbers: int) -> Iterator[slice]:
    """Parts of n rows that hold about so many numbers each."""
    step = max(1, numbers // max(1, width))
    for start in range(0, n, step):
        yield slice(start, min(n, start + step))


def nearest_pairs(a: np.ndarray, b: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row of a the k nearest rows of b (earlier row wins a tie): row of a, row of b, distance, nearest first.

    Products find which rows may be among the k, with their rounding allowed for; the distances of those are summed
    feature by feature.
    """
    k, out = min(k, len(b)), []
    norms, b_norms = (a**2).sum(axis=1), (b**2).sum(axis=1)
    by_products = a.shape[1] > FEW_FEATURES and np.isfinite(norms).all() and np.isfinite(b_norms).all()
    for rows in steps(len(a), len(b), CELL_NUMBERS):
        if by_products:
            block = norms[rows, None] + b_norms - 2 * (a[rows] @ b.T)
            slack = 16 * (a.shape[1] + 8) * np.finfo(float).eps * (norms[rows] + b_norms.max(initial=0))
        else:
            block, slack = squared_distances(a[rows], b), 0.0
        limit = np.partition(block, k - 1, axis=1)[:, k - 1] + slack
        i, j = np.nonzero(block <= limit[:, None])
        d = block[i, j]
        if by_products:
            d = np.zeros(len(i))
            for f in range(a.shape[1]):
                d += (a[rows][i, f] - b[j, f]) ** 2
        order = np.lexsort((j, d, i))
        i, j, d = i[order], j[order], d[order]
        best = np.arange(len(i)) - np.searchsorted(i, i) < k
        out.append((i[best] + rows.start, j[best], d[best]))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.empty(0, int), np.empty(0, int), np.empty(0))


def nearest(a: np.ndarray, b: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each row of a: its number, the k nearest rows of b (earlier row wins a tie) and their distances."""
    i, j, d = nearest_pairs(a, b, k)
    for row in range(len(a)):
        own = slice(*np.searchsorted(i, [row, row + 1]))
        yield row, j[own], d[own]


def knn_regress(
    train: DataFrame, queries: DataFrame, features: str, target: str, key: str, k: int = 7,
    out: str = "prediction", pivots: int | None = None, block_rows: int | None = None,
) -> DataFrame:
    """Add the mean target of the k nearest training rows to each query row; ties by the training key, then the target.

    Every query row comes back once, whatever its key: repeated and NULL keys are rows like others.  A NULL
    vector or an empty training table gives NULL.  ``pivots`` (default: the root of the training rows) go to the
    driver and to every task; blocks hold ``block_rows`` rows (default: four cells of average size, 5000 at least).
    """
    known = train.select(
        col(key).alias("t_key"), feature_array(train, features).alias("t_x"), col(target).cast("double").alias("t_y")
    ).where(F.col("t_x").isNotNull())
    vectors = queries.select(feature_array(queries, features).alias("q_x")).where(F.col("q_x").isNotNull()).distinct()
    asked = durable(vectors).withColumn("q_key", F.monotonically_increasing_id())  # fixed: the table is a checkpoint
    found = _pivot_join(known, asked, k, pivots, block_rows)
    if found is None:
        return queries.withColumn(out, F.lit(None).cast("double"))
    best = Window.partitionBy("q_key").orderBy("d", "t_key", "t_y")
    kept = found.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= k)
    means = kept.groupBy("q_key").agg(F.avg("t_y").alias("_mean")).join(asked, "q_key").select("q_x", "_mean")
    joined = queries.withColumn("_x", feature_array(queries, features)).join(means, F.col("_x") == F.col("q_x"), "left")
    return joined.select(*[col(c) for c in queries.columns if c != out], F.col("_mean").alias(out))


class Cells:
    """What is known of the cells of training rows: pivots, largest and least distance of a row to its pivot, and the
    distances of the k rows nearest to it."""

    def __init__(self, centres: np.ndarray, radius: np.ndarray, least: np.ndarray, closest: list[np.ndarray]):
        self.centres, self.radius, self.least = centres, radius, least
        self.offsets = np.full((len(closest), max(map(len, closest))), np.inf)
        for i, away in enumerate(closest):
            self.offsets[i, : len(away)] = away
        self.rows = sum(map(len, closest))
        self.apart = np.sqrt(squared_distances(centres, centres))

    def bound(self, x: np.ndarray, k: int) -> np.ndarray:
        """At least the distance of each query to its k-th neighbour, from the cells of the pivots nearest to it."""
        return self._bound(np.sqrt(squared_distances(x, self.centres)), k)

    def _bound(self, d: np.ndarray, k: int) -> np.ndarray:
        some = min(max(k, NEAR_CELLS), len(self.centres))  # each has a row at least
        near = np.argpartition(d, some - 1, axis=1)[:, :some]
        bounds = (np.take_along_axis(d, near, axis=1)[:, :, None] + self.offsets[near]).reshape(len(d), -1)
        at = min(k, self.rows) - 1
        return np.partition(bounds, at, axis=1)[:, at] * (1 + 1e-9)

    def within(self, x: np.ndarray, k: int) -> np.ndarray:
        """Which cells may hold one of the k neighbours.

        The rows of a cell lie between its least and largest distance from the pivot, and on its side of the plane halfway
        to the query's own pivot; a query is at least as far from them as from either border.
        """
        squares = squared_distances(x, self.centres)
        d, own = np.sqrt(squares), squares.argmin(axis=1)
        apart = self.apart[own]
        plane = (squares - squares[np.arange(len(x)), own][:, None]) / np.where(apart > 0, 2 * apart, np.inf)
        border = np.maximum(np.maximum(d - self.radius, self.least - d), plane)
        return border - 1e-9 * d <= self._bound(d, k)[:, None]  # rows on a border are not lost to rounding


def _pivot_join(known: DataFrame, asked: DataFrame, k: int, pivots: int | None, block_rows: int | None) -> DataFrame | None:
    """Rows (q_key, t_key, t_y, d) that contain the k nearest rows of every query; None without training rows."""
    n_rows = known.count()
    if not n_rows:
        return None
    pivots = pivots or math.isqrt(n_rows) + 1
    block_rows = block_rows or max(BLOCK_ROWS, 4 * n_rows // pivots)
    order = F.md5(F.col("t_key").cast("string"))
    centres = np.unique(matrix(pd.Series([r["t_x"] for r in known.orderBy(order).limit(pivots).select("t_x").collect()])), axis=0)

    @F.pandas_udf("cell int, away double")
    def place(x: pd.Series) -> pd.DataFrame:
        x, cell, away = matrix(x), np.zeros(len(x), np.int32), np.zeros(len(x))
        for rows in steps(len(x), len(centres), CELL_NUMBERS):
            d = squared_distances(x[rows], centres)
            cell[rows], away[rows] = d.argmin(axis=1), d.min(axis=1)
        return pd.DataFrame({"cell": cell, "away": np.sqrt(away)})

    # Of identical vectors only the k first by key can ever be among the k nearest.  Read several times, so worked out once.
    same = Window.partitionBy("t_x").orderBy("t_key", "t_y")
    useful = known.withColumn("_copy", F.row_number().over(same)).where(F.col("_copy") <= k)
    placed = durable(useful.withColumn("p", place("t_x")).select("t_key", "t_x", "t_y", "p.cell", "p.away"))
    by_away = Window.partitionBy("cell").orderBy("away", "t_key")
    closest = (
        placed.select("cell", "away", "t_key").withColumn("_rank", F.row_number().over(by_away)).where(F.col("_rank") <= k)
        .groupBy("cell").agg(F.collect_list("away").alias("closest"))  # k numbers per cell
    )
    sizes = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("radius"), F.min("away").alias("least"))
    found = sizes.join(closest, "cell").toPandas()
    numbers = found["cell"].to_numpy()
    cells = Cells(centres[numbers], found["radius"].to_numpy(), found["least"].to_numpy(), [np.array(c) for c in found["closest"]])

    # Cells share a block up to its size; larger ones have several of their own.
    cuts, first = -(-found["n"].to_numpy() // block_rows), np.zeros(len(found), np.int64)
    block, room = -1, 0
    for i, n in enumerate(found["n"]):
        if cuts[i] > 1 or n > room:
            block, room = block + 1, block_rows
        first[i], room = block, 0 if cuts[i] > 1 else room - n
        block += int(cuts[i]) - 1

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A row for each query and block, with the cells that the query needs there."""
        for batch in batches:
            x = matrix(batch["q_x"])
            for rows in steps(len(x), len(numbers), CELL_NUMBERS):
                row, at = np.nonzero(cells.within(x[rows], k))
                row, at, copies = np.repeat(row, cuts[at]), np.repeat(at, cuts[at]), cuts[at]
                unit = first[at] + np.arange(len(at)) - np.repeat(np.cumsum(copies) - copies, copies)
                order = np.lexsort((at, unit, row))
                row, at, unit = row[order], at[order], unit[order]
                starts = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (unit[1:] != unit[:-1])]) if len(row) else np.empty(0, int)
                for some in steps(len(starts), x.shape[1], CELL_NUMBERS):
                    ends = np.append(starts, len(row))[some.start : some.stop + 1]
                    sent = batch.iloc[rows.start + row[starts[some]]]
                    yield sent.assign(unit=unit[starts[some]].astype(np.int32), cells=[numbers[at[s:e]] for s, e in zip(ends[:-1], ends[1:])])

    q_type, t_type = (df.schema[c].dataType.simpleString() for df, c in ((asked, "q_key"), (known, "t_key")))
    visits = asked.select("q_x", "q_key").mapInPandas(visit, f"q_x array<double>, q_key {q_type}, unit int, cells array<int>")
    visitors = {}
    if asked.count() > block_rows:  # else no block has more visitors than that
        visits = durable(visits)
        visitors = {r["unit"]: r["n"] for r in visits.groupBy("unit").agg(F.count("*").alias("n")).collect()}

    def of_cells(values: np.ndarray) -> Column:
        table = np.ones(len(centres), np.int64)
        table[numbers] = values
        return F.get(F.lit(table.tolist()), F.col("cell"))

    query_cuts = F.get(F.lit([-(-visitors.get(u, 0) // block_rows) or 1 for u in range(block + 1)]), F.col("unit"))
    left = visits.withColumn("qb", F.pmod(F.xxhash64("q_key"), query_cuts).cast("int"))
    own = (of_cells(first) + F.pmod(F.xxhash64("t_key"), of_cells(cuts))).cast("int")
    right = placed.drop("away").withColumn("unit", own).withColumn("qb", F.explode(F.sequence(F.lit(0), query_cuts.cast("int") - 1)))

    def compare(q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(t):
            return pd.DataFrame({"q_key": q["q_key"][:0], "t_key": t["t_key"][:0], "t_y": [], "d": []})
        t = t.sort_values(["t_key", "t_y"], kind="stable")
        a, b, held = matrix(q["q_x"]), matrix(t["t_x"]), t["cell"].to_numpy()
        wanted = np.concatenate(q["cells"].to_list())
        asks = np.repeat(np.arange(len(q)), q["cells"].map(len).to_numpy())
        here = np.unique(held)
        if 2 * len(wanted) >= len(q) * len(here):  # most need most cells: all at once
            parts = [(np.arange(len(q)), np.arange(len(t)))]
        else:
            parts = [(asks[wanted == c], np.flatnonzero(held == c)) for c in here]
        found = [(rows[i], cols[j], d) for rows, cols in parts for i, j, d in [nearest_pairs(a[rows], b[cols], k)]]
        i, j, d = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((j, d, i))
        order = order[np.arange(len(i)) - np.searchsorted(i[order], i[order]) < k]
        i, j = i[order], j[order]
        return pd.DataFrame({"q_key": q["q_key"].to_numpy()[i], "t_key": t["t_key"].to_numpy()[j], "t_y": t["t_y"].to_numpy()[j], "d": d[order]})

    block_of = ["unit", "qb"]
    return left.groupBy(*block_of).cogroup(right.groupBy(*block_of)).applyInPandas(
        compare, f"q_key {q_type}, t_key {t_type}, t_y double, d double"
    )
