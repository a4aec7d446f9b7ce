"""Second moments of a feature matrix, summed where the rows are."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_WIDTH = 4096
MAX_CLASSES = 1000


def feature_array(df: DataFrame, name: str) -> Column:
    """A vector or numeric array column as array<double>."""
    if isinstance(df.schema[name].dataType, VectorUDT):
        return vector_to_array(F.col(name))
    return F.col(name).cast("array<double>")


def matrix(series: pd.Series) -> np.ndarray:
    return np.array(series.tolist(), dtype=np.float64)


def summed_matrices(rows: DataFrame, partial, shapes: dict[str, tuple[int, ...]]) -> dict[str, np.ndarray]:
    """Sum named matrices over the whole table.

    ``partial`` maps a pandas batch to {name: matrix}.  A task adds its batches up and sends each matrix
    once, row by row; rows of one place are summed by key, and only the totals reach the driver.
    """
    if any(np.prod(shape) > MAX_WIDTH**2 for shape in shapes.values()):
        raise ValueError(f"matrices above {MAX_WIDTH} x {MAX_WIDTH} are not gathered on the driver")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = {name: np.zeros(shape) for name, shape in shapes.items()}
        for batch in batches:
            if len(batch):
                for name, part in partial(batch).items():
                    sums[name] += part
        for name, value in sums.items():
            lines = np.atleast_2d(value)
            yield pd.DataFrame({"name": name, "row": range(len(lines)), "line": list(lines)})

    lines = rows.mapInPandas(run, "name string, row int, line array<double>").withColumn("line", array_to_vector("line"))
    totals = lines.groupBy("name", "row").agg(Summarizer.sum(F.col("line")).alias("line"))
    out = {name: np.zeros(np.atleast_2d(np.zeros(shape)).shape) for name, shape in shapes.items()}
    for name, row, line in totals.select("name", "row", vector_to_array("line")).collect():
        out[name][row] = line
    return {name: out[name].reshape(shape) for name, shape in shapes.items()}


FAN, LEVELS = 32, 2  # triangles that one task of a merge stacks, and how often


def r_factor(rows: DataFrame, lines, d: int) -> np.ndarray:
    """The triangle R (d x d) of the QR decomposition of a tall matrix whose lines ``lines(batch)`` gives for each batch.

    A task reduces its batches one onto the other; the triangles of tasks are merged in a tree (Demmel et al. 2012).  R keeps the
    matrix's own condition number, where its products with itself would have the square.  Signs follow a positive diagonal.
    """
    if d > MAX_WIDTH:
        raise ValueError(f"triangles above {MAX_WIDTH} columns are not gathered on the driver")

    def stack(blocks: Iterator[np.ndarray]) -> np.ndarray:
        r = np.zeros((0, d))
        for block in blocks:
            r = np.linalg.qr(np.vstack([r, block]), mode="r")
        return r

    def send(part: int, r: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"part": np.int64(part), "row": np.arange(len(r)), "line": list(r)})

    def reduce_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        r = stack(lines(b) for b in batches if len(b))
        if len(r):
            yield send(TaskContext.get().partitionId(), r)

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["part", "row"])  # one order whatever the shuffle did
        return send(int(group["part"].iloc[0]) // FAN, stack(iter([matrix(group["line"])])))

    schema = "part long, row int, line array<double>"
    triangles = rows.mapInPandas(reduce_rows, schema)
    for _ in range(LEVELS):
        triangles = triangles.groupBy(F.floor(F.col("part") / FAN).alias("g")).applyInPandas(merge, schema)
    got = triangles.orderBy("part", "row").collect()  # one triangle per FAN ** LEVELS tasks
    r = stack(iter([np.array([g["line"] for g in got])])) if got else np.zeros((0, d))
    r = np.vstack([r, np.zeros((d - len(r), d))])
    return r * np.where(np.diag(r) < 0, -1.0, 1.0)[:, None]


def width(df: DataFrame, features: str) -> int:
    row = df.select(F.size(feature_array(df, features)).alias("d")).first()
    if row is None:
        raise ValueError("cannot fit on an empty table")
    return row["d"]


def class_labels(df: DataFrame, label: str) -> list[float]:
    """All label values in order; a column with more than MAX_CLASSES is not a class label."""
    found = df.select(F.col(label).cast("double")).distinct().limit(MAX_CLASSES + 1).collect()
    if len(found) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} classes")
    return sorted(r[0] for r in found)


def class_means(df: DataFrame, features: str, label: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes in order, rows per class, and class means: one grouped pass, one row per class comes back."""
    rows = df.select(F.col(label).cast("double").alias("y"), array_to_vector(feature_array(df, features)).alias("x"))
    sums = rows.groupBy("y").agg(F.count("*").alias("n"), Summarizer.mean(F.col("x")).alias("mean"))
    found = sorted(sums.limit(MAX_CLASSES + 1).collect())
    if len(found) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} classes")
    if not found:
        raise ValueError("cannot fit on an empty table")
    return np.array([r["y"] for r in found]), np.array([r["n"] for r in found], float), np.array([r["mean"].toArray() for r in found])


def one_hot(y: pd.Series, index: dict[float, int]) -> np.ndarray:
    out = np.zeros((len(y), len(index)))
    out[np.arange(len(y)), y.map(index).to_numpy()] = 1.0
    return out
