"""Correlation and trend of numeric columns."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import col, intercept, pearson, slope
from .order import descending

BLOCK = 512  # columns whose products with as many others a task sums at a time


def corr_pair(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.agg(pearson(x, y).alias("r"))


def corr_with_target(df: DataFrame, names: Sequence[str], target: str) -> DataFrame:
    """r of each column with the target, strongest positive first."""
    row = df.agg(*[pearson(c, target).alias(c) for c in names])
    long = row.unpivot([], [col(c) for c in names], "column", "r")
    return long.orderBy(*descending("r", tie=["column"]))


def strong_columns(df: DataFrame, names: Sequence[str], target: str, above: float = 0.5) -> DataFrame:
    return corr_with_target(df, names, target).where(F.abs("r") > above)


def _origin(df: DataFrame, names: Sequence[str]) -> np.ndarray:
    """The least finite value of every column over all rows, 0 for a column without one."""
    numbers = df.select(F.array(*[col(c).cast("double") for c in names]).alias("x"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        low = np.full(len(names), np.inf)
        for batch in batches:
            if len(batch):
                x = np.array(batch["x"].tolist(), dtype=np.float64)
                low = np.minimum(low, np.where(np.isfinite(x), x, np.inf).min(axis=0))
        yield pd.DataFrame({"low": [low]})

    low = numbers.mapInPandas(run, "low array<double>").agg(Summarizer.min(array_to_vector(F.col("low")))).first()[0]
    return np.where(np.isfinite(low.toArray()), low.toArray(), 0.0)


def _block_sums(df: DataFrame, left: Sequence[str], right: Sequence[str], at: tuple[int, int], origins: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(i, j, s0 to s5): six sums of column i of one block against every column of another, over rows where both are present."""
    d = len(right)
    numbers = df.select(*[F.array(*[col(c).cast("double") for c in names]).alias(side) for side, names in (("a", left), ("b", right))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((6, len(left), d))
        for batch in batches:
            if len(batch):
                (a, in_a), (b, in_b) = (_shifted(batch[side], origin) for side, origin in zip(("a", "b"), origins))
                for k, (x, y) in enumerate(((in_a, in_b), (a, in_b), (in_a, b), (a * a, in_b), (in_a, b * b), (a, b))):
                    sums[k] += x.T @ y
        yield pd.DataFrame({"i": np.arange(at[0], at[0] + len(left), dtype=np.int32), "line": list(sums.transpose(1, 0, 2).reshape(len(left), -1))})

    lines = numbers.mapInPandas(run, "i int, line array<double>").withColumn("line", array_to_vector("line"))
    totals = lines.groupBy("i").agg(vector_to_array(Summarizer.sum(F.col("line"))).alias("s"))
    each = totals.select("i", "s", F.explode(F.sequence(F.lit(0), F.lit(d - 1))).alias("o"))
    return each.select("i", (F.col("o") + at[1]).alias("j"), *[F.get("s", F.col("o") + k * d).alias(f"s{k}") for k in range(6)])


def _shifted(values: pd.Series, origin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values above the origin, 0 where missing, and 1 where present."""
    x = np.array(values.tolist(), dtype=np.float64)
    here = ~np.isnan(x)
    return np.where(here, x - origin, 0.0), here.astype(np.float64)


def _upper_pairs(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """r of every pair of columns i <= j as rows (i, j, r).

    Columns are cut into blocks, and every pair of blocks is summed in a pass that reads these columns alone: a task sends
    six sums for each pair of columns once, a line per column.  Up to ``BLOCK`` columns are one pass.  Values are
    taken relative to the column's least, so that constant columns have a spread of exactly 0 (r is NULL) and large
    offsets do not cancel.
    """
    names = list(names)
    origin = _origin(df, names)
    starts = range(0, len(names), BLOCK)
    sums = None
    for a in starts:
        for b in starts[a // BLOCK :]:
            ends = (a + BLOCK, b + BLOCK)
            part = _block_sums(df, names[a : ends[0]], names[b : ends[1]], (a, b), (origin[a : ends[0]], origin[b : ends[1]]))
            sums = part if sums is None else sums.unionByName(part)
    n, sx, sy, sxx, syy, sxy = (F.col(f"s{k}") for k in range(6))
    spread = F.sqrt(F.greatest(n * sxx - sx * sx, F.lit(0.0)) * F.greatest(n * syy - sy * sy, F.lit(0.0)))
    return sums.where("i <= j").select("i", "j", F.try_divide(n * sxy - sx * sy, spread).alias("r"))


def corr_matrix(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Every ordered pair of columns as rows (col_a, col_b, r), pairwise-complete."""
    labels = F.array(*[F.lit(c) for c in names])
    upper = _upper_pairs(df, names)
    both = F.array_distinct(
        F.array(F.struct(F.col("i").alias("a"), F.col("j").alias("b")), F.struct(F.col("j").alias("a"), F.col("i").alias("b")))
    )
    return upper.select(F.explode(both).alias("p"), "r").select(
        F.get(labels, F.col("p.a")).alias("col_a"), F.get(labels, F.col("p.b")).alias("col_b"), "r"
    )


def redundant_columns(df: DataFrame, names: Sequence[str], above: float = 0.95) -> DataFrame:
    """Columns whose absolute r with any earlier column exceeds the limit."""
    labels = F.array(*[F.lit(c) for c in names])
    strong = _upper_pairs(df, names).where((F.col("i") < F.col("j")) & (F.abs("r") > above))
    return strong.groupBy("j").agg(F.max(F.abs("r")).alias("max_abs_r")).select(
        F.get(labels, F.col("j")).alias("column"), "max_abs_r"
    )


def corr_submatrix(df: DataFrame, names: Sequence[str], anchor: str, above: float = 0.9) -> DataFrame:
    """The correlation matrix restricted to columns strongly related to an anchor column.

    The columns are picked first (one name per column comes back), so only their pairs are computed.
    """
    near = {row["column"] for row in strong_columns(df, names, anchor, above).collect()}
    return corr_matrix(df, [c for c in names if c in near])


def trend(df: DataFrame, x: str, y: str) -> DataFrame:
    """Slope and intercept of the least-squares line."""
    return df.agg(slope(x, y).alias("slope"), intercept(x, y).alias("intercept"))


def with_trend(df: DataFrame, x: str, y: str, out: str = "trend") -> DataFrame:
    """Add the value of the least-squares line at each row."""
    line = trend(df, x, y).select(F.struct("slope", "intercept")).scalar()
    return df.withColumn(out, line.getField("slope") * col(x) + line.getField("intercept"))


def trend_by_stat(df: DataFrame, stats: Sequence[str], target: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows (by, stat, n, mean, slope, intercept, r): each statistic against one target, all in one pass."""
    aggs = [
        F.struct(
            F.lit(s).alias("stat"),
            F.count("*").alias("n"),
            F.avg(col(s)).alias("mean"),
            slope(s, target).alias("slope"),
            intercept(s, target).alias("intercept"),
            pearson(s, target).alias("r"),
        )
        for s in stats
    ]
    keys = [col(b) for b in by]
    row = df.groupBy(*keys).agg(F.array(*aggs).alias("t"))
    return row.select(*keys, F.inline("t"))
