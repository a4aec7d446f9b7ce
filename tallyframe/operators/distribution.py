"""The numbers behind distribution charts: histograms, densities, box statistics, point sets."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.binning import edge_code, equal_width_bin
from ..functions.numeric import col, ratio
from .bounded import join_lookup
from .clean import quantile_edges
from .quantiles import ACCURACY, quantiles


def histogram(df: DataFrame, name: str, bins: int = 10) -> DataFrame:
    """Equal-width bins between minimum and maximum: rows (bin, low, high, n), empty bins included."""
    x = col(name).cast("double")
    bounds = df.agg(F.struct(F.min(x).alias("low"), F.max(x).alias("high"))).scalar()
    low, high = bounds.getField("low"), bounds.getField("high")
    counts = (
        df.where(x.isNotNull()).select(equal_width_bin(x, low, high, bins).alias("bin"))
        .groupBy("bin").agg(F.count("*").alias("n"))
    )
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    width = (high - low) / F.lit(float(bins))
    return every.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (low + width * F.col("bin")).alias("low"),
        (low + width * (F.col("bin") + 1)).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def histogram_density(df: DataFrame, name: str, bins: int = 10) -> DataFrame:
    """Histogram scaled to area 1."""
    counts = histogram(df, name, bins)
    whole = df.agg(F.count(col(name))).scalar()
    width = F.col("high") - F.col("low")
    return counts.withColumn("density", ratio(F.col("n"), whole * width))


def kernel_density(df: DataFrame, name: str, by: str, points: int = 50, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density per category on an even grid (Scott bandwidth, grid ``cut`` widths beyond the data).

    Every row adds to every grid point, one sum each; only one row of sums per category leaves a task.
    """
    rows = df.select(col(by).alias("category"), col(name).cast("double").alias("v")).dropna()
    stats = (
        rows.groupBy("category")
        .agg(F.count("*").alias("n"), F.stddev_samp("v").alias("s"), F.min("v").alias("a"), F.max("v").alias("b"))
        .where("s > 0")
        .withColumn("h", F.col("s") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
        .select(
            "category", "n", "h",
            (F.col("a") - cut * F.col("h")).alias("start"),
            ((F.col("b") - F.col("a") + 2 * cut * F.col("h")) / (points - 1)).alias("step"),
        )
    )
    joined = join_lookup(rows, stats, ["category"])

    def height(point: int):
        z = (F.col("start") + point * F.col("step") - F.col("v")) / F.col("h")
        return F.sum(F.exp(-0.5 * z * z))

    grid = joined.groupBy("category", "n", "h", "start", "step").agg(F.array(*[height(p) for p in range(points)]).alias("s"))
    each = grid.select("*", F.posexplode("s").alias("point", "height"))
    density = F.col("height") / (F.col("n") * F.col("h") * math.sqrt(2 * math.pi))
    return each.select(F.col("category").alias(by), "point", (F.col("start") + F.col("point") * F.col("step")).alias("x"), density.alias("density"))


def box_stats(df: DataFrame, name: str, by: str, reach: float = 1.5, accuracy: int = ACCURACY) -> DataFrame:
    """Quartiles, whiskers (last value within reach * IQR) and outlier count per category."""
    rows = df.select(col(by).alias("category"), col(name).cast("double").alias("v")).where("v is not null")
    q = quantiles(rows, ["category"], "v", [0.25, 0.5, 0.75], accuracy).select(
        "category", *[F.get("q", F.lit(i)).alias(c) for i, c in enumerate(("q1", "median", "q3"))]
    )
    v, q1, q3 = F.col("v"), F.col("q1"), F.col("q3")
    low, high = q1 - reach * (q3 - q1), q3 + reach * (q3 - q1)
    return (
        join_lookup(rows, q, ["category"])
        .groupBy(F.col("category").alias(by), "q1", "median", "q3")
        .agg(
            F.count("*").alias("n"),
            F.min(F.when(v >= low, v)).alias("in_low"),
            F.max(F.when(v <= high, v)).alias("in_high"),
            F.count_if((v < low) | (v > high)).alias("outliers"),
        )
        .withColumn("whisker_low", F.least("in_low", "q1"))
        .withColumn("whisker_high", F.greatest("in_high", "q3"))
        .drop("in_low", "in_high")
    )


def point_set(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows of a scatter, swarm or pair chart: all rows with all coordinates present."""
    return df.select(*[col(c) for c in names]).dropna()


def quantile_bins(df: DataFrame, name: str, bins: int = 5, accuracy: int = ACCURACY) -> DataFrame:
    """Add ``code`` 1..bins: equal-count bins, right-closed, lowest value included."""
    return df.withColumn("code", edge_code(col(name), quantile_edges(df, name, bins, accuracy), bins))


def quantile_bin_counts(df: DataFrame, name: str, bins: int = 5) -> DataFrame:
    """Rows (code, low, high, n) of equal-count bins."""
    edges = quantile_edges(df, name, bins)
    counts = (
        df.where(col(name).isNotNull()).select(edge_code(col(name), edges, bins).alias("code"))
        .groupBy("code").agg(F.count("*").alias("n"))
    )
    return counts.select(
        "code", F.get(edges, F.col("code") - 1).alias("low"), F.get(edges, F.col("code")).alias("high"), "n"
    )
