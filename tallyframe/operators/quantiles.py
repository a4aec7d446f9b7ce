"""Exact linear-interpolated quantiles, per group, at any size.

A mergeable sketch brackets each wanted rank: its error is bounded, so the value of that rank lies between two sketched
values.  One more pass counts the rows between the brackets and keeps the values inside them, and the running count over
these gives the exact value.  A bracket holds a few rows per ten thousand of the group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import col
from .bounded import join_lookup

ACCURACY = 10_000  # a sketched rank is off by the group's rows / ACCURACY at most; groups of up to so many rows are sorted whole
MARGIN = 3  # of such errors, on both sides


def quantiles(df: DataFrame, by: Sequence[str], value: str, probs: Sequence[float], accuracy: int = ACCURACY) -> DataFrame:
    """One row per group: the group columns and ``q``, an array with one quantile per probability."""
    # One struct as the key, so that a NULL group meets itself in the join.
    key = F.struct(*[col(k).alias(k) for k in by], F.lit(0).alias("_all"))
    rows = df.where(col(value).isNotNull()).select(key.alias("_k"), col(value).cast("double").alias("_v"))
    probs = [float(p) for p in probs]
    ends = [min(1.0, max(0.0, p + side * MARGIN / accuracy)) for p in probs for side in (-1, 1)]
    sketch = rows.groupBy("_k").agg(
        F.count("*").alias("_total"), F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.percentile_approx("_v", ends, accuracy).alias("_ends")
    )
    around = [F.struct(F.get("_ends", F.lit(2 * i)).alias("low"), F.get("_ends", F.lit(2 * i + 1)).alias("high")) for i in range(len(probs))]
    whole = F.array(F.struct(F.col("_low").alias("low"), F.col("_high").alias("high")))
    brackets = sketch.select("_k", "_total", F.when(F.col("_total") <= accuracy, whole).otherwise(F.array(*around)).alias("_b"))

    v = F.col("_v")
    inside = F.exists("_b", lambda b: (b["low"] <= v) & (v <= b["high"]))
    passed = F.size(F.filter("_b", lambda b: b["high"] < v))
    counts = (
        join_lookup(rows, brackets, ["_k"])
        .groupBy("_k", "_total", passed.alias("_passed"), F.when(inside, v).alias("_inside"))
        .agg(F.count("*").alias("_n"), F.min("_v").alias("_at"))
    )
    upto = Window.partitionBy("_k").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumn("_end", F.sum("_n").over(upto)).withColumn("_start", F.col("_end") - F.col("_n"))

    def at(rank: Column) -> Column:
        found = F.max(F.when((F.col("_start") <= rank) & (rank < F.col("_end")), F.col("_inside")))
        return F.when(found.isNull(), F.raise_error(F.lit("a wanted rank is outside of its bracket")).cast("double")).otherwise(found)

    picks, q = [], []
    for i, p in enumerate(probs):
        position = F.lit(p) * (F.col("_total") - 1)
        picks += [at(F.floor(position)).alias(f"_lo{i}"), at(F.ceil(position)).alias(f"_hi{i}"), F.max(position - F.floor(position)).alias(f"_f{i}")]
        q.append(F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}"))
    found = ranked.groupBy("_k").agg(*picks)
    return found.select(*[F.col("_k").getField(b).alias(b) for b in by], F.array(*q).alias("q"))


def column_quantiles(df: DataFrame, names: Sequence[str], probs: Sequence[float], accuracy: int = ACCURACY) -> DataFrame:
    """Quantiles of several columns in one pass: rows (column, q)."""
    doubles = df.select(*[col(c).cast("double").alias(c) for c in names])
    long = doubles.unpivot([], [col(c) for c in names], "column", "value")
    return quantiles(long, ["column"], "value", probs, accuracy)
