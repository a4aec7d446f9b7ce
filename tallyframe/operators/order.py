"""Sorting, top-k, ranks, running totals, keep-first deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import col, ratio
from ..session import durable


def descending(*names: str, tie: Sequence[str] = ()) -> list[Column]:
    """Order by names descending, missing values last, ties broken by ascending keys."""
    return [col(c).desc_nulls_last() for c in names] + [col(t).asc_nulls_last() for t in tie]


def top_k(df: DataFrame, by: str, k: int, tie: Sequence[str]) -> DataFrame:
    """The k largest rows; each task keeps only k rows, nothing is sorted whole."""
    return df.orderBy(*descending(by, tie=tie)).limit(k)


def first_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Rows 0..n in order, n included, as a label slice counts them."""
    return df.orderBy(*order).limit(n + 1)


def with_position(df: DataFrame, order: Sequence[Column], running: str | None = None) -> DataFrame:
    """Add ``position`` (1-based) and, if asked, ``running_total`` of a column, in a total order.

    Rows are range-partitioned on the full order (so ties of one value split by the next key), sorted inside
    each range, and checkpointed, because range limits are sampled and must not be drawn twice.  A row's place in
    its partition then is its position there; ranges are shifted by the totals of those before them.
    """
    amount = col(running).cast("double") if running else F.lit(0.0)
    sorted_rows = durable(df.repartitionByRange(*order).sortWithinPartitions(*order))
    placed = sorted_rows.withColumn("_id", F.monotonically_increasing_id())  # partition number, then place in it
    ranged = placed.withColumns({"_range": F.shiftright("_id", 33), "_place": F.col("_id").bitwiseAND((1 << 33) - 1)})
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        ranged.groupBy("_range").agg(F.count("*").alias("_n"), F.sum(amount).alias("_s"))
        .select(  # one row per shuffle partition
            "_range",
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_rows"),
            F.coalesce(F.sum("_s").over(before), F.lit(0.0)).alias("_sum"),
        )
    )
    if running:
        upto = Window.partitionBy("_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ranged = ranged.withColumn("running_total", F.sum(amount).over(upto))
    out = ranged.join(F.broadcast(shifts), "_range").withColumn("position", F.col("_place") + 1 + F.col("_rows"))
    if running:
        out = out.withColumn("running_total", F.col("running_total") + F.col("_sum"))
    return out.select(*[col(c) for c in df.columns], "position", *(["running_total"] if running else []))


def cumulative_share(df: DataFrame, name: str, value: str) -> DataFrame:
    """Rows by descending value with ``share`` of the column total and its running sum ``cumulative``.

    The table is read for its total and its rows, so it is checkpointed first.
    """
    rows = durable(df)
    whole = rows.agg(F.sum(col(value).cast("double"))).scalar()
    shared = rows.withColumn("share", ratio(value, whole))
    order = descending(value, tie=[name])
    return with_position(shared, order, "share").withColumnRenamed("running_total", "cumulative")


def count_to_threshold(shares: DataFrame, threshold: float) -> DataFrame:
    """How many leading rows of a cumulative share it takes to exceed the threshold (strictly)."""
    past = shares.where(F.col("cumulative") > threshold)
    return past.agg(F.min("position").alias("needed")).select(
        F.lit(float(threshold)).alias("threshold"), "needed"
    )


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in a stated order.

    The rank-1 filter is pushed below the shuffle, so each task sends one row per key and a hot key
    costs no more than any other.
    """
    window = Window.partitionBy(*[col(k) for k in keys]).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def top_k_by(df: DataFrame, by: Sequence[str], value: str, k: int, tie: Sequence[str]) -> DataFrame:
    """The k largest rows of every group; each task sends at most k rows per group."""
    window = Window.partitionBy(*[col(b) for b in by]).orderBy(*descending(value, tie=tie))
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= k).drop("_rank")
