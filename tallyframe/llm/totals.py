"""Row numbers and running sums inside groups of any size."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bucket_count(n_rows: int) -> int:
    """As many buckets per group as a bucket of the whole table has rows: both grow with the root of the input."""
    return max(1, math.isqrt(max(0, n_rows)))


def running(df: DataFrame, group: list[str], place: Column, ties: list[Column], value: Column, n_buckets: int, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` (a whole number) over the rows of the same group that come earlier.

    ``place`` in [0, 1) is the order, ``ties`` decide between equal places.  No task sees a whole group: rows
    are ordered inside buckets of the place, and a bucket starts from the total of the buckets before it.
    Group columns must not be NULL; an empty table stays empty.
    """
    bucket = F.least(F.floor(F.col("__place") * n_buckets), F.lit(n_buckets - 1)).cast("long")
    own = df.withColumns({"__place": place, "__value": value.cast("long")}).withColumn("__bucket", bucket)
    keys = [*group, "__bucket"]
    sums = own.groupBy(*keys).agg(F.sum("__value").alias("__sum"))
    earlier = Window.partitionBy(*group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*keys, F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(*keys).orderBy("__place", *ties).rowsBetween(Window.unboundedPreceding, -1)
    ordered = own.withColumn("__inside", F.coalesce(F.sum("__value").over(inside), F.lit(0)))
    return ordered.join(starts, keys).withColumn(name, F.col("__start") + F.col("__inside")).select(*df.columns, name)
