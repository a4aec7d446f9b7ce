"""Inner equi-joins with suffixes for clashing names, optional NULL matching and salting of hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import col
from ..session import durable

HOT_SHARE = 1 / 1000  # a key with more of the rows is hot, so there are at most 1000 of them


def hot_keys(df: DataFrame, on: Sequence[str], share: float = HOT_SHARE) -> DataFrame:
    """Keys that hold more than a share of all rows: at most 1 / share rows."""
    counts = df.groupBy(*[col(c) for c in on]).agg(F.count("*").alias("_n"))
    return counts.where(F.col("_n") > df.agg(F.count("*")).scalar() * share).drop("_n")


def _same(left: Sequence[str], right: Sequence[str], null_safe: bool) -> Column:
    pairs = zip(left, right)
    return reduce(and_, [col(a).eqNullSafe(col(b)) if null_safe else col(a) == col(b) for a, b in pairs])


def merge(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    suffixes: tuple[str, str] = ("_x", "_y"),
    null_safe: bool = False,
    salts: int = 1,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Inner join on equal keys; other columns found on both sides get a suffix.

    Many-to-many, as a join should be.  With ``null_safe`` a NULL key matches a NULL key.  No side is
    hinted: the optimizer broadcasts by size and adaptive execution splits large partitions.  With
    ``salts`` above 1 the left rows of each hot key are spread over that many tasks and the right rows
    of those keys, and only those, are repeated for each.  ``hot`` is a table of the hot keys from an earlier
    count (``hot_keys``, at most 1 / HOT_SHARE rows); without it the keys are counted once, here.
    """
    on = list(on)
    clash = (set(left.columns) & set(right.columns)) - set(on)
    a = left.withColumnsRenamed({c: c + suffixes[0] for c in clash})
    b = right.withColumnsRenamed({c: c + suffixes[1] for c in clash})
    theirs = [f"__{c}" for c in on]
    b = b.withColumnsRenamed(dict(zip(on, theirs)))
    match = _same(on, theirs, null_safe)
    if salts > 1:
        marks = [f"__hot_{i}" for i in range(len(on))]
        found = durable(hot_keys(left, on)) if hot is None else hot.select(*[col(c) for c in on]).distinct()
        if hot is not None and found.limit(round(1 / HOT_SHARE) + 1).count() > round(1 / HOT_SHARE):
            raise ValueError(f"more than {round(1 / HOT_SHARE)} hot keys")
        hot = F.broadcast(found.toDF(*marks).withColumn("__hot", F.lit(True)))
        a = a.join(hot, _same(on, marks, null_safe), "left").drop(*marks)
        spread = F.pmod(F.xxhash64(*[col(c) for c in a.columns]), F.lit(salts))
        a = a.withColumn("__salt", F.when(F.col("__hot"), spread).otherwise(F.lit(0))).drop("__hot")
        b = b.join(hot, _same(theirs, marks, null_safe), "left").drop(*marks)
        every = F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        b = b.withColumn("__their_salt", F.explode(every)).drop("__hot")
        match = match & (F.col("__salt") == F.col("__their_salt"))
    return a.join(b, match, "inner").drop(*theirs, "__salt", "__their_salt").select(
        *[col(c) for c in on], *[col(c) for c in a.columns if c not in on and c != "__salt"],
        *[col(c) for c in b.columns if c not in theirs and c != "__their_salt"],
    )
