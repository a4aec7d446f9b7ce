"""Grouped sums and means with the missing-value rules of a statistics table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import col, sum_or_zero
from .frame import drop_missing, numeric_names

AGGREGATES = {
    "sum": sum_or_zero,
    "mean": lambda c: F.avg(col(c)),
    "min": lambda c: F.min(col(c)),
    "max": lambda c: F.max(col(c)),
    "count": lambda c: F.count(col(c)),
}


def sum_by(df: DataFrame, keys: Sequence[str], values: Sequence[str] | None = None) -> DataFrame:
    """Sum columns by key (all numeric non-key columns by default); an all-NULL group sums to 0."""
    names = list(values) if values is not None else [c for c in numeric_names(df) if c not in keys]
    return df.groupBy(*[col(k) for k in keys]).agg(*[sum_or_zero(c).alias(c) for c in names])


def resum(df: DataFrame, keys: Sequence[str], drop: Sequence[str]) -> DataFrame:
    """Roll an already summed table up to fewer keys, without the columns named in drop."""
    return sum_by(df.drop(*drop), keys)


def aggregate_by(df: DataFrame, keys: Sequence[str], spec: Mapping[str, Sequence[str]]) -> DataFrame:
    """Per-column aggregate map, e.g. {'G': ['sum'], 'PER': ['mean']} -> G_sum, PER_mean."""
    aggs = [AGGREGATES[fn](c).alias(f"{c}_{fn}") for c, fns in spec.items() for fn in fns]
    return df.groupBy(*[col(k) for k in keys]).agg(*aggs)


def mean_by(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Mean by key over rows with no NULL among keys and values."""
    whole = drop_missing(df, [*keys, *values])
    return whole.groupBy(*[col(k) for k in keys]).agg(*[F.avg(col(v)).alias(v) for v in values])
