"""Filling, inference and encoding over lists of columns."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import col, quote, round_even
from ..functions.parse import looks_numeric, number_or_null
from .frame import numeric_names, unpivot
from .quantiles import ACCURACY, quantiles


def _from_row(stats: DataFrame) -> Column:
    """A one-row table as a struct value (scalar subquery: no join, nothing collected)."""
    return stats.select(F.struct(*[col(c) for c in stats.columns])).scalar()


def fill_mean(df: DataFrame, names: Sequence[str], digits: int | None = None) -> DataFrame:
    """Replace NULL by the column mean, rounded half-even to ``digits`` if given."""
    means = _from_row(df.agg(*[F.avg(col(c)).alias(c) for c in names]))
    filled = {}
    for c in names:
        mean = means.getField(c)
        mean = mean if digits is None else round_even(mean, digits)
        filled[c] = F.coalesce(col(c).cast("double"), mean)
    return df.withColumns(filled)


def column_modes(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows (column, mode, freq, distinct, present) for columns of one type; ties -> smallest value.

    Counted by value in a shuffle rather than with ``mode()``, whose map of all values sits in one task.
    """
    counts = (
        unpivot(df, [], names, "column", "value").where(F.col("value").isNotNull())
        .groupBy("column", "value").agg(F.count("*").alias("n"))
    )
    best = F.min(F.struct((-F.col("n")).alias("neg"), F.col("value").alias("value")))
    return counts.groupBy("column").agg(
        best.alias("best"), F.count("*").alias("distinct"), F.sum("n").alias("present")
    ).select("column", F.col("best.value").alias("mode"), (-F.col("best.neg")).alias("freq"), "distinct", "present")


def fill_mode(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Replace NULL by the column's most frequent value."""
    by_type = defaultdict(list)
    for c in names:
        by_type[df.schema[c].dataType.simpleString()].append(c)
    filled = {}
    for group in by_type.values():
        modes = column_modes(df, group)
        row = modes.agg(*[F.max(F.when(F.col("column") == c, F.col("mode"))).alias(c) for c in group])
        values = _from_row(row)
        filled.update({c: F.coalesce(col(c), values.getField(c)) for c in group})
    return df.withColumns(filled)


def fill_median(df: DataFrame, names: Sequence[str], accuracy: int = ACCURACY) -> DataFrame:
    """Replace NULL by the exact interpolated median."""
    doubles = df.select(*[col(c).cast("double").alias(c) for c in names])
    medians = quantiles(unpivot(doubles, [], names, "column", "value"), ["column"], "value", [0.5], accuracy)
    row = medians.agg(*[F.max(F.when(F.col("column") == c, F.get("q", F.lit(0)))).alias(c) for c in names])
    values = _from_row(row)
    return df.withColumns({c: F.coalesce(col(c).cast("double"), values.getField(c)) for c in names})


def fill_zero(df: DataFrame) -> DataFrame:
    """Replace NULL by 0 in numeric columns and by '0' in text columns."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    fills = {c: F.coalesce(col(c), F.lit(0).cast(df.schema[c].dataType)) for c in numeric_names(df)}
    fills.update({c: F.coalesce(col(c), F.lit("0")) for c in text})
    return df.withColumns(fills)


def infer_numeric(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Turn a text column numeric if at least one of its values is a number; the rest become NULL.

    The schema depends on the data, so one aggregate over all candidate columns runs right away.
    """
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    chosen = [c for c in (names or text) if c in text]
    if not chosen:
        return df
    found = df.agg(*[F.max(looks_numeric(c)).alias(f"c{i}") for i, c in enumerate(chosen)]).first()
    numeric = [c for i, c in enumerate(chosen) if found[f"c{i}"]]
    return df.withColumns({c: number_or_null(c) for c in numeric}) if numeric else df


def one_hot(df: DataFrame, name: str, values: Sequence[str], prefix: str | None = None) -> DataFrame:
    """One 0/1 column per listed value, named prefix_value."""
    stem = prefix or name
    return df.withColumns({f"{stem}_{v}": col(name).eqNullSafe(F.lit(v)).cast("int") for v in values})


def quantile_edges(df: DataFrame, name: str, bins: int, accuracy: int = ACCURACY) -> Column:
    """Edges of equal-count bins as an array value; raises when run if two edges coincide."""
    probs = [i / bins for i in range(bins + 1)]
    q = quantiles(df, [], name, probs, accuracy)
    checked = F.when(F.size(F.array_distinct("q")) == bins + 1, F.col("q")).otherwise(
        F.raise_error(F.lit(f"bin edges of {quote(name)} are not unique"))
    )
    return q.select(checked).scalar()
