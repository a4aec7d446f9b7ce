"""Projections, filters and conditional assignment where plain Spark needs a little care."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import col, quote

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename every column by position."""
    return df.toDF(*names)


def columns_between(df: DataFrame, first: str, last: str) -> DataFrame:
    """Columns from first to last in table order, both included."""
    names = df.columns
    return df.select(*[col(c) for c in names[names.index(first) : names.index(last) + 1]])


def columns_at(df: DataFrame, positions: slice | Sequence[int]) -> DataFrame:
    """Columns by 0-based position: a slice, or a list of positions."""
    names = df.columns
    chosen = names[positions] if isinstance(positions, slice) else [names[i] for i in positions]
    return df.select(*[col(c) for c in chosen])


def names_of_type(df: DataFrame, types: tuple[type, ...]) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types)]


def numeric_names(df: DataFrame) -> list[str]:
    return names_of_type(df, NUMERIC)


def map_columns(df: DataFrame, names: Sequence[str], fn: Callable[[Column], Column]) -> DataFrame:
    """Apply one expression to many columns in a single projection."""
    return df.withColumns({c: fn(col(c)) for c in names})


def keep_values(df: DataFrame, name: str, values: Sequence[Any]) -> DataFrame:
    """Rows whose value is in the list; a run of integers becomes a range the scan can prune by."""
    kinds = set(values)
    if kinds and all(isinstance(v, int) for v in kinds) and max(kinds) - min(kinds) + 1 == len(kinds):
        return df.where(col(name).between(min(values), max(values)))
    return df.where(col(name).isin(list(values)))


def drop_value(df: DataFrame, name: str, value: Any) -> DataFrame:
    """Rows different from value.  NULL rows stay (SQL ``<>`` would drop them)."""
    return df.where(~col(name).eqNullSafe(F.lit(value)))


def drop_missing(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.dropna(subset=[quote(c) if "." in c else c for c in names])


def assign_where(df: DataFrame, mask: Column, name: str, value: Any) -> DataFrame:
    """Set a column where the mask holds; other rows keep their value, or NULL if it is new."""
    rest = col(name) if name in df.columns else F.lit(None)
    new = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(name, F.when(mask, new).otherwise(rest))


def unpivot(df: DataFrame, ids: Sequence[str], names: Sequence[str], label: str, value: str) -> DataFrame:
    """Long form of several columns of one type."""
    return df.unpivot([col(c) for c in ids], [col(c) for c in names], label, value)
