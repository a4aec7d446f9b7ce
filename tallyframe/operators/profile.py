"""Column profiles, frequencies and shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import col, ratio
from .clean import column_modes
from .frame import INTEGRAL, names_of_type


def _named(names: Sequence[str]):
    """Look a column name up by its 0-based ordinal."""
    return F.get(F.array(*[F.lit(c) for c in names]), F.col("ordinal"))


def _per_column(df: DataFrame, names: Sequence[str], fn, value: str) -> DataFrame:
    """One aggregate per column in a single pass, as rows (ordinal, column, value)."""
    row = df.agg(*[fn(c).alias(str(i)) for i, c in enumerate(names)])
    long = row.unpivot([], [col(c) for c in row.columns], "ordinal", value)
    return long.withColumn("ordinal", F.col("ordinal").cast("int")).withColumn("column", _named(names))


def schema_profile(df: DataFrame) -> DataFrame:
    """Type and non-null count of every column."""
    counts = _per_column(df, df.columns, lambda c: F.count(col(c)), "non_null")
    types = F.get(F.array(*[F.lit(t) for _, t in df.dtypes]), F.col("ordinal"))
    return counts.select("ordinal", "column", types.alias("type"), "non_null")


def null_profile(df: DataFrame) -> DataFrame:
    """Missing values per column, count and share, worst first."""
    row = df.agg(F.count("*").alias("rows"), *[F.count(col(c)).alias(str(i)) for i, c in enumerate(df.columns)])
    long = row.unpivot(["rows"], [col(str(i)) for i in range(len(df.columns))], "ordinal", "present")
    named = long.withColumn("ordinal", F.col("ordinal").cast("int")).withColumn("column", _named(df.columns))
    missing = F.col("rows") - F.col("present")
    return named.select(
        "column", missing.alias("total"), ratio(missing, "rows").alias("percent"), "ordinal"
    ).orderBy(F.desc("percent"), "ordinal").drop("ordinal")


def describe_text(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Count, distinct, most frequent value and its frequency of text columns."""
    return column_modes(df, names).select(
        "column",
        F.col("present").alias("count"),
        F.col("distinct").alias("unique"),
        F.col("mode").alias("top"),
        "freq",
    )


def value_counts(df: DataFrame, name: str, by_value: bool = False) -> DataFrame:
    """Frequency of each value, NULL left out; most frequent first, or in value order."""
    counts = df.where(col(name).isNotNull()).groupBy(col(name)).agg(F.count("*").alias("n"))
    return counts.orderBy(col(name)) if by_value else counts.orderBy(F.desc("n"), col(name))


def frequent_values(df: DataFrame, name: str, above: int = 0) -> DataFrame:
    """Values occurring more often than the floor."""
    return value_counts(df, name).where(F.col("n") > above)


def distinct_values(df: DataFrame, name: str) -> DataFrame:
    return df.select(col(name)).distinct().orderBy(col(name))


def distinct_counts(df: DataFrame, names: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """Distinct values per column (integer columns by default)."""
    chosen = list(names) if names is not None else names_of_type(df, INTEGRAL)
    fn = (lambda c: F.approx_count_distinct(col(c))) if approximate else (lambda c: F.count_distinct(col(c)))
    return _per_column(df, chosen, fn, "distinct").select("column", "distinct")


def distinct_count_distribution(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """How many columns share each distinct count."""
    return value_counts(distinct_counts(df, names), "distinct", by_value=True).withColumnRenamed("n", "columns")


def share_of_total(df: DataFrame, name: str) -> DataFrame:
    """Frequency and share of each value among the non-NULL rows."""
    whole = df.agg(F.count(col(name))).scalar()
    return value_counts(df, name).withColumn("share", ratio("n", whole))


def facet_counts(df: DataFrame, facet: str, category: str) -> DataFrame:
    """Counts by facet and category, long form."""
    return df.groupBy(col(facet), col(category)).agg(F.count("*").alias("n"))


def facet_counts_wide(df: DataFrame, facet: str, category: str, categories: Sequence[str]) -> DataFrame:
    """Counts by facet with one column per listed category."""
    wide = df.groupBy(col(facet)).pivot(category, list(categories)).agg(F.count(F.lit(1)))
    return wide.na.fill(0, subset=list(categories))


def score_summary(df: DataFrame, keys: Sequence[str], score: str) -> DataFrame:
    """Mean and population standard deviation of scores."""
    return df.groupBy(*[col(k) for k in keys]).agg(
        F.avg(col(score)).alias("mean"), F.stddev_pop(col(score)).alias("std")
    )
