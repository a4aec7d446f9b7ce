"""Splits, folds, and preprocessing fitted on one table and applied to another."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param.shared import HasInputCols, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import col, hash_percent
from ..operators.bounded import join_lookup
from ..operators.quantiles import column_quantiles


def hash_split(df: DataFrame, key: str, test_percent: int = 25, seed: int | str = "") -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the key: the same rows under any partitioning or retry."""
    part = hash_percent(key, seed)
    train = part < 100 - test_percent
    return df.where(train), df.where(~train)


def stratified_folds(df: DataFrame, label: str, key: str, k: int, out: str = "fold") -> DataFrame:
    """Add a fold 0..k-1 such that folds differ by at most one row per class.

    Rows of a class are numbered in the order of md5(key).  The numbering runs inside 4096 ranges of
    the digest and is shifted by the sizes of the ranges before, so no task sees a whole class.
    Missing labels form a class of their own.
    """
    digest = F.md5(col(key).cast("string"))
    placed = df.withColumn("_digest", digest).withColumn("_range", F.substring("_digest", 1, 3)).withColumn("_label", F.struct(col(label)))
    before = Window.partitionBy("_label").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        placed.groupBy("_label", "_range").agg(F.count("*").alias("_n"))
        .withColumn("_shift", F.coalesce(F.sum("_n").over(before), F.lit(0)))  # at most 4096 rows per class
        .drop("_n")
    )
    inside = Window.partitionBy("_label", "_range").orderBy("_digest", col(key))
    numbered = join_lookup(placed, shifts, ["_label", "_range"]).withColumn("_row", F.row_number().over(inside) - 1)
    fold = ((F.col("_row") + F.col("_shift")) % k).cast("int")
    return numbered.withColumn(out, fold).drop("_digest", "_range", "_label", "_shift", "_row")


class _ByColumn(HasInputCols):
    """Shared parameters: the columns and one or two fitted numbers for each."""

    first = Param(Params._dummy(), "first", "fitted value per column", TypeConverters.toListFloat)
    second = Param(Params._dummy(), "second", "second fitted value per column", TypeConverters.toListFloat)


class MedianImputer(Estimator, _ByColumn, DefaultParamsReadable, DefaultParamsWritable):
    """Fill NULL by the exact interpolated median of the fitting table."""

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> Model:
        names = self.getInputCols()
        found = {r["column"]: r["q"][0] for r in column_quantiles(dataset, names, [0.5]).collect()}
        missing = [c for c in names if c not in found]
        if missing:
            raise ValueError(f"no median: no values in {missing}")
        return MedianImputerModel()._set(inputCols=names, first=[found[c] for c in names])


class MedianImputerModel(Model, _ByColumn, DefaultParamsReadable, DefaultParamsWritable):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        pairs = zip(self.getInputCols(), self.getOrDefault(self.first))
        return dataset.withColumns({c: F.coalesce(col(c).cast("double"), F.lit(m)) for c, m in pairs})


class RangeScaler(Estimator, _ByColumn, DefaultParamsReadable, DefaultParamsWritable):
    """Scale to [0, 1] by the fitting table's range; a constant column goes to 0."""

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> Model:
        names = self.getInputCols()
        aggs = [f(col(c).cast("double")).alias(f"{f.__name__}{i}") for i, c in enumerate(names) for f in (F.min, F.max)]
        row = dataset.agg(*aggs).first()
        low = [row[f"min{i}"] for i in range(len(names))]
        span = [(row[f"max{i}"] - row[f"min{i}"]) or 1.0 for i in range(len(names))]
        return RangeScalerModel()._set(inputCols=names, first=low, second=span)


class RangeScalerModel(Model, _ByColumn, DefaultParamsReadable, DefaultParamsWritable):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        parts = zip(self.getInputCols(), self.getOrDefault(self.first), self.getOrDefault(self.second))
        return dataset.withColumns({c: (col(c).cast("double") - low) / span for c, low, span in parts})


def assembler(names: Sequence[str], out: str = "features") -> VectorAssembler:
    """Feature vector; a NULL left after imputation is an error."""
    return VectorAssembler(inputCols=list(names), outputCol=out, handleInvalid="error")


def preprocessing(names: Sequence[str]) -> Pipeline:
    """Median imputation, range scaling, assembly; fit on train, apply to train and test."""
    names = list(names)
    return Pipeline(stages=[MedianImputer(inputCols=names), RangeScaler(inputCols=names), assembler(names)])
