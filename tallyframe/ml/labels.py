"""Class labels of any value for learners that expect 0..k-1."""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .moments import class_labels

class OnClassNumber(Estimator):
    """Fit an estimator on the rank of each label and give its predictions as labels."""

    def __init__(self, estimator: Estimator, label: str = "label"):
        super().__init__()
        self.estimator, self.label = estimator, label

    def _fit(self, dataset: DataFrame) -> Model:
        labels = class_labels(dataset, self.label)
        number = F.array_position(F.lit(labels), F.col(self.label).cast("double")) - 1
        return OnClassNumberModel(self.estimator.fit(dataset.withColumn(self.label, number.cast("double"))), labels)


class OnClassNumberModel(Model):
    def __init__(self, inner: Model, labels: list[float]):
        super().__init__()
        self.inner, self.labels = inner, labels

    def _transform(self, dataset: DataFrame) -> DataFrame:
        label = F.get(F.lit(self.labels), F.col("prediction").cast("int"))
        return self.inner.transform(dataset).withColumn("prediction", label)
