"""Rate schools: clean the school table, derive features, compare classifiers, classify the held-out part."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.binning import ELA_CUTS, MATH_CUTS, count_code, cut_code, share_code
from ..functions.metrics import tests_taken
from ..functions.numeric import col
from ..functions.parse import indicator, merge_category, money_to_number, ordinal, percent_to_fraction
from ..ml.discriminant import DiscriminantAnalysis, gaussian_bayes
from ..ml.linear import LinearSvc, RidgeClassifier
from ..ml.prep import hash_split, preprocessing
from ..ml.select import cross_validate, leaderboard
from ..ml.trees import extra_trees, random_forest
from ..operators.clean import fill_mean, fill_mode
from ..operators.frame import columns_between, drop_missing, map_columns
from ..session import durable
from ..sources.csvfiles import PERCENT_COLUMNS, RATING_COLUMNS

TARGET = "Student Achievement Rating"
INCOME = "School Income Estimate"
MEAN_FILLED = [INCOME, "Economic Need Index", "Student Attendance Rate", "Average ELA Proficiency", "Average Math Proficiency"]
SHARES = [
    "Percent Asian", "Percent Black", "Percent Hispanic", "Percent White", "Student Attendance Rate",
    "Percent of Students Chronically Absent", "Percent ELL",
]
RARE, INTO = "Not Meeting Target", "Approaching Target"
# Codes of the rating labels; the second table keeps the rarest label and maps two to 1.
CODES = {"Exceeding Target": 3, "Meeting Target": 2, "Approaching Target": 1}
CODES_ALL = {"Exceeding Target": 3, "Meeting Target": 2, "Approaching Target": 1, "Not Meeting Target": 1}
FEATURES = [
    "Economic Need Index", INCOME, "Community School?", "Percent ELL", "Percent Asian", "Percent Black",
    "Percent Hispanic", "Percent White", "Student Attendance Rate", "Percent of Students Chronically Absent",
    "Rigorous Instruction Rating", "Collaborative Teachers Rating", "Supportive Environment Rating",
    "Effective School Leadership Rating", "Strong Family-Community Ties Rating", "Trust Rating",
    "Rigorous Instruction %", "Collaborative Teachers %", "Supportive Environment %",
    "Effective School Leadership %", "Strong Family-Community Ties %", "Trust %",
    "Average ELA Proficiency", "Average Math Proficiency",
]


def parsed(schools: DataFrame) -> DataFrame:
    """Rows with a rating and an income; percents and money as numbers."""
    rows = drop_missing(schools, [TARGET, INCOME])
    return map_columns(rows, PERCENT_COLUMNS, percent_to_fraction).withColumn(INCOME, money_to_number(INCOME))


def filled(schools: DataFrame) -> DataFrame:
    """Missing numbers by the column mean, missing ratings by the most frequent rating."""
    return fill_mode(fill_mean(schools, MEAN_FILLED), RATING_COLUMNS)


def with_test_counts(schools: DataFrame) -> DataFrame:
    """Coded totals of ELA and Math tests taken."""
    return schools.withColumns({
        "ELA Tests": cut_code(tests_taken("ELA"), ELA_CUTS),
        "Math Tests": cut_code(tests_taken("Math"), MATH_CUTS),
    })


def coded(schools: DataFrame, codes: Mapping[str, int] = CODES) -> DataFrame:
    """Shares binned, community school as 0/1, ratings as ordered numbers."""
    rows = map_columns(schools, SHARES, share_code).withColumn("Community School?", indicator("Community School?", "Yes"))
    return map_columns(rows, RATING_COLUMNS, lambda c: ordinal(merge_category(c, RARE, INTO), codes))


def binned_counts(schools: DataFrame, first: str) -> DataFrame:
    """Count codes for every column from ``first`` to the last one."""
    return map_columns(schools, columns_between(schools, first, schools.columns[-1]).columns, count_code)


def final_table(schools: DataFrame, key: str = "SED Code") -> DataFrame:
    """From raw school rows to key, name, target and features."""
    rows = coded(filled(parsed(schools)))
    return rows.select(col(key), col("School Name"), col(TARGET), *[col(f) for f in FEATURES])


def classifiers(trees: int = 150, seed: int = 15, extra: bool = False) -> dict[str, Estimator]:
    """The models compared: four, or six with ridge and extremely randomised trees."""
    models: dict[str, Estimator] = {
        "LSVC": LinearSvc(), "GNB": gaussian_bayes(), "LDA": DiscriminantAnalysis(), "RF": random_forest(trees, seed),
    }
    if extra:
        models |= {"RIDGE": RidgeClassifier(), "EXT": extra_trees()}
    return models


def prepared(table: DataFrame, key: str, target: str, features: Sequence[str], test_percent: int = 25, seed: int = 50):
    """Train and test rows (key, label, features), imputed and scaled by the train part.

    The table is checkpointed first: every model reads it many times, and cleaning must not run again.
    """
    numeric = durable(
        table.select(col(key), col(target).cast("double").alias("label"), *[col(f).cast("double").alias(f) for f in features])
    )
    train, test = hash_split(numeric, key, test_percent, seed)
    fitted = preprocessing(features).fit(train)
    return tuple(fitted.transform(part).select(col(key), "label", "features") for part in (train, test))


def compare_models(train: DataFrame, models: Mapping[str, Estimator], key: str, k: int = 15, metric: str = "f1_micro") -> DataFrame:
    """Cross-validated scores of every model, best first."""
    return leaderboard(cross_validate(train, models, "label", key, k, metric))


def classify(train: DataFrame, test: DataFrame, estimator: Estimator | None = None) -> DataFrame:
    """Predicted class of each held-out row."""
    return (estimator or DiscriminantAnalysis()).fit(train).transform(test)


def class_balance(train: DataFrame, predicted: DataFrame) -> DataFrame:
    """Class shares of the training labels and of the predictions: rows (label, side, n, share)."""
    out = None
    for side, df, name in (("train", train, "label"), ("predicted", predicted, "prediction")):
        whole = df.agg(F.count(name)).scalar()
        counts = df.groupBy(F.col(name).cast("double").alias("label")).agg(F.count("*").alias("n"))
        part = counts.select("label", F.lit(side).alias("side"), "n", (F.col("n") / whole).alias("share"))
        out = part if out is None else out.unionByName(part)
    return out
