"""The composed analyses on small made-up tables."""

import pytest
from pyspark.sql import functions as F
from support import rows_of

from tallyframe.ml.linear import RidgeClassifier
from tallyframe.operators import relate
from tallyframe.operators.distribution import histogram
from tallyframe.plans import era, forecast, rating
from tallyframe.sources.csvfiles import PERCENT_COLUMNS, RATING_COLUMNS, SCHOOLS, SEASON_JOINED


def test_forecast_from_a_joined_season(spark):
    n = 240
    base = spark.range(n).select(
        F.format_string("p%03d", "id").alias("Player"), F.lit("C").alias("Pos_x"), (F.col("id") % 60 + 10.0).alias("G_x"),
        (F.col("id") % 37 + 3.0).alias("MP_x"), *[((F.col("id") * (i + 3)) % 41 / 4.0).alias(c) for i, c in enumerate(SEASON_JOINED.names[4:-1])],
    )
    joined = base.withColumn("WS", F.col("PER") * 0.5 + F.col("VORP") + F.col("MP_x") / 10)
    season = forecast.season_stats(joined)
    assert season.columns == forecast.NAMES
    kept = forecast.regulars(season)
    assert kept.agg(F.min("G"), F.min("MP")).first() == (31.0, 26.0)
    assert histogram(kept, "WS", 15).agg(F.sum("n")).first()[0] == kept.count()
    target = relate.corr_with_target(kept, forecast.FEATURES, "WS").collect()
    assert target[0]["r"] >= target[-1]["r"]
    board = forecast.evaluate(kept, ["linear", "neighbors"]).collect()
    assert board[0]["r2"] == pytest.approx(1) and board[0]["mse"] < 1e-9
    top = forecast.top_ten("linear", kept, season, season)
    assert top.count() == 10 and set(top.columns) == {"Player", "WS_pred", "WS"}


def schools(spark, n=260):
    labels = ["Exceeding Target", "Meeting Target", "Approaching Target", "Not Meeting Target"]
    rows = []
    for i in range(n):
        level = min(i % 4, 3)
        row = {f.name: None for f in SCHOOLS.fields}
        row |= {c: f"{(90 - 20 * level + i % 7)}%" for c in PERCENT_COLUMNS}
        row |= {c: labels[(level + (i % 9 == 0)) % 4] for c in RATING_COLUMNS}
        row |= {f.name: 20 + i % 30 for f in SCHOOLS.fields if "Tested" in f.name or "tested" in f.name}
        row |= {
            "School Name": f"school {i}", "SED Code": str(i), "City": "X", "Community School?": "Yes" if i % 3 else "No",
            "School Income Estimate": f"${30 + i % 9},{100 + i}.50 ", "Economic Need Index": 0.2 * level + 0.01 * (i % 5),
            "Average ELA Proficiency": 3.0 - 0.4 * level, "Average Math Proficiency": None if i % 10 == 0 else 2.5,
        }
        if i == 5:
            row["Student Achievement Rating"] = None
        if i == 6:
            row["School Income Estimate"] = None
        if i == 7:
            row["Trust Rating"] = None
        rows.append(tuple(row[f.name] for f in SCHOOLS.fields))
    return spark.createDataFrame(rows, SCHOOLS)


def test_rating_from_raw_schools(spark):
    raw = schools(spark)
    table = rating.final_table(raw)
    assert table.count() == 258
    assert table.select(*[F.count_if(F.col(f"`{c}`").isNull()) for c in table.columns]).first() == (0,) * len(table.columns)
    assert {r[0] for r in table.select(f"`{rating.TARGET}`").distinct().collect()} == {1, 2, 3}
    assert {r[0] for r in table.select("`Percent ELL`").distinct().collect()} <= {0, 1, 2, 3}
    train, test = rating.prepared(table, "SED Code", rating.TARGET, rating.FEATURES)
    assert train.count() + test.count() == 258
    predicted = rating.classify(train, test).persist()
    assert predicted.where("label = prediction").count() > 0.6 * test.count()
    board = rating.compare_models(train, {"RIDGE": RidgeClassifier()}, "SED Code", k=3, metric="f1_macro").collect()
    assert board[0]["mean"] > 0.5
    shares = rating.class_balance(train, predicted).groupBy("side").agg(F.sum("share").alias("s"))
    assert all(r["s"] == pytest.approx(1) for r in shares.collect())
    assert set(rating.classifiers(extra=True)) == {"LSVC", "GNB", "LDA", "RF", "RIDGE", "EXT"}


def test_test_counts_and_binned_counts(spark):
    raw = schools(spark, 8)
    found = rows_of(rating.with_test_counts(raw), "SED Code", "ELA Tests", "Math Tests")
    assert found == [(str(i), 1 if 6 * (20 + i) <= 176 else 2, 1 if 6 * (20 + i) <= 173 else 2) for i in range(8)]
    first = "Grade 3 ELA - All Students Tested"
    assert rating.binned_counts(raw, first).select(f"`{first}`").distinct().collect() == [(2,)]


def test_runs_are_predicted_per_era(spark):
    batting = spark.range(400).select(
        F.format_string("p%d", F.col("id") % 80).alias("playerID"), (1995 + F.col("id") % 20).cast("int").alias("yearID"), F.lit("T").alias("teamID"),
        F.lit(120).cast("long").alias("G"), *[(F.col("id") * (i + 7) % 53 + 60 * (c == "AB") + 10).alias(c) for i, c in enumerate(era.COUNTS[1:])],
    )
    scores = era.fit_runs(era.era_players(batting)).collect()
    assert {r["era"] for r in scores} == set(era.ERAS) and all(r["train_r2"] is not None for r in scores)
