"""Every query against its SQL twin, or for rows where SQL cannot say it."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, connect
from tallyframe.catalog import QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
SLOW = {"cv_leaderboard", "cv_leaderboard_macro", "random_forest", "extra_trees", "rf_importance", "rating_classifier", "regression_comparison", "top10_kernel"}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SLOW])
def test_query(spark, con, name):
    assert compare(spark, con, name, FOLDER) is None


@pytest.mark.slow
@pytest.mark.parametrize("name", sorted(SLOW))
def test_slow_query(spark, con, name):
    assert compare(spark, con, name, FOLDER) is None


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
