"""The ways taken beyond a size limit give the same results as the ways below it."""

import tracemalloc

import numpy as np
import pytest
from support import rows_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyframe.ml import neighbors
from tallyframe.ml.neighbors import Cells, knn_regress, nearest
from tallyframe.ml.prep import hash_split, stratified_folds
from tallyframe.operators import bounded, clean, distribution, joins, order, profile
from tallyframe.operators.quantiles import quantiles

PROBS = [0.0, 0.2, 0.25, 0.5, 0.777, 0.99, 1.0]


def skewed(spark, n=6000):
    """A third of the rows in one group, a third of its values equal, the rest long-tailed."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 5 > 0, F.col("id") % 5).alias("g"),
        F.when(F.col("id") % 4 == 0, 7.5).otherwise(F.exp(F.col("id") % 997 / 40.0) - 50).alias("x"),
    )


@pytest.mark.parametrize("by", [[], ["g"]])
def test_quantiles_by_counting(spark, by):
    df = skewed(spark)
    small = {tuple(r[b] for b in by): r["q"] for r in quantiles(df, by, "x", PROBS).collect()}
    large = {tuple(r[b] for b in by): r["q"] for r in quantiles(df, by, "x", PROBS, accuracy=50).collect()}
    assert small.keys() == large.keys()
    for k in small:
        assert large[k] == pytest.approx(small[k], rel=1e-12)


def test_quantiles_by_counting_without_lookup_broadcast(spark, monkeypatch):
    monkeypatch.setattr(bounded, "small_table", lambda df, max_rows=0: None)
    df = skewed(spark, 2000)
    small = {r["g"]: r["q"] for r in quantiles(df, ["g"], "x", PROBS).collect()}
    large = {r["g"]: r["q"] for r in quantiles(df, ["g"], "x", PROBS, accuracy=50).collect()}
    assert all(large[g] == pytest.approx(small[g], rel=1e-12) for g in small)


def test_positions_over_ranges(spark):
    df = skewed(spark).withColumn("id", F.monotonically_increasing_id())
    sort = order.descending("x", tie=["id"])
    window = Window.orderBy(*sort)
    small = df.withColumns({"position": F.row_number().over(window).cast("long"), "running_total": F.sum("x").over(window.rowsBetween(Window.unboundedPreceding, 0))})
    large = order.with_position(df, sort, "x")
    a, b = (
        {r["id"]: (r["position"], r["running_total"]) for r in d.collect()} for d in (small, large)
    )
    assert {k: v[0] for k, v in a.items()} == {k: v[0] for k, v in b.items()}
    assert all(b[k][1] == pytest.approx(a[k][1], rel=1e-9) for k in a)
    assert dict(small.dtypes) == dict(large.dtypes)


def test_cumulative_share_over_ranges(spark):
    df = spark.range(500).select(F.concat(F.lit("f"), "id").alias("f"), (F.col("id") % 9 + 1).alias("v"))
    window = Window.orderBy(F.desc("v"), "f")
    share = F.col("v") / df.agg(F.sum("v")).first()[0]
    upto = F.sum(share).over(window.rowsBetween(Window.unboundedPreceding, 0))
    small = rows_of(df.select("f", F.row_number().over(window).cast("long").alias("position"), F.round(upto, 9)))
    assert small == rows_of(order.cumulative_share(df, "f", "v").select("f", "position", F.round("cumulative", 9)))


def test_lookup_join_without_broadcast(spark):
    big, small = spark.range(100).withColumn("k", F.col("id") % 7), spark.range(7).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    assert rows_of(bounded.join_lookup(big, small, ["k"], max_rows=1)) == rows_of(bounded.join_lookup(big, small, ["k"]))


def test_wide_lookup_rows_stay_off_the_driver(spark, monkeypatch):
    big = spark.range(100).withColumn("k", (F.col("id") % 7).cast("string"))
    lookup = spark.range(7).select(F.col("id").cast("string").alias("k"), F.repeat(F.lit("x"), 1000).alias("v"))
    assert bounded.small_table(lookup, max_bytes=2000) is None and bounded.small_table(lookup).count() == 7
    assert bounded.small_table(lookup, max_rows=6) is None and bounded.small_table(lookup.where("false")).count() == 0
    wanted = rows_of(bounded.join_lookup(big, lookup, ["k"]))
    monkeypatch.setattr(bounded, "BROADCAST_BYTES", 2000)
    assert len(wanted) == 100 and rows_of(bounded.join_lookup(big, lookup, ["k"])) == wanted


def vectors(spark, n, seed, copies=0):
    rng = np.random.default_rng(seed)
    x = np.vstack([rng.normal(size=(n, 5)), np.tile([0.1] * 5, (copies, 1))])
    rows = [(i, v.tolist(), float(i % 10)) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "id long, x array<double>, y double"), x


def test_neighbors_both_ways(spark):
    train, a = vectors(spark, 400, 1, copies=200)
    queries, b = vectors(spark, 150, 2, copies=40)
    expected = {}
    for i, q in enumerate(b):
        d = ((a - q) ** 2).sum(axis=1)
        expected[i] = np.mean([j % 10 for j in np.lexsort((np.arange(len(a)), d))[:7]])
    few = {r["id"]: r["prediction"] for r in knn_regress(train, queries, "x", "y", "id").collect()}
    spread = knn_regress(train, queries, "x", "y", "id", pivots=8, block_rows=30)
    assert {r["id"]: r["prediction"] for r in spread.collect()} == pytest.approx(expected)
    assert few == pytest.approx(expected)


def test_cells_within_reach(spark):
    """No cell that holds a neighbour is left out, and queries of clustered rows visit few of 39 cells."""
    rng = np.random.default_rng(8)
    a = np.vstack([c + rng.normal(0, 0.2, (60, 6)) for c in rng.uniform(-4, 4, (25, 6))])
    centres = a[rng.permutation(len(a))[:39]]
    away = np.sqrt(((a[:, None] - centres) ** 2).sum(axis=2))
    cell = away.argmin(axis=1)
    numbers = np.unique(cell)
    own = [np.sort(away[cell == c, c]) for c in numbers]
    cells = Cells(centres[numbers], np.array([o[-1] for o in own]), np.array([o[0] for o in own]), [o[:7] for o in own])
    queries = a[::7] + rng.normal(0, 0.2, a[::7].shape)
    reach = cells.within(queries, 7)
    d = ((queries[:, None] - a) ** 2).sum(axis=2)
    for i, near in enumerate(np.argsort(d, axis=1)[:, :7]):
        assert reach[i][np.searchsorted(numbers, cell[near])].all()
    by_radius = np.sqrt(((queries[:, None] - centres[numbers]) ** 2).sum(axis=2)) - cells.radius <= cells.bound(queries, 7)[:, None]
    assert (reach <= by_radius).all() and reach.sum() < 0.9 * by_radius.sum() and reach.sum() < 3 * len(queries)


@pytest.mark.parametrize("pivots", [None, 1, 5])
def test_neighbors_of_repeated_and_null_keys(spark, pivots):
    train = spark.createDataFrame([(i, [float(i)], float(i)) for i in range(40)], "id long, x array<double>, y double")
    rows = [(1, [0.0]), (1, [39.0]), (None, [5.0]), (None, [5.0]), (2, None)]
    queries = spark.createDataFrame(rows, "id long, x array<double>").withColumn("prediction", F.lit("old"))
    got = knn_regress(train, queries, "x", "y", "id", k=3, pivots=pivots, block_rows=7)
    assert sorted(got.collect(), key=repr) == sorted([(1, [0.0], 1.0), (1, [39.0], 38.0), (None, [5.0], 5.0), (None, [5.0], 5.0), (2, None, None)], key=repr)
    empty = knn_regress(train.where("false"), queries, "x", "y", "id", k=3)
    assert [r["prediction"] for r in empty.collect()] == [None] * 5


def test_neighbors_of_a_tiny_table(spark):
    train, _ = vectors(spark, 3, 1)
    queries, _ = vectors(spark, 4, 2)
    for pivots in (None, 2):
        got = {r["prediction"] for r in knn_regress(train, queries, "x", "y", "id", pivots=pivots).collect()}
        assert got == {1.0}
    assert [list(r) for _, r, _ in nearest(np.zeros((1, 2)), np.ones((3, 2)), 2)] == [[0, 1]]


def test_nearest_of_many_features_by_products():
    """Products only choose candidates: order, ties and distances are those of sums of squares, also far from the origin."""
    rng = np.random.default_rng(4)
    b = rng.integers(0, 3, (400, 20)) + np.where(np.arange(400) % 2, 1e6, 0.0)[:, None]
    a = np.vstack([b[:30], rng.normal(size=(30, 20))])
    i, j, d = neighbors.nearest_pairs(a, b, 9)
    exact = neighbors.squared_distances(a, b)
    for row in range(len(a)):
        want = np.lexsort((np.arange(len(b)), exact[row]))[:9]
        assert j[i == row].tolist() == want.tolist() and d[i == row].tolist() == exact[row][want].tolist()


def test_query_comes_to_a_block_once(spark):
    """Features without clusters: every query needs every cell, yet sends k rows on from each block, not from each cell."""
    rng = np.random.default_rng(5)
    known = spark.createDataFrame([(i, v.tolist(), float(i)) for i, v in enumerate(rng.normal(size=(900, 12)))], "t_key long, t_x array<double>, t_y double")
    asked = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(40, 12)))], "q_key long, q_x array<double>")
    assert neighbors._pivot_join(known, asked, 7, None, None).count() == 40 * 7
    assert neighbors._pivot_join(known, asked, 7, None, 100).count() <= 40 * 7 * 20


def test_bound_takes_memory_for_pivots_only():
    cells = Cells(np.arange(1000.0)[:, None], np.ones(1000), np.zeros(1000), [np.linspace(0, 1, 7)] * 1000)
    tracemalloc.start()
    got = cells.bound(np.arange(2000.0)[:, None] / 2, 7)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6 and (got >= 0).all() and got.max() <= 501


def test_folds_are_even_and_stable(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 4 > 0, F.concat(F.lit("c"), F.col("id") % 4)).alias("label"))
    folds = stratified_folds(df, "label", "id", 15)
    sizes = folds.groupBy("label", "fold").count().groupBy("label").agg((F.max("count") - F.min("count")).alias("gap"))
    assert sizes.agg(F.max("gap")).first()[0] <= 1
    assert folds.count() == 3000
    again = stratified_folds(df.repartition(11), "label", "id", 15)
    assert rows_of(folds, "id", "fold") == rows_of(again, "id", "fold")


def test_split_does_not_depend_on_partitioning(spark):
    df = spark.range(1000)
    train, test = hash_split(df, "id", 25, 99)
    assert rows_of(train) == rows_of(hash_split(df.repartition(9), "id", 25, 99)[0])
    assert train.count() + test.count() == 1000 and 200 < test.count() < 300


@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_join(spark, null_safe):
    left = skewed(spark, 3000).select("g", F.monotonically_increasing_id().alias("id"), F.col("x").alias("v"))
    right = skewed(spark, 40).select("g", F.monotonically_increasing_id().alias("id"))
    plain = joins.merge(left, right, ["g"], null_safe=null_safe)
    salted = joins.merge(left, right, ["g"], null_safe=null_safe, salts=5)
    assert plain.columns == salted.columns == ["g", "id_x", "v", "id_y"]
    assert rows_of(plain) == rows_of(salted)
    given = joins.merge(left, right, ["g"], null_safe=null_safe, salts=5, hot=joins.hot_keys(left, ["g"], 0.3))
    assert rows_of(plain) == rows_of(given)
    assert joins.hot_keys(left, ["g"], 0.3).collect() == [(0,)]


def test_results_do_not_depend_on_partitioning(spark):
    df = skewed(spark, 2000).withColumn("id", F.monotonically_increasing_id()).persist()
    one, many = df.repartition(1), df.repartition(16)
    for fn in (
        lambda d: order.keep_first(d, ["g"], [F.col("id")]),
        lambda d: order.top_k(d, "x", 25, ["id"]),
        lambda d: order.top_k_by(d, ["g"], "x", 3, ["id"]),
        lambda d: clean.column_modes(d, ["x"]),
        lambda d: profile.value_counts(d, "g"),
        lambda d: distribution.histogram(d, "x", 7),
        lambda d: distribution.quantile_bin_counts(d.where("x != 7.5"), "x", 4),
    ):
        assert rows_of(fn(one)) == rows_of(fn(many))
