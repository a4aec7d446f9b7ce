"""Trees of a table in codes are those of the table itself."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyframe.ml import coded, folds, trees


def table(n=3000):
    """Features of few, some, many and one value, single precision, both infinities' neighbours, and a class that depends on them."""
    rng = np.random.default_rng(11)
    x = np.column_stack([
        rng.integers(0, 3, n), rng.integers(0, 101, n) / 100, rng.normal(size=n), np.full(n, 7.0), rng.normal(size=n).astype(np.float32), rng.choice([-1e300, -0.0, 0.0, 1e-300, 5.0], n),
    ]).astype(float)
    y = ((x[:, 0] > 1) + (x[:, 1] + 0.3 * x[:, 2] > 0.5) + (rng.random(n) < 0.1)).astype(np.int64) % 3
    return x, y, rng.integers(0, 1 << 62, n).astype(np.uint64), rng.integers(0, 3, n)


def in_codes(x, y, h, fold, wide=(2, 4)):
    values = [None if f in wide else np.unique(x[:, f]) for f in range(x.shape[1])]
    kinds = [("f4" if f == 4 else "f8") if f in wide else np.min_scalar_type(3 * len(values[f]) - 1).str[1:] for f in range(x.shape[1])]
    code = coded.Coding(values, kinds, 3)
    parts = [slice(a, a + 700) for a in range(0, len(x), 700)]
    return code, code.unpack((code.pack(h[p], fold[p], y[p], x[p]) for p in parts), len(x))


@pytest.mark.parametrize("extra", [False, True])
@pytest.mark.parametrize("alone, small", [(40, 500), (1, 1), (200, 5000)])
def test_trees_of_codes_are_the_trees_of_the_rows(extra, alone, small, monkeypatch):
    monkeypatch.setattr(trees, "ALONE", alone)
    monkeypatch.setattr(trees, "BLOCK_ROWS", 300)  # several groups of small nodes
    x, y, h, fold = table()
    spec = {"seed": 4, "trees": 2, "folds": 3, "extra": extra, "d": x.shape[1], "m": 2, "classes": 3, "small": small}
    for wide in ((2, 4), (), range(6)):
        _, (hashes, folded, held) = in_codes(x, y, h, fold, wide)
        assert (hashes == h).all() and (folded == fold).all()
        for t in (0, 3, 5):
            w = trees.row_weights(h, fold, t, spec)
            plain, found = trees.grow(trees.root_of(4, t), x, y, w, spec), trees.grow_coded(trees.root_of(4, t), held, w, spec)
            assert len(plain["cut"]) > 100 and all(np.array_equal(plain[name], found[name]) for name in plain)


def test_trees_of_one_class_or_no_row():
    x, y, h, fold = table(50)
    spec = {"seed": 4, "trees": 2, "folds": 0, "extra": False, "d": 6, "m": 2, "classes": 3, "small": 10}
    for labels, w in ((np.ones(50, np.int64), np.ones(50)), (y, np.zeros(50))):
        held = in_codes(x, labels, h, fold)[1][2]
        plain, found = trees.grow(trees.root_of(4, 0), x, labels, w, spec), trees.grow_coded(trees.root_of(4, 0), held, w, spec)
        assert len(plain["cut"]) == 1 and all(np.array_equal(plain[name], found[name]) for name in plain)


def test_rows_without_a_fold_are_of_none_and_rows_without_a_class_an_error():
    x, y, h, fold = table(10)
    code, _ = in_codes(x, y, h, fold)
    _, folded, _ = code.unpack(iter([code.pack(h, np.where(np.arange(10) == 3, np.nan, fold), y, x)]), 10)
    assert folded[3] == -1 and (np.delete(folded, 3) == np.delete(fold, 3)).all()
    with pytest.raises(ValueError):
        code.pack(h, fold, np.where(np.arange(10) == 3, np.nan, y), x)


def test_coding_of_a_table(spark, monkeypatch):
    monkeypatch.setattr(coded, "MOST_VALUES", 50)
    rows = [(i, [float(i % 7), i / 3, float(i), 2.0], i % 3) for i in range(400)]
    df = spark.createDataFrame(rows, "h long, x array<double>, y int").repartition(6)
    code = coded.coding(df, 4, 3, lambda batches: trees._blocks(batches, 4))
    assert code.kinds == ["u1", "f8", "f4", "u1"] and code.values[1] is code.values[2] is None
    assert code.values[0].tolist() == list(range(7)) and code.values[3].tolist() == [2.0]
    gap = df.withColumn("x", F.when(F.col("h") == 5, F.array(F.lit(1.0), F.lit(float("nan")), F.lit(1.0), F.lit(1.0))).otherwise(F.col("x")))
    assert coded.coding(gap, 4, 3, lambda batches: trees._blocks(batches, 4)) is None


@pytest.mark.parametrize("extra", [False, True])
def test_a_table_too_large_as_it_is_goes_to_tasks_in_codes(spark, extra, monkeypatch):
    """32 bytes a row do not fit, 18 do: the trees grow in tasks, and are those of both phases."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, 9, size=(600, 4)).astype(float)
    y = (x[:, 0] + x[:, 1] > 8).astype(float) + (rng.random(600) < 0.1)
    df = spark.createDataFrame([(i, v.tolist(), float(c), i % 3) for i, (v, c) in enumerate(zip(x, y))], "id int, features array<double>, label double, fold int").repartition(5)
    forest = trees.Forest(trees=3, extra=extra, seed=3, key=["id"], foldCol="fold", small=100)
    parts = forest.fit(df)
    monkeypatch.setattr(trees, "SMALL", 100)
    monkeypatch.setattr(trees, "WHOLE", 600 * 20)
    whole = forest.fit(df)
    assert any(tree.feature[0] >= 0 for tree in parts.tops.values())
    assert all(tree.feature[0] == trees.DEALT for tree in whole.tops.values()) and len(whole.units) == 9
    inner = lambda model: sum(np.frombuffer(r["feature"], np.int32).clip(-1, 0).sum() + len(r["feature"]) // 4 for r in model.nodes.collect())
    assert inner(whole) == inner(parts) + sum((tree.arrays()["feature"] >= 0).sum() for tree in parts.tops.values())
    predictions = [{r["id"]: r["prediction"] for r in model.transform(df).collect()} for model in (whole, parts)]
    assert predictions[0] == predictions[1] and len(predictions[0]) == 600


def test_support_vectors_of_all_folds_at_once_are_those_of_each(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x, fold = rng.normal(size=(300, 5)), rng.integers(0, 4, 300)
    y = (x[:, 0] + rng.normal(size=300) > 0).astype(float) + (x[:, 1] > 1)
    rows = spark.createDataFrame([(v.tolist(), float(c), int(f)) for v, c, f in zip(x, y, fold)], "x array<double>, y double, fold int").repartition(3)
    sums = folds.fold_sums(rows, 4)
    monkeypatch.setattr(folds, "PAIRS_BYTES", 8 * 21 * 40)  # 40 rows at a time
    joint = folds.support_vectors(rows, sums.labels, 5, 300, 1.0, 30, 4)
    monkeypatch.setattr(folds, "PAIRS", 0)
    assert np.allclose(joint, folds.support_vectors(rows, sums.labels, 5, 300, 1.0, 30, 4), rtol=1e-9, atol=1e-12)


def test_ridge_leverage_comes_from_matrix_products(monkeypatch):
    """Leave-one-out errors of all folds and penalties, without a loop over pairs of features for every row."""
    rng = np.random.default_rng(9)
    x, y, fold = rng.normal(size=(90, 3)), rng.integers(0, 2, 90).astype(float), np.arange(90) % 3
    batch = pd.DataFrame({"x": list(x), "y": y, "fold": fold})
    called, einsum = [], np.einsum

    def summed(rows, partial, shapes):
        return partial(batch)

    own = fold[:, None] == np.arange(3)
    counts = np.array([[(own[:, f] & (y == c)).sum() for c in (0, 1)] for f in range(3)])
    sums = np.array([[x[own[:, f] & (y == c)].sum(axis=0) for c in (0, 1)] for f in range(3)])
    squares = np.array([[(x[own[:, f] & (y == c)] ** 2).sum(axis=0) for c in (0, 1)] for f in range(3)])
    products = np.array([x[own[:, f]].T @ x[own[:, f]] for f in range(3)])
    one = folds.FoldSums(np.array([0.0, 1.0]), np.zeros(3), counts, sums, squares, products)
    monkeypatch.setattr(folds, "summed_matrices", summed)
    monkeypatch.setattr(np, "einsum", lambda how, *a, **b: called.append(len(a)) or einsum(how, *a, **b))
    found = folds.ridge(one, None, [0.1, 50.0])
    assert called and max(called) == 2
    for f, (_, w, offset) in enumerate(found):
        use = fold != f
        errors, lines = [], []
        for a in (0.1, 50.0):
            t = np.where(y[use, None] == [0.0, 1.0], 1.0, -1.0)
            centred = x[use] - x[use].mean(axis=0)
            inverse = np.linalg.inv(centred.T @ centred + a * np.eye(3))
            weights = inverse @ centred.T @ (t - t.mean(axis=0))
            leverage = 1 / use.sum() + np.diag(centred @ inverse @ centred.T)
            errors.append((((t - t.mean(axis=0) - centred @ weights) / (1 - leverage)[:, None]) ** 2).sum())
            lines.append(weights)
        assert np.allclose(w.T, lines[int(np.argmin(errors))]) and offset.shape == (2,)
