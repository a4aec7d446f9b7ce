"""Models against closed forms, plain numpy, or sanity bounds."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tallyframe.ml import folds, metrics, moments, prep, trees
from tallyframe.ml.discriminant import DiscriminantAnalysis, gaussian_bayes
from tallyframe.ml.kernel import KernelRegression
from tallyframe.ml.linear import LinearScoreModel, LinearSvc, RidgeClassifier, least_squares
from tallyframe.ml.select import cross_validate, leaderboard
from tallyframe.ml.trees import importances
from tallyframe.plans import forecast


@pytest.fixture(scope="module")
def blobs(spark):
    """Three overlapping classes, labelled 1, 2, 5."""
    rng = np.random.default_rng(3)
    y = rng.integers(0, 3, 240)
    x = rng.normal(size=(240, 4)) + np.array([[0, 0, 0, 0], [2, 1, 0, 0], [0, 2, 2, 0]])[y]
    labels = np.array([1.0, 2.0, 5.0])[y]
    df = spark.createDataFrame([(i, v.tolist(), float(c)) for i, (v, c) in enumerate(zip(x, labels))], "id int, features array<double>, label double")
    return df.repartition(5).persist(), x, labels


def predicted(model, df):
    return np.array([r["prediction"] for r in model.transform(df).orderBy("id").collect()])


def accuracy(model, df, labels):
    return (predicted(model, df) == labels).mean()


def test_discriminant_matches_numpy(blobs):
    df, x, y = blobs
    classes = np.unique(y)
    means = np.array([x[y == c].mean(axis=0) for c in classes])
    centred = x - means[np.searchsorted(classes, y)]
    s = centred.T @ centred / (len(x) - len(classes))
    w = means @ np.linalg.inv(s)
    scores = x @ w.T - 0.5 * (w * means).sum(axis=1) + np.log([(y == c).mean() for c in classes])
    assert (predicted(DiscriminantAnalysis().fit(df), df) == classes[scores.argmax(axis=1)]).all()


def test_ridge_matches_brute_force_leave_one_out(blobs):
    df, x, y = blobs
    classes, alphas = np.unique(y), [0.1, 1.0, 10.0, 1000.0]
    t = np.where(y[:, None] == classes, 1.0, -1.0)

    def solve(a, rows):
        mx, mt = x[rows].mean(axis=0), t[rows].mean(axis=0)
        xc = x[rows] - mx
        w = np.linalg.solve(xc.T @ xc + a * np.eye(x.shape[1]), xc.T @ (t[rows] - mt))
        return w, mt - mx @ w

    def loo(a):
        total = 0.0
        for i in range(len(x)):
            w, b = solve(a, np.arange(len(x)) != i)
            total += ((t[i] - x[i] @ w - b) ** 2).sum()
        return total

    best = min(alphas, key=loo)
    w, b = solve(best, np.ones(len(x), dtype=bool))
    model = RidgeClassifier(alphas=alphas).fit(df)
    assert np.allclose(np.array(model.getOrDefault("weights")).T, w)
    assert np.allclose(model.getOrDefault("offsets"), b)


def test_linear_svc_reaches_the_optimum(blobs):
    df, x, y = blobs
    model = LinearSvc().fit(df)
    z = np.hstack([x, np.ones((len(x), 1))])
    for c, w, b in zip(model.getOrDefault("classes"), model.getOrDefault("weights"), model.getOrDefault("offsets")):
        t, v = np.where(y == c, 1.0, -1.0), np.array([*w, b])
        slack = np.maximum(0, 1 - t * (z @ v))
        assert np.abs(v - 2 * z.T @ (slack * t)).max() < 1e-4
    assert accuracy(model, df, y) > 0.7


def test_naive_bayes_with_any_labels(blobs):
    df, x, y = blobs
    vectors = prep.assembler(["a", "b", "c", "d"]).transform(
        df.select("id", "label", *[F.get("features", F.lit(i)).alias(n) for i, n in enumerate("abcd")])
    )
    model = gaussian_bayes().fit(vectors)
    assert set(predicted(model, vectors)) <= {1.0, 2.0, 5.0}
    assert accuracy(model, vectors, y) > 0.7
    values = importances(df.sparkSession, trees.random_forest(trees=10).fit(vectors), list("abcd")).toPandas()
    assert values["importance"].sum() == pytest.approx(1) and values.set_index("feature")["importance"].idxmin() == "d"


def test_importances_without_arrow(blobs):
    df = blobs[0]
    name = "spark.sql.execution.arrow.pyspark.enabled"
    before = df.sparkSession.conf.get(name)
    model = trees.random_forest(trees=3).fit(df)
    with_arrow = dict(map(tuple, importances(df.sparkSession, model, list("abcd")).collect()))
    try:
        df.sparkSession.conf.set(name, "false")
        without = dict(map(tuple, importances(df.sparkSession, model, list("abcd")).collect()))
    finally:
        df.sparkSession.conf.set(name, before)
    assert without == pytest.approx(with_arrow) and sum(without.values()) == pytest.approx(1)


def node_table(model):
    """(tree, node id, feature, cut) of every split, from both phases."""
    k, found = len(model.labels), set()
    parts = [(t, root.ids[0], root.arrays()) for t, root in model.tops.items()]
    parts += [(r["tree"], model.tops[r["tree"]].ids[r["start"]], trees.read_tree(r, k)) for r in model.nodes.collect()]
    for t, top, tree in parts:
        ids = {0: np.uint64(top)}
        for at in range(len(tree["feature"])):
            if tree["feature"][at] >= 0:
                left = int(tree["left"][at])
                ids[left], ids[left + 1] = (side[0] for side in trees.children_of(np.array([ids[at]], np.uint64)))
                found.add((t, int(ids[at]), int(tree["feature"][at]), float(tree["cut"][at])))
    return found


def by_hand(x, y, w, node, m, extra, out, tree):
    """One node after the other, one feature and cut after the other."""
    x, y, w = x[w > 0], y[w > 0], w[w > 0]

    def weight(mask):
        sums = [w[mask & (y == c)].sum() for c in range(3)]
        return sum(v * v for v in sums) / max(sum(sums), 1e-300)

    order = np.argsort(trees.feature_draws(np.array([node]), x.shape[1])[0])
    tried = [f for f in order if x[:, f].min() < x[:, f].max()][:m]
    best = None
    for f in tried if len(set(y)) > 1 else []:
        values = np.unique(x[:, f])
        cuts = (values[:-1] + values[1:]) / 2
        if extra:
            draw = trees.feature_draws(np.array([node]), x.shape[1])[:, f]
            cuts = [float(trees.random_cuts(draw, values[0], values[-1])[0])]
        for cut in cuts:
            score = round(weight(x[:, f] <= cut) + weight(x[:, f] > cut), 9)
            if best is None or score > best[0]:
                best = score, f, cut
    if best:
        _, f, cut = best
        out.add((tree, int(node), int(f), float(cut)))
        left, right = (side[0] for side in trees.children_of(np.array([node], np.uint64)))
        for side, mask in ((left, x[:, f] <= cut), (right, x[:, f] > cut)):
            by_hand(x[mask], y[mask], w[mask], side, m, extra, out, tree)


@pytest.mark.parametrize("extra", [False, True])
def test_trees_match_trees_by_hand(blobs, extra):
    df, x, labels = blobs
    model = trees.Forest(trees=4, extra=extra, seed=3, key=["id"]).fit(df)
    hashes = np.array([r[0] for r in df.orderBy("id").select(F.xxhash64("id")).collect()]).view(np.uint64)
    wanted, y = set(), np.searchsorted(np.unique(labels), labels)
    for t in range(4):
        w = trees.row_weights(hashes, np.full(len(x), -1), t, model.spec)
        by_hand(x, y, w, trees.root_of(3, t), model.spec["m"], extra, wanted, t)
    assert node_table(model) == wanted and len(wanted) > 40


def test_rows_sent_to_subtrees_take_few_bytes_and_lose_nothing():
    rng = np.random.default_rng(4)
    single = rng.normal(size=(50, 8)).astype(np.float32).astype(float)
    single[3, 2] = np.nan
    double = rng.normal(size=(30, 8))
    sent = [trees._packed(x) for x in (single, double, single[:0])]
    assert sent[0].nbytes <= 50 * (8 * 4 + 4) + 4 and sent[1].nbytes <= 30 * (8 * 8 + 4) + 4
    found = trees._unpacked(pa.chunked_array(sent + [pa.concat_arrays(sent)]), 8)
    assert np.array_equal(found, np.vstack([single, double] * 2), equal_nan=True)


def test_rows_are_ordered_within_and_beyond_one_word():
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 6, 300), rng.integers(0, 9, 300)
    for scale in (1, 1 << 50):
        assert trees._in_order(a, b * scale + 1).tolist() == np.lexsort((b, a)).tolist()


@pytest.mark.parametrize("extra", [False, True])
def test_a_node_reads_only_features_it_tries(extra):
    rng = np.random.default_rng(6)
    x, y = rng.normal(size=(4000, 50)), rng.integers(0, 4, 4000)
    spec = {"seed": 1, "trees": 1, "folds": 0, "extra": extra, "d": 50, "m": 7, "classes": 4}
    read, columns = [], trees.Columns(x, not extra)

    class Counted(np.ndarray):
        def __getitem__(self, at):
            read.append(np.size(at))
            return np.asarray(self)[at]

    columns.x = columns.x.view(Counted)
    columns.ranks = None if extra else columns.ranks.view(Counted)
    grown, plain = (trees.grow(trees.root_of(1, 0), c, y, np.ones(4000), spec) for c in (columns, x))
    assert all(np.array_equal(grown[name], plain[name]) for name in plain)
    inner = grown["value"].sum(axis=1)[grown["feature"] >= 0].sum()  # rows of split nodes, level by level
    assert sum(read) <= inner * (spec["m"] + 3)


@pytest.mark.parametrize("extra", [False, True])
def test_tasks_grow_whole_trees_as_the_first_phase_does(blobs, extra, monkeypatch):
    """A table that a task can hold goes to bundles of trees, not once to every tree; trees and votes are those of both phases."""
    df, x, labels = blobs
    folded = df.withColumn("fold", F.col("id") % 3)
    forest = trees.Forest(trees=4, extra=extra, seed=3, key=["id"], foldCol="fold", small=60)
    parts = forest.fit(folded)
    monkeypatch.setattr(trees, "SMALL", 60)
    whole = forest.fit(folded)
    assert any(tree.feature[0] >= 0 for tree in parts.tops.values())
    assert all(tree.feature[0] == trees.DEALT for tree in whole.tops.values()) and len(whole.units) == 12
    assert node_table(whole) == node_table(parts) and len(node_table(whole)) > 12
    assert predicted(whole, folded).tolist() == predicted(parts, folded).tolist()


def test_rows_visit_only_units_of_their_fold(blobs, monkeypatch):
    """A forest of its own for every fold: a row has votes of those trees alone and is not sent to the others."""
    df, x, labels = blobs
    folded = df.withColumn("fold", (F.col("id") % 3).cast("int"))
    monkeypatch.setattr(trees, "BUNDLES", 6)
    model = trees.Forest(trees=4, seed=3, key=["id"], foldCol="fold").fit(folded)
    sent = []
    monkeypatch.setattr(trees, "_in_parts", lambda rows, *a: sent.append(rows) or rows.repartition(4, *a[2:]))
    model.votes(folded.select(F.col("id").cast("long").alias("id"), trees.feature_array(df, "features").alias("x"), "fold"))
    assert sent[0].count() == 2 * len(x)  # two of the six bundles hold the trees of a fold


def test_first_phase_grows_the_same_random_trees(blobs):
    df, x, labels = blobs
    whole, parts = (trees.Forest(trees=3, extra=True, seed=3, key=["id"], small=small).fit(df) for small in (1000, 20))
    assert any(tree.feature[0] >= 0 for tree in parts.tops.values()) and node_table(whole) == node_table(parts)
    assert predicted(whole, df).tolist() == predicted(parts, df).tolist()
    assert accuracy(parts, df, labels) == 1.0  # all rows, no limit of depth
    shares = {r["feature"]: r["importance"] for r in importances(df.sparkSession, parts, list("abcd")).collect()}
    other = {r["feature"]: r["importance"] for r in importances(df.sparkSession, whole, list("abcd")).collect()}
    assert sum(shares.values()) == pytest.approx(1) and shares == pytest.approx(other)


def test_forest_learns_with_small_and_large_nodes(blobs):
    df, x, labels = blobs
    for small in (50_000, 60):
        forest = trees.Forest(trees=15, seed=1, key=["id"], small=small).fit(df)
        assert accuracy(forest, df, labels) > 0.97
        again = trees.Forest(trees=15, seed=1, key=["id"], small=small).fit(df.repartition(3))
        assert predicted(forest, df).tolist() == predicted(again, df.repartition(2)).tolist()


def test_forests_of_folds_are_forests_without_the_fold(blobs):
    df, x, labels = blobs
    folded = df.withColumn("fold", F.col("id") % 3)
    joint = trees.Forest(trees=5, extra=True, seed=2, key=["id"], foldCol="fold").fit(folded)
    got = {r["id"]: r["prediction"] for r in joint.transform(folded).collect()}
    hashes = np.array([r[0] for r in df.orderBy("id").select(F.xxhash64("id")).collect()]).view(np.uint64)
    y, fold = np.searchsorted(np.unique(labels), labels), np.arange(len(x)) % 3
    for f in range(3):
        total = np.zeros((len(x), 3))
        for t in range(5 * f, 5 * f + 5):
            tree = trees.grow(trees.root_of(2, t), x, y, trees.row_weights(hashes, fold, t, joint.spec), joint.spec)
            value = tree["value"][trees.leaves(tree, x)]
            total += value / value.sum(axis=1, keepdims=True)
        wanted = np.unique(labels)[np.round(total, 9).argmax(axis=1)]
        assert all(got[i] == wanted[i] for i in range(len(x)) if fold[i] == f)


def direct_kernel(x, y, gamma, c, eps):
    """Support vector regression over all rows, the offset free: reweighted until nothing moves."""
    k = np.exp(-gamma * ((x[:, None] - x) ** 2).sum(axis=2))
    a, b = np.zeros(len(x)), y.mean()
    best = (np.inf, None)
    for turn in range(600):
        f = k @ a + b
        beyond = np.abs(y - f) - eps
        value = 0.5 * a @ k @ a + c * np.maximum(beyond, 0).sum()
        if value < best[0]:
            best = (value, f)
        use = np.flatnonzero(beyond > 0)
        smooth = max(1e-6, 0.1 * 0.97**turn)
        slack = np.maximum(beyond[use], smooth) / c
        target = y[use] - np.sign(y[use] - f[use]) * eps
        left = np.block([[k[np.ix_(use, use)] + np.diag(slack), np.ones((len(use), 1))], [np.ones((1, len(use))), np.zeros((1, 1))]])
        solved = np.linalg.solve(left, np.append(target, 0.0))
        new = np.zeros(len(x))
        new[use] = solved[:-1]
        step = 1.0 if turn < 50 else 0.3
        a, b = a + step * (new - a), b + step * (solved[-1] - b)
    return best


@pytest.mark.parametrize("landmarks, away", [(300, 0.05), (60, 0.1)])
def test_kernel_regression_is_close_to_the_direct_solution(spark, landmarks, away):
    rng = np.random.default_rng(5)
    x = rng.uniform(-3, 3, (300, 2))
    y = 3 * np.sin(x[:, 0]) + x[:, 1] + rng.normal(0, 0.2, 300)
    df = spark.createDataFrame([(i, v.tolist(), float(t)) for i, (v, t) in enumerate(zip(x, y))], "id int, features array<double>, label double")
    _, wanted = direct_kernel(x, y, 0.1, 10.0, 0.1)
    model = KernelRegression(gamma=0.1, C=10.0, epsilon=0.1, components=landmarks).fit(df)
    got = predicted(model, df)
    assert np.sqrt(((got - wanted) ** 2).mean()) < away and len(model.getOrDefault("landmarks")) == min(landmarks, 300)
    assert 1 - ((y - got) ** 2).sum() / ((y - y.mean()) ** 2).sum() > 0.95
    again = KernelRegression(gamma=0.1, C=10.0, epsilon=0.1, components=landmarks).fit(df.repartition(6))
    assert np.allclose(predicted(again, df), got, atol=1e-3)


def test_models_survive_saving(blobs, tmp_path):
    df, _, _ = blobs
    model = DiscriminantAnalysis().fit(df)
    model.write().save(str(tmp_path / "lda"))
    assert (predicted(LinearScoreModel.load(str(tmp_path / "lda")), df) == predicted(model, df)).all()


def test_preprocessing(spark, tmp_path):
    train = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (10.0, 5.0), (None, 5.0)], "a double, b double")
    test = spark.createDataFrame([(None, 5.0), (19.0, 7.0)], "a double, b double")
    fitted = prep.preprocessing(["a", "b"]).fit(train)
    got = [r["features"].toArray().tolist() for r in fitted.transform(test).collect()]
    assert got == [[pytest.approx(1.5 / 9), 0.0], [2.0, 2.0]]
    fitted.write().save(str(tmp_path / "prep"))
    assert PipelineModel.load(str(tmp_path / "prep")).transform(test).count() == 2
    with pytest.raises(ValueError, match="no median"):
        prep.MedianImputer(inputCols=["a"]).fit(train.where("a is null"))


def test_class_scores(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (2.0, 2.0), (3.0, 2.0), (2.0, 4.0)], "y double, p double")
    row = metrics.classification_metrics(df, "y", "p").first()
    f1 = [2 / 3, 2 / 5, 0.0, 0.0]  # sklearn: classes 1, 2, 3, 4
    assert row["n"] == 5 and row["f1_micro"] == pytest.approx(0.4) and row["f1_macro"] == pytest.approx(np.mean(f1))


@pytest.mark.parametrize("fan", [32, 2])
def test_nearly_collinear_columns(spark, monkeypatch, fan):
    """Columns of condition 1e8: what follows from products of columns would have lost all digits."""
    monkeypatch.setattr(moments, "FAN", fan)
    rng = np.random.default_rng(6)
    base, y = rng.normal(size=(600, 3)), rng.integers(0, 3, 600)
    base += np.array([[0, 0, 0], [1, 0, 2], [0, 1, -2]])[y]
    x = np.column_stack([base[:, 0], base[:, 1], base[:, 0] + base[:, 1] + 3e-8 * base[:, 2]])
    assert np.linalg.cond(x - x.mean(axis=0)) > 3e7
    t = base @ [1.0, -2.0, 0.5] + rng.normal(0, 0.1, 600)
    df = spark.createDataFrame([(i, v.tolist(), float(c), float(s)) for i, (v, c, s) in enumerate(zip(x, y, t))], "id int, features array<double>, label double, t double").repartition(7)
    means = np.array([x[y == c].mean(axis=0) for c in range(3)])
    _, s, v = np.linalg.svd((x - means[y]) / np.sqrt(597), full_matrices=False)
    middle = x.mean(axis=0)
    white, centres = (x - middle) @ v.T / s, (means - middle) @ v.T / s
    wanted = white @ centres.T - 0.5 * (centres**2).sum(axis=1) + np.log(np.bincount(y) / 600)
    model = DiscriminantAnalysis().fit(df)
    got = x @ np.array(model.getOrDefault("weights")).T + model.getOrDefault("offsets")
    off = lambda a: a - a.mean(axis=1, keepdims=True)
    assert np.abs(off(got) - off(wanted)).max() < 1e-6 * np.abs(off(wanted)).max()
    assert (predicted(model, df) == wanted.argmax(axis=1)).all()
    direct = np.linalg.lstsq(np.column_stack([x - middle, np.ones(600)]), t, rcond=None)[0]
    line = least_squares(label="t").fit(df)
    assert np.abs(predicted(line, df) - ((x - middle) @ direct[:3] + direct[3])).max() < 1e-6


def test_a_constant_column_and_few_rows(spark):
    rows = spark.createDataFrame([(i, [float(i), 5.0], float(2 * i + 1)) for i in range(4)], "id int, features array<double>, label double")
    assert predicted(least_squares().fit(rows), rows) == pytest.approx([1, 3, 5, 7])
    assert predicted(least_squares().fit(rows.limit(1)), rows) == pytest.approx([1] * 4)
    classes = rows.withColumn("label", (F.col("id") >= 2).cast("double"))
    assert predicted(DiscriminantAnalysis().fit(classes), classes).tolist() == [0, 0, 1, 1]


def test_fold_sums_solve_like_refits(blobs):
    df, x, y = blobs
    k = 4
    folded = prep.stratified_folds(df, "label", "id", k).persist()
    rows = folds.labelled(folded, "features", "label", "fold")
    sums = folds.fold_sums(rows, k)
    ridge = folds.ridge(sums, rows, [0.1, 1.0, 10.0, 1000.0])
    svc = folds.support_vectors(rows, sums.labels, 4, len(x), 1.0, 30, k)
    for f in range(k):
        train = folded.where(F.col("fold") != f)
        for model, (labels, weights, offsets) in (
            (DiscriminantAnalysis(), folds.discriminant(sums.others(f))), (RidgeClassifier(alphas=[0.1, 1.0, 10.0, 1000.0]), ridge[f]),
            (LinearSvc(), (sums.labels, svc[f][:, :-1], svc[f][:, -1])),
        ):
            fitted = model.fit(train)
            assert np.allclose(fitted.getOrDefault("weights"), weights, rtol=1e-9, atol=1e-9)
            assert np.allclose(fitted.getOrDefault("offsets"), offsets, rtol=1e-9, atol=1e-9) and fitted.getOrDefault("classes") == labels.tolist()
        here = folded.where(F.col("fold") == f).orderBy("id")
        points = np.array([r["features"] for r in here.collect()])
        as_vector = [part.withColumn("features", array_to_vector("features")) for part in (train, here)]
        assert [r["prediction"] for r in gaussian_bayes().fit(as_vector[0]).transform(as_vector[1]).orderBy("id").collect()] == folds.naive_bayes(sums.others(f))(points).tolist()
        outer = np.array([r["features"] for r in train.collect()])
        w = np.linalg.lstsq(np.column_stack([outer[:, 1:], np.ones(len(outer))]), outer[:, 0], rcond=None)[0]
        got = folds.least_squares(sums, 0)[f]
        assert np.allclose([*got[0], got[1]], w, rtol=1e-9, atol=1e-9)


def test_joint_cross_validation_scores_like_refits(blobs):
    df, _, _ = blobs
    models = {"LDA": DiscriminantAnalysis(), "RIDGE": RidgeClassifier(), "LSVC": LinearSvc(), "EXT": trees.extra_trees(trees=3)}
    scores = {(r["model"], r["fold"]): r["score"] for r in cross_validate(df, models, "label", "id", 3, "f1_macro").collect()}
    folded = prep.stratified_folds(df, "label", "id", 3)
    assert set(scores) == {(m, f) for m in models for f in range(3)}
    for f in range(3):
        for name in ("LDA", "RIDGE", "LSVC"):
            scored = models[name].fit(folded.where(F.col("fold") != f)).transform(folded.where(F.col("fold") == f))
            assert scores[name, f] == pytest.approx(metrics.classification_metrics(scored, "label", "prediction").first()["f1_macro"], abs=1e-12)


def test_a_class_without_rows_in_training(spark):
    rows = spark.createDataFrame([(i, [float(i), float(i % 3)], float(i % 2)) for i in range(12)] + [(50, [9.0, 9.0], 7.0)], "id int, features array<double>, label double")
    scores = cross_validate(rows, {"LDA": DiscriminantAnalysis()}, "label", "id", 3).collect()
    assert sorted(r["fold"] for r in scores) == [0, 1, 2] and all(0 <= r["score"] <= 1 for r in scores)


def test_cross_validation(blobs):
    df, _, y = blobs
    board = leaderboard(cross_validate(df, {"LDA": DiscriminantAnalysis(), "RIDGE": RidgeClassifier()}, "label", "id", k=3)).collect()
    assert {r["model"] for r in board} == {"LDA", "RIDGE"}
    assert board[0]["mean"] >= board[1]["mean"] > max(np.mean(y == c) for c in set(y))
    assert all(r["std"] >= 0 for r in board)


def test_least_squares_and_forecast(spark):
    rng = np.random.default_rng(7)
    x = rng.uniform(0, 10, (200, 2))
    rows = [(f"p{i}", *map(float, v), float(3 * v[0] - v[1] + 2)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "Player string, a double, b double, WS double")
    model = least_squares().fit(prep.assembler(["a", "b"]).transform(df.withColumnRenamed("WS", "label")))
    assert model.coefficients.toArray() == pytest.approx([3, -1], abs=1e-6)
    top = forecast.top_ten("linear", df, df, df, ["a", "b"]).orderBy(F.desc("WS_pred")).collect()
    want = sorted((round(r[3], 2) for r in rows), reverse=True)[:10]
    assert [r["WS_pred"] for r in top] == pytest.approx(want) and all(abs(r["WS"] - r["WS_pred"]) < 0.01 for r in top)
    board = {r["model"]: r for r in forecast.evaluate(df, ["linear", "neighbors"], ["a", "b"]).collect()}
    assert board["linear"]["r2"] == pytest.approx(1) and board["neighbors"]["r2"] > 0.9
