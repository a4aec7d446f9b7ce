"""Splits, preprocessing, models and their scores."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ..functions.metrics import GRADES
from ..ml import metrics, prep
from ..ml.discriminant import DiscriminantAnalysis, gaussian_bayes
from ..ml.kernel import KernelRegression
from ..ml.linear import LinearSvc, RidgeClassifier
from ..ml.neighbors import knn_regress
from ..ml.score import forecast_top
from ..ml.select import cross_validate, leaderboard
from ..ml.trees import extra_trees, importances, random_forest
from ..operators.distribution import histogram_density
from ..operators.order import cumulative_share
from ..plans import forecast, rating
from ..sources.csvfiles import PERCENT_COLUMNS, RATING_COLUMNS
from .registry import PART_SQL, part_with_gaps, query, rounded, table

_HASH = "('0x' || substr(md5(CAST({key} AS VARCHAR) || '{seed}'), 1, 7))::BIGINT % 100"

# ---------------------------------------------------------------- splits and folds


@query(
    "split_counts",
    f"SELECT CASE WHEN {_HASH.format(key='o_orderkey', seed=99)} < 75 THEN 'train' ELSE 'test' END AS part, count(*) AS n FROM orders GROUP BY 1",
)
def split_counts(spark, folder):
    train, test = prep.hash_split(table(spark, folder, "orders"), "o_orderkey", 25, 99)
    sides = [df.groupBy(F.lit(name).alias("part")).agg(F.count("*").alias("n")) for name, df in (("train", train), ("test", test))]
    return sides[0].unionByName(sides[1])


@query(
    "strat_folds",
    """SELECT o_orderkey, o_orderpriority, CAST((row_number() OVER (PARTITION BY o_orderpriority
ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey) - 1) % 15 AS INT) AS fold FROM orders""",
)
def strat_folds(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return prep.stratified_folds(orders, "o_orderpriority", "o_orderkey", 15)


# ---------------------------------------------------------------- preprocessing fitted on the train part

_SPLIT_SQL = f"p AS ({PART_SQL}), train AS (SELECT * FROM p WHERE {_HASH.format(key='p_partkey', seed=50)} < 75), test AS (SELECT * FROM p WHERE {_HASH.format(key='p_partkey', seed=50)} >= 75)"
_MEDIAN = "coalesce(CAST(t.{c} AS DOUBLE), (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM train))"


def _part_split(spark, folder):
    return prep.hash_split(part_with_gaps(spark, folder), "p_partkey", 25, 50)


@query(
    "impute_median",
    f"""WITH {_SPLIT_SQL} SELECT p_partkey, round_even({_MEDIAN.format(c='p_size')}, 6) AS p_size,
round_even({_MEDIAN.format(c='p_retailprice')}, 6) AS p_retailprice FROM test t""",
)
def impute_median(spark, folder):
    train, test = _part_split(spark, folder)
    fitted = prep.MedianImputer(inputCols=["p_size", "p_retailprice"]).fit(train)
    return rounded(fitted.transform(test).select("p_partkey", "p_size", "p_retailprice"), 6, "p_size", "p_retailprice")


_SCALE = "round_even((t.{c} - (SELECT min({c}) FROM train)) / (SELECT max({c}) - min({c}) FROM train), 9)"


@query("minmax_scale", f"WITH {_SPLIT_SQL} SELECT p_partkey, {_SCALE.format(c='p_size')} AS p_size, {_SCALE.format(c='p_retailprice')} AS p_retailprice FROM test t")
def minmax_scale(spark, folder):
    train, test = _part_split(spark, folder)
    fitted = prep.RangeScaler(inputCols=["p_size", "p_retailprice"]).fit(train)
    return rounded(fitted.transform(test).select("p_partkey", "p_size", "p_retailprice"), 9, "p_size", "p_retailprice")


# ---------------------------------------------------------------- regression: supplier years

_YEARS = """y AS (SELECT l_suppkey, CAST(year(l_shipdate) AS INT) AS year, sum(l_extendedprice) / 1000 AS revenue, sum(l_quantity) AS qty,
  CAST(count(*) AS DOUBLE) AS lines FROM lineitem GROUP BY 1, 2),
s AS (SELECT c.l_suppkey, c.year, c.revenue, p.qty, p.lines FROM y c JOIN y p ON c.l_suppkey = p.l_suppkey AND c.year = p.year + 1),
m AS (SELECT covar_pop(qty, revenue) AS ay, covar_pop(lines, revenue) AS by_, covar_pop(qty, lines) AS ab, var_pop(qty) AS aa, var_pop(lines) AS bb,
  avg(qty) AS ma, avg(lines) AS mb, avg(revenue) AS my FROM s WHERE year <= 1999),
w AS (SELECT *, (ay * bb - by_ * ab) / (aa * bb - ab * ab) AS wa, (by_ * aa - ay * ab) / (aa * bb - ab * ab) AS wb FROM m),
pred AS (SELECT l_suppkey, year, revenue, my - wa * ma - wb * mb + wa * qty + wb * lines AS prediction FROM s, w)"""
_FEATURES = ["qty", "lines"]


def _supplier_years(spark, folder):
    """Revenue (thousands) of each supplier and year with the previous year's quantity and line count."""
    years = table(spark, folder, "lineitem").groupBy("l_suppkey", F.year("l_shipdate").alias("year")).agg(
        (F.sum("l_extendedprice") / 1000).alias("revenue"), F.sum("l_quantity").alias("qty"), F.count("*").cast("double").alias("lines")
    )
    previous = years.select("l_suppkey", (F.col("year") + 1).alias("year"), "qty", "lines")
    return years.select("l_suppkey", "year", "revenue").join(previous, ["l_suppkey", "year"])


def _seasons(spark, folder):
    years = _supplier_years(spark, folder)
    return years.where("year <= 1999"), years.where("year = 2000")


def _predicted(model, spark, folder):
    train, season = _seasons(spark, folder)
    return forecast.fit(model, train, _FEATURES, "l_suppkey", "revenue")(season)


@query("ols_predict", f"WITH {_YEARS} SELECT l_suppkey, round_even(revenue, 4) AS revenue, round_even(prediction, 4) AS prediction FROM pred WHERE year = 2000")
def ols_predict(spark, folder):
    out = _predicted("linear", spark, folder).withColumnRenamed("label", "revenue")
    return rounded(out, 4, "revenue", "prediction")


@query(
    "reg_metrics",
    f"""WITH {_YEARS} SELECT count(*) AS n, round_even(avg((revenue - prediction) ** 2), 3) AS mse, round_even(avg(abs(revenue - prediction)), 4) AS mae,
round_even(1 - avg((revenue - prediction) ** 2) / var_pop(revenue), 6) AS r2 FROM pred WHERE year = 2000""",
)
def reg_metrics(spark, folder):
    scores = metrics.regression_metrics(_predicted("linear", spark, folder), "label", "prediction")
    return rounded(rounded(rounded(scores, 3, "mse"), 4, "mae"), 6, "r2")


_TOP = "top AS (SELECT l_suppkey, round_even(prediction, 2) AS revenue_pred FROM pred WHERE year = 2000 ORDER BY 2 DESC, 1 LIMIT 10)"


@query("top10_forecast", f"WITH {_YEARS}, {_TOP} SELECT * FROM top")
def top10_forecast(spark, folder):
    return forecast_top(_predicted("linear", spark, folder), "l_suppkey", "prediction").withColumnRenamed("prediction", "revenue_pred")


@query("pred_vs_actual", f"WITH {_YEARS}, {_TOP} SELECT l_suppkey, revenue_pred, round_even(revenue, 4) AS revenue FROM top JOIN y USING (l_suppkey) WHERE year = 2000")
def pred_vs_actual(spark, folder):
    train, season = _seasons(spark, folder)
    joined = forecast.top_ten("linear", train, season, season, _FEATURES, "l_suppkey", "revenue")
    return rounded(joined, 4, "revenue")


@query("top10_kernel")
def top10_kernel(spark, folder):
    train, season = _seasons(spark, folder)
    return forecast.top_ten("kernel", train, season, season, _FEATURES, "l_suppkey", "revenue")


@query(
    "top10_neighbors",
    f"""WITH {_YEARS}, pairs AS (SELECT a.l_suppkey, t.l_suppkey AS other, t.year AS other_year, t.revenue,
  (a.qty - t.qty) ** 2 + (a.lines - t.lines) ** 2 AS d FROM s a, s t WHERE a.year = 2000 AND t.year < 2000),
near AS (SELECT l_suppkey, round_even(avg(revenue), 2) AS revenue_pred FROM (SELECT * FROM pairs
  QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY d, other, revenue) <= 7) GROUP BY 1),
best AS (SELECT * FROM near ORDER BY revenue_pred DESC, l_suppkey LIMIT 10)
SELECT l_suppkey, revenue_pred, round_even(y.revenue, 4) AS revenue FROM best JOIN y USING (l_suppkey) WHERE year = 2000""",
)
def top10_neighbors(spark, folder):
    years = _supplier_years(spark, folder)
    train, season = years.where("year < 2000"), years.where("year = 2000")
    return rounded(forecast.top_ten("neighbors", train, season, season, _FEATURES, "l_suppkey", "revenue"), 4, "revenue")


@query("regression_comparison")
def regression_comparison(spark, folder):
    rows = _supplier_years(spark, folder).withColumn("id", F.concat_ws("/", "l_suppkey", "year"))
    return forecast.evaluate(rows, forecast.MODELS, _FEATURES, "id", "revenue")


# ---------------------------------------------------------------- classification: embeddings


def _vectors(spark, folder):
    vectors = table(spark, folder, "embeddings")
    return vectors.select("vec_id", F.col("label").cast("double").alias("label"), array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))


def _vector_split(spark, folder):
    return prep.hash_split(_vectors(spark, folder), "vec_id", 25, 50)


def _held_out(estimator, spark, folder):
    train, test = _vector_split(spark, folder)
    return estimator.fit(train).transform(test).select("vec_id", "label", "prediction")


_V_SPLIT = _HASH.format(key="vec_id", seed=50)


@query(
    "knn_regress",
    f"""WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e, label, {_V_SPLIT} < 75 AS known FROM embeddings),
pairs AS (SELECT a.vec_id, t.vec_id AS other, t.label, list_distance(a.e, t.e) AS d FROM v a, v t WHERE NOT a.known AND t.known)
SELECT vec_id, round_even(avg(label), 6) AS prediction FROM (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, other) <= 7) GROUP BY 1""",
)
def knn(spark, folder):
    train, test = _vector_split(spark, folder)
    return rounded(knn_regress(train, test, "features", "label", "vec_id", 7).select("vec_id", "prediction"), 6, "prediction")


_GNB = """d AS (SELECT vec_id, label, CAST(unnest(range(64)) AS INT) AS i, unnest(embedding::DOUBLE[]) AS x FROM embeddings),
eps AS (SELECT 1e-9 * max(v) AS e FROM (SELECT var_pop(x) AS v FROM d GROUP BY i)),
c AS (SELECT label AS k, i, avg(x) AS mu, var_pop(x) + (SELECT e FROM eps) AS v FROM d GROUP BY 1, 2),
prior AS (SELECT label AS k, ln(count(*) / (SELECT count(*) FROM embeddings)) AS p FROM embeddings GROUP BY 1),
score AS (SELECT vec_id, any_value(label) AS label, k, sum(-0.5 * ln(2 * pi() * v) - (x - mu) ** 2 / (2 * v)) AS ll FROM d JOIN c USING (i) GROUP BY vec_id, k),
pred AS (SELECT vec_id, CAST(any_value(label) AS DOUBLE) AS label, CAST(arg_max(k, ll + p) AS DOUBLE) AS prediction FROM score JOIN prior USING (k) GROUP BY vec_id)"""


def _gnb(spark, folder):
    rows = _vectors(spark, folder)
    return gaussian_bayes().fit(rows).transform(rows).select("vec_id", "label", "prediction")


@query("gnb_classify", f"WITH {_GNB} SELECT * FROM pred")
def gnb_classify(spark, folder):
    return _gnb(spark, folder)


@query(
    "cls_metrics",
    f"""WITH {_GNB}, l AS (SELECT label AS c FROM pred UNION SELECT prediction FROM pred),
f AS (SELECT c, 2.0 * count(*) FILTER (label = c AND prediction = c) / (count(*) FILTER (label = c) + count(*) FILTER (prediction = c)) AS f1 FROM l, pred GROUP BY c)
SELECT (SELECT count(*) FROM pred) AS n, (SELECT round_even(avg(CAST(label = prediction AS INT)), 6) FROM pred) AS f1_micro, round_even(avg(f1), 6) AS f1_macro FROM f""",
)
def cls_metrics(spark, folder):
    return rounded(metrics.classification_metrics(_gnb(spark, folder), "label", "prediction"), 6, "f1_micro", "f1_macro")


@query(
    "cls_scores",
    f"""WITH {_GNB}, l AS (SELECT label AS c FROM pred UNION SELECT prediction FROM pred),
t AS (SELECT c, count(*) FILTER (label = c) AS support, count(*) FILTER (prediction = c) AS claimed, count(*) FILTER (label = c AND prediction = c) AS hits FROM l, pred GROUP BY c)
SELECT c AS label, support, round_even(coalesce(hits / nullif(claimed, 0), 0), 6) AS "precision", round_even(coalesce(hits / nullif(support, 0), 0), 6) AS recall,
round_even(2.0 * hits / (support + claimed), 6) AS f1 FROM t""",
)
def cls_scores(spark, folder):
    return rounded(metrics.class_scores(_gnb(spark, folder), "label", "prediction"), 6, "precision", "recall", "f1")


_LDA = """v AS (SELECT vec_id, label, embedding[1]::DOUBLE AS a, embedding[2]::DOUBLE AS b FROM embeddings),
c AS (SELECT label AS k, count(*) AS n, avg(a) AS ma, avg(b) AS mb FROM v GROUP BY 1),
w AS (SELECT sum((a - ma) ** 2) / (count(*) - (SELECT count(*) FROM c)) AS aa, sum((b - mb) ** 2) / (count(*) - (SELECT count(*) FROM c)) AS bb,
  sum((a - ma) * (b - mb)) / (count(*) - (SELECT count(*) FROM c)) AS ab FROM v JOIN c ON k = label),
u AS (SELECT k, n, ma, mb, (bb * ma - ab * mb) / (aa * bb - ab * ab) AS wa, (aa * mb - ab * ma) / (aa * bb - ab * ab) AS wb FROM c, w),
pred AS (SELECT vec_id, CAST(label AS DOUBLE) AS label, CAST(arg_max(k, a * wa + b * wb - 0.5 * (ma * wa + mb * wb) + ln(n)) AS DOUBLE) AS prediction FROM v, u GROUP BY vec_id, label)"""


def _lda(spark, folder):
    first_two = array_to_vector(F.slice(F.col("embedding").cast("array<double>"), 1, 2))
    rows = table(spark, folder, "embeddings").select("vec_id", F.col("label").cast("double").alias("label"), first_two.alias("features"))
    return rows, DiscriminantAnalysis().fit(rows).transform(rows).select("vec_id", "label", "prediction")


@query("lda_classify", f"WITH {_LDA} SELECT * FROM pred")
def lda_classify(spark, folder):
    return _lda(spark, folder)[1]


@query(
    "class_balance",
    f"""WITH {_LDA} SELECT label, 'train' AS side, count(*) AS n, round_even(count(*) / sum(count(*)) OVER (), 6) AS share FROM pred GROUP BY 1
UNION ALL SELECT prediction, 'predicted', count(*), round_even(count(*) / sum(count(*)) OVER (), 6) FROM pred GROUP BY 1""",
)
def class_balance(spark, folder):
    return rounded(rating.class_balance(*_lda(spark, folder)), 6, "share")


@query(
    "prediction_density",
    f"""WITH {_LDA}, b AS (SELECT min(prediction) AS lo, max(prediction) AS hi, count(*) AS n FROM pred),
h AS (SELECT CAST(least(floor((prediction - lo) * 10.0 / (hi - lo)), 9) AS INT) AS bin, count(*) AS n FROM pred, b GROUP BY 1)
SELECT CAST(i AS INT) AS bin, round_even(coalesce(h.n, 0) / (b.n * (hi - lo) / 10.0), 9) AS density FROM range(10) r(i) CROSS JOIN b LEFT JOIN h ON h.bin = i""",
)
def prediction_density(spark, folder):
    return rounded(histogram_density(_lda(spark, folder)[1], "prediction", 10).select("bin", "density"), 9, "density")


_SIGNAL = "CAST(CASE WHEN embedding[{0}]::DOUBLE + embedding[{1}]::DOUBLE / 2 > 0.05 THEN 2 WHEN embedding[{0}]::DOUBLE > embedding[{1}]::DOUBLE THEN 1 ELSE 0 END AS INT)"


def _signal(spark, folder):
    """Vectors with a label that depends on the first two components."""
    a, b = (F.get("embedding", F.lit(i)).cast("double") for i in range(2))
    label = F.when(a + b / 2 > 0.05, 2).when(a > b, 1).otherwise(0).cast("double")
    return table(spark, folder, "embeddings").select("vec_id", label.alias("label"), F.col("embedding").cast("array<double>").alias("features"))


_CV = f"""f AS (SELECT vec_id, label, a, b, CAST((row_number() OVER (PARTITION BY label ORDER BY md5(CAST(vec_id AS VARCHAR)), vec_id) - 1) % 15 AS INT) AS fold
  FROM (SELECT vec_id, {_SIGNAL.format(1, 2)} AS label, embedding[1]::DOUBLE AS a, embedding[2]::DOUBLE AS b FROM embeddings)),
t AS (SELECT g, f.* FROM f, range(15) r(g) WHERE fold <> g),
s AS (SELECT g, count(*) AS n, 1e-9 * greatest(var_pop(a), var_pop(b)) AS eps FROM t GROUP BY g),
c AS (SELECT g, label AS k, count(*) AS nk, avg(a) AS ma, avg(b) AS mb, var_pop(a) AS va, var_pop(b) AS vb, covar_pop(a, b) AS ab FROM t GROUP BY g, label),
w AS (SELECT g, sum(nk * va) / (sum(nk) - count(*)) AS aa, sum(nk * vb) / (sum(nk) - count(*)) AS bb, sum(nk * ab) / (sum(nk) - count(*)) AS ab FROM c GROUP BY g),
u AS (SELECT g, k, nk, ma, mb, (bb * ma - w.ab * mb) / (aa * bb - w.ab * w.ab) AS wa, (aa * mb - w.ab * ma) / (aa * bb - w.ab * w.ab) AS wb FROM c JOIN w USING (g)),
lda AS (SELECT 'LDA' AS model, fold, label, arg_max(k, a * wa + b * wb - 0.5 * (ma * wa + mb * wb) + ln(nk)) AS p FROM f JOIN u ON g = fold GROUP BY vec_id, fold, label),
gnb AS (SELECT 'GNB' AS model, fold, label, arg_max(k, ln(nk / n) - 0.5 * ln(2 * pi() * (va + eps)) - 0.5 * ln(2 * pi() * (vb + eps)) - (a - ma) ** 2 / (2 * (va + eps)) - (b - mb) ** 2 / (2 * (vb + eps))) AS p
  FROM f JOIN c ON c.g = fold JOIN s ON s.g = fold GROUP BY vec_id, fold, label),
scored AS (SELECT * FROM lda UNION ALL SELECT * FROM gnb)"""


def _two_feature_scores(spark, folder, metric):
    rows = _signal(spark, folder).withColumn("features", F.slice("features", 1, 2))
    return cross_validate(rows, {"LDA": DiscriminantAnalysis(), "GNB": gaussian_bayes()}, "label", "vec_id", 15, metric)


@query("cv_scores_micro", f"WITH {_CV} SELECT model, fold, round_even(avg(CAST(label = p AS INT)), 9) AS score FROM scored GROUP BY model, fold")
def cv_scores_micro(spark, folder):
    return rounded(_two_feature_scores(spark, folder, "f1_micro"), 9, "score")


@query(
    "cv_leaderboard_pair",
    f"""WITH {_CV}, l AS (SELECT model, fold, label AS c FROM scored UNION SELECT model, fold, p FROM scored),
h AS (SELECT l.model, l.fold, c, 2.0 * count(*) FILTER (label = c AND p = c) / (count(*) FILTER (label = c) + count(*) FILTER (p = c)) AS f1
  FROM l JOIN scored ON l.model = scored.model AND l.fold = scored.fold GROUP BY ALL),
m AS (SELECT model, fold, avg(f1) AS score FROM h GROUP BY ALL)
SELECT model, round_even(avg(score), 9) AS mean, round_even(stddev_pop(score), 9) AS std FROM m GROUP BY model""",
)
def cv_leaderboard_pair(spark, folder):
    return rounded(leaderboard(_two_feature_scores(spark, folder, "f1_macro")), 9, "mean", "std")


@query("lda_wide")
def lda_wide(spark, folder):
    return _held_out(DiscriminantAnalysis(), spark, folder)


@query("linear_svc")
def svc(spark, folder):
    return _held_out(LinearSvc(), spark, folder)


@query("random_forest")
def forest(spark, folder):
    return _held_out(random_forest(), spark, folder)


@query("extra_trees")
def extremely_random(spark, folder):
    return _held_out(extra_trees(), spark, folder)


@query("ridge_cv")
def ridge(spark, folder):
    return _held_out(RidgeClassifier(), spark, folder)


@query("rbf_svr")
def kernel(spark, folder):
    return _held_out(KernelRegression(gamma=0.5, C=150.0, epsilon=0.3), spark, folder)


# ---------------------------------------------------------------- models on a label that depends on the features

_EIGHT = f"WITH s AS (SELECT vec_id, {_SIGNAL.format(1, 2)} AS label FROM embeddings), t AS (SELECT * FROM s WHERE {_HASH.format(key='vec_id', seed=50)} >= 75)"
_BOUND = f"""{_EIGHT}, c AS (SELECT label, count(*) AS n FROM t GROUP BY label)
SELECT CAST(sum(n) AS BIGINT) AS n, round_even(max(n) / sum(n), 9) AS majority, TRUE AS better FROM c"""


def _signal_split(spark, folder):
    rows = _signal(spark, folder).withColumn("features", F.slice("features", 1, 8))
    return prep.hash_split(rows, "vec_id", 25, 50)


def _bounded(estimator, spark, folder):
    """Held-out rows, the share of their largest class, and whether the model errs at most seven tenths as often as that class would."""
    train, test = _signal_split(spark, folder)
    scored = estimator.fit(train).transform(test)
    hits = scored.groupBy("label").agg(F.count("*").alias("n"), F.count_if(F.col("label") == F.col("prediction")).alias("hits"))
    majority, right = F.max("n") / F.sum("n"), F.sum("hits") / F.sum("n")
    return rounded(hits.agg(F.sum("n").alias("n"), majority.alias("majority"), (1 - right <= 0.7 * (1 - majority)).alias("better")), 9, "majority")


@query("svc_bound", _BOUND)
def svc_bound(spark, folder):
    return _bounded(LinearSvc(), spark, folder)


@query("ridge_bound", _BOUND)
def ridge_bound(spark, folder):
    return _bounded(RidgeClassifier(), spark, folder)


@query("forest_bound", _BOUND)
def forest_bound(spark, folder):
    return _bounded(random_forest(key=("vec_id",)), spark, folder)


@query("extra_bound", _BOUND)
def extra_bound(spark, folder):
    return _bounded(extra_trees(key=("vec_id",)), spark, folder)


@query("lda_bound", _BOUND)
def lda_bound(spark, folder):
    return _bounded(DiscriminantAnalysis(), spark, folder)


@query("importance_bound", f"{_EIGHT} SELECT 'x' || CAST(i AS VARCHAR) AS feature, i <= 2 AS counts FROM range(1, 9) r(i)")
def importance_bound(spark, folder):
    """Which features weigh more than an equal share: the two that the label depends on."""
    train, _ = _signal_split(spark, folder)
    shares = importances(spark, random_forest(key=("vec_id",)).fit(train), [f"x{i}" for i in range(1, 9)])
    return shares.select("feature", (F.col("importance") > 0.125).alias("counts"))


@query(
    "kernel_bound",
    f"""WITH s AS (SELECT vec_id, sin(8 * embedding[1]::DOUBLE) + embedding[2]::DOUBLE AS y FROM embeddings), t AS (SELECT * FROM s WHERE {_HASH.format(key='vec_id', seed=50)} >= 75)
SELECT count(*) AS n, round_even(var_pop(y), 6) AS spread, TRUE AS better FROM t""",
)
def kernel_bound(spark, folder):
    """Held-out rows, the spread of their target, and whether the model leaves at most a fifth of it."""
    x = F.slice(F.col("embedding").cast("array<double>"), 1, 2)
    rows = table(spark, folder, "embeddings").select("vec_id", x.alias("features"), (F.sin(8 * F.get(x, F.lit(0))) + F.get(x, F.lit(1))).alias("label"))
    train, test = prep.hash_split(rows, "vec_id", 25, 50)
    scored = KernelRegression(gamma=4.0, C=150.0, epsilon=0.01).fit(train).transform(test)
    left = F.avg((F.col("label") - F.col("prediction")) ** 2)
    return rounded(scored.agg(F.count("*").alias("n"), F.var_pop("label").alias("spread"), (left <= 0.2 * F.var_pop("label")).alias("better")), 6, "spread")


# ---------------------------------------------------------------- schools: parts with ratings

RATINGS = ["Not Meeting Target", "Approaching Target", "Meeting Target", "Exceeding Target"]


def _school_sql() -> dict[str, str]:
    """School columns as expressions over ``part`` that Spark and DuckDB read alike."""
    def rating_of(shift: int) -> str:
        x = f"(p_size + p_partkey * {shift}) % 50"
        return f"CASE WHEN {x} < 4 THEN '{RATINGS[0]}' WHEN {x} < 20 THEN '{RATINGS[1]}' WHEN {x} < 38 THEN '{RATINGS[2]}' ELSE '{RATINGS[3]}' END"

    def gap(every: int, value: str) -> str:
        return f"CASE WHEN p_partkey % {every} = 3 THEN NULL ELSE {value} END"

    out = {"SED Code": "CAST(p_partkey AS STRING)", "School Name": "p_name", "City": "p_brand"}
    out["Community School?"] = "CASE WHEN p_type = 'SMALL' THEN 'Yes' ELSE 'No' END"
    out["School Income Estimate"] = gap(13, "concat('$', CAST(CAST(p_retailprice * 10 AS BIGINT) AS STRING), ',', CAST(100 + p_partkey % 900 AS STRING), '.50 ')")
    for i, c in enumerate(PERCENT_COLUMNS):
        value = f"concat(CAST((p_size * {i + 1} + p_partkey * {i % 3}) % 101 AS STRING), '%')"
        out[c] = gap(17, value) if c == "Student Attendance Rate" else value
    for i, c in enumerate(c for c in RATING_COLUMNS if c != rating.TARGET):
        out[c] = gap(11 + i, rating_of(i % 3))
    out[rating.TARGET] = gap(29, rating_of(0))
    out["Economic Need Index"] = gap(19, "CAST((p_size * 7 + p_partkey) % 100 AS DOUBLE) / 100")
    out["Average ELA Proficiency"] = gap(23, "CAST(p_size AS DOUBLE) / 20 + 1.5")
    out["Average Math Proficiency"] = gap(31, "CAST(p_partkey % 50 AS DOUBLE) / 20 + 1.5")
    for g in GRADES:
        out[f"Grade {g} ELA - All Students Tested"] = f"CAST(p_size * {g} % 97 AS INT)"
        out[f"Grade {g} Math - All Students " + ("tested" if g == 3 else "Tested")] = gap(37, f"CAST((p_size + p_partkey) * {g} % 89 AS INT)")
    return out


_SCHOOL = _school_sql()
_SCHOOL_SQL = "SELECT " + ", ".join(f'{v} AS "{k}"' for k, v in _SCHOOL.items()) + " FROM part"


def _schools(spark, folder):
    return table(spark, folder, "part").select(*[F.expr(v).alias(k) for k, v in _SCHOOL.items()])


def _final_sql() -> str:
    number = {c: f"""CAST(replace("{c}", '%', '') AS DOUBLE) / 100""" for c in rating.PERCENT_COLUMNS}
    number[rating.INCOME] = f"""CAST(replace(replace(replace("{rating.INCOME}", '$', ''), ',', ''), ' ', '') AS DOUBLE)"""
    parsed = ", ".join(f'{v} AS "{c}"' for c, v in number.items())
    means = ", ".join(f'coalesce("{c}", avg("{c}") OVER ()) AS "{c}"' for c in rating.MEAN_FILLED)
    modes = ", ".join(
        f'coalesce("{c}", (SELECT "{c}" FROM parsed WHERE "{c}" IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, "{c}" LIMIT 1)) AS "{c}"'
        for c in rating.RATING_COLUMNS
    )
    share = ", ".join(f'CASE WHEN "{c}" = 0 THEN 0 WHEN "{c}" > 0 AND "{c}" <= 0.33 THEN 1 WHEN "{c}" > 0.33 AND "{c}" <= 0.67 THEN 2 ELSE 3 END AS "{c}"' for c in rating.SHARES)
    rates = ", ".join(f"""CASE "{c}" WHEN 'Exceeding Target' THEN 3 WHEN 'Meeting Target' THEN 2 ELSE 1 END AS "{c}\"""" for c in rating.RATING_COLUMNS)
    rounds = [rating.INCOME, "Economic Need Index", "Average ELA Proficiency", "Average Math Proficiency"]
    cols = ", ".join(f'round_even("{c}", 6) AS "{c}"' if c in rounds else f'"{c}"' for c in ["SED Code", "School Name", rating.TARGET, *rating.FEATURES])
    return f"""WITH school AS ({_SCHOOL_SQL.replace('AS STRING', 'AS VARCHAR')}),
parsed AS (SELECT * REPLACE ({parsed}) FROM school WHERE "{rating.TARGET}" IS NOT NULL AND "{rating.INCOME}" IS NOT NULL),
filled AS (SELECT * REPLACE ({means}, {modes}) FROM parsed),
final AS (SELECT * REPLACE ({share}, {rates}, CAST("Community School?" = 'Yes' AS INT) AS "Community School?") FROM filled)
SELECT {cols} FROM final"""


@query("rating_table", _final_sql())
def rating_table(spark, folder):
    final = rating.final_table(_schools(spark, folder))
    return rounded(final, 6, rating.INCOME, "Economic Need Index", "Average ELA Proficiency", "Average Math Proficiency")


def _tests_sql(subject: str, cuts: tuple[int, ...]) -> str:
    names = [k for k in _SCHOOL if f" {subject} - All" in k]
    x = " + ".join(f'"{n}"' for n in names)
    steps = " ".join(f"WHEN {x} <= {c} THEN {i}" for i, c in enumerate(cuts, 1))
    return f"CASE {steps} WHEN {x} IS NOT NULL THEN 5 END"


@query(
    "rating_tests",
    f"""WITH school AS ({_SCHOOL_SQL.replace('AS STRING', 'AS VARCHAR')}) SELECT "SED Code", {_tests_sql('ELA', (176, 253, 324, 454))} AS "ELA Tests",
{_tests_sql('Math', (173, 251, 325, 454))} AS "Math Tests" FROM school""",
)
def rating_tests(spark, folder):
    return rating.with_test_counts(_schools(spark, folder)).select("SED Code", "ELA Tests", "Math Tests")


def _rating_parts(spark, folder):
    return rating.prepared(rating.final_table(_schools(spark, folder)), "SED Code", rating.TARGET, rating.FEATURES)


@query("rating_classifier")
def rating_classifier(spark, folder):
    train, test = _rating_parts(spark, folder)
    return rating.classify(train, test).select(F.col("SED Code").alias("school"), "label", "prediction")


@query("cv_leaderboard")
def cv_leaderboard(spark, folder):
    train, _ = _rating_parts(spark, folder)
    return rating.compare_models(train, rating.classifiers(trees=150, seed=15), "SED Code", k=15)


@query("cv_leaderboard_macro")
def cv_leaderboard_macro(spark, folder):
    train, _ = _rating_parts(spark, folder)
    return rating.compare_models(train, rating.classifiers(trees=100, seed=10, extra=True), "SED Code", k=10, metric="f1_macro")


@query("rf_importance")
def rf_importance(spark, folder):
    train, _ = _rating_parts(spark, folder)
    return cumulative_share(importances(spark, random_forest().fit(train), rating.FEATURES), "feature", "importance")
