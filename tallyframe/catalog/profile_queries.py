"""Profiles, frequencies, distributions, correlations, cumulative shares."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import col, round_even
from ..operators import distribution, order, profile, relate
from .registry import ORACLES, PART_SQL, part_with_gaps, query, rounded, table

_PART_COLUMNS = {
    "p_partkey": "bigint", "p_name": "string", "p_size": "int", "p_brand": "string", "p_retailprice": "double", "p_type": "string",
}


@query(
    "schema_profile",
    f"WITH p AS ({PART_SQL}) "
    + " UNION ALL ".join(
        f"SELECT {i} AS ordinal, '{c}' AS \"column\", '{t}' AS type, count({c}) AS non_null FROM p"
        for i, (c, t) in enumerate(_PART_COLUMNS.items())
    ),
)
def schema_profile(spark, folder):
    return profile.schema_profile(part_with_gaps(spark, folder))


@query(
    "null_profile",
    f"WITH p AS ({PART_SQL}) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"Feature\", count(*) - count({c}) AS \"Total\", round_even((count(*) - count({c})) / count(*), 6) AS \"Percent\" FROM p"
        for c in _PART_COLUMNS
    ),
)
def null_profile(spark, folder):
    nulls = profile.null_profile(part_with_gaps(spark, folder))
    return rounded(nulls, 6, "percent").withColumnsRenamed({"column": "Feature", "total": "Total", "percent": "Percent"})


def _describe_sql(c: str) -> str:
    return f"""SELECT '{c}' AS "column", count({c}) AS count, count(DISTINCT {c}) AS "unique",
(SELECT {c} FROM p WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, {c} LIMIT 1) AS top,
(SELECT count(*) FROM p WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC LIMIT 1) AS freq FROM p"""


@query("describe_text", f"WITH p AS ({PART_SQL}) {_describe_sql('p_brand')} UNION ALL {_describe_sql('p_name')} UNION ALL {_describe_sql('p_type')}")
def describe_text(spark, folder):
    return profile.describe_text(part_with_gaps(spark, folder), ["p_brand", "p_name", "p_type"])


@query("value_counts", f"SELECT p_brand, count(*) AS n FROM ({PART_SQL}) WHERE p_brand IS NOT NULL GROUP BY 1")
def value_counts(spark, folder):
    return profile.value_counts(part_with_gaps(spark, folder), "p_brand")


@query("value_counts_sorted", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def value_counts_sorted(spark, folder):
    return profile.value_counts(table(spark, folder, "orders"), "o_orderpriority", by_value=True)


@query("distinct_values", f"SELECT DISTINCT p_brand FROM ({PART_SQL})")
def distinct_values(spark, folder):
    return profile.distinct_values(part_with_gaps(spark, folder), "p_brand")


@query("share_of_total", "SELECT o_orderpriority, count(*) AS n, round_even(count(*) / sum(count(*)) OVER (), 6) AS share FROM orders GROUP BY 1")
def share_of_total(spark, folder):
    return rounded(profile.share_of_total(table(spark, folder, "orders"), "o_orderpriority"), 6, "share")


@query("crosstab_facets", "SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2")
def crosstab_facets(spark, folder):
    return profile.facet_counts(table(spark, folder, "orders"), "o_orderpriority", "o_orderstatus")


@query(
    "crosstab_wide",
    """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'O') AS O,
count(*) FILTER (o_orderstatus = 'P') AS P FROM orders GROUP BY 1""",
)
def crosstab_wide(spark, folder):
    return profile.facet_counts_wide(table(spark, folder, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


_INTS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
_NUNIQUE = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS \"distinct\" FROM lineitem" for c in _INTS)


@query("nunique_columns", _NUNIQUE)
def nunique_columns(spark, folder):
    return profile.distinct_counts(table(spark, folder, "lineitem"))


@query("nunique_distribution", f'SELECT "distinct", count(*) AS columns FROM ({_NUNIQUE}) GROUP BY 1')
def nunique_distribution(spark, folder):
    return profile.distinct_count_distribution(table(spark, folder, "lineitem"))


@query(
    "score_summary",
    "SELECT o_orderpriority, round_even(avg(o_totalprice), 4) AS mean, round_even(stddev_pop(o_totalprice), 4) AS std FROM orders GROUP BY 1",
)
def score_summary(spark, folder):
    return rounded(profile.score_summary(table(spark, folder, "orders"), ["o_orderpriority"], "o_totalprice"), 4, "mean", "std")


# ---------------------------------------------------------------- distributions


def _hist_sql(bins: int, table_name: str, c: str) -> str:
    return f"""b AS (SELECT min({c}) AS lo, max({c}) AS hi FROM {table_name}),
c AS (SELECT CAST(least(floor(({c} - lo) * {float(bins)} / (hi - lo)), {bins - 1}) AS INT) AS bin, count(*) AS n FROM {table_name}, b GROUP BY 1),
h AS (SELECT CAST(i AS INT) AS bin, lo + (hi - lo) / {float(bins)} * i AS low, lo + (hi - lo) / {float(bins)} * (i + 1) AS high, coalesce(n, 0) AS n
  FROM range({bins}) r(i) CROSS JOIN b LEFT JOIN c ON c.bin = i)"""


@query("histogram15", f"WITH {_hist_sql(15, 'lineitem', 'l_extendedprice')} SELECT bin, round_even(low, 4) AS low, round_even(high, 4) AS high, n FROM h")
def histogram15(spark, folder):
    return rounded(distribution.histogram(table(spark, folder, "lineitem"), "l_extendedprice", 15), 4, "low", "high")


@query(
    "hist_density",
    f"""WITH {_hist_sql(5, 'lineitem', 'l_extendedprice')} SELECT bin, round_even(low, 4) AS low, round_even(high, 4) AS high, n,
round_even(n / ((SELECT count(*) FROM lineitem) * (high - low)), 12) AS density FROM h""",
)
def hist_density(spark, folder):
    density = distribution.histogram_density(table(spark, folder, "lineitem"), "l_extendedprice", 5)
    return rounded(rounded(density, 4, "low", "high"), 12, "density")


@query(
    "kde_by_group",
    """WITH s AS (SELECT o_orderpriority AS g, count(*) AS n, stddev_samp(o_totalprice) * pow(count(*), -0.2) AS h, min(o_totalprice) AS a,
max(o_totalprice) AS b FROM orders GROUP BY 1),
grid AS (SELECT g, n, h, CAST(i AS INT) AS point, (a - 3.0 * h) + i * ((b - a + 6.0 * h) / 49) AS x FROM s, range(50) r(i))
SELECT g AS o_orderpriority, point, round_even(max(x), 4) AS x,
round_even(1e6 * sum(exp(-0.5 * ((x - o_totalprice) / h) * ((x - o_totalprice) / h))) / (max(n * h) * sqrt(2 * pi())), 6) AS density_per_million
FROM grid JOIN orders ON g = o_orderpriority GROUP BY 1, 2""",
)
def kde_by_group(spark, folder):
    kde = distribution.kernel_density(table(spark, folder, "orders"), "o_totalprice", "o_orderpriority", 50)
    return kde.select(
        "o_orderpriority", "point", round_even("x", 4).alias("x"), round_even(F.col("density") * 1e6, 6).alias("density_per_million")
    )


@query(
    "box_by_group",
    """WITH q AS (SELECT o_orderpriority AS g, quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS median,
quantile_cont(o_totalprice, 0.75) AS q3 FROM orders GROUP BY 1)
SELECT o_orderpriority, round_even(q1, 4) AS q1, round_even(median, 4) AS median, round_even(q3, 4) AS q3, count(*) AS n,
count(*) FILTER (o_totalprice < q1 - 1.5 * (q3 - q1) OR o_totalprice > q3 + 1.5 * (q3 - q1)) AS outliers,
min(o_totalprice) FILTER (o_totalprice >= q1 - 1.5 * (q3 - q1)) AS whisker_low,
max(o_totalprice) FILTER (o_totalprice <= q3 + 1.5 * (q3 - q1)) AS whisker_high
FROM orders JOIN q ON g = o_orderpriority GROUP BY o_orderpriority, q1, median, q3""",
)
def box_by_group(spark, folder):
    box = distribution.box_stats(table(spark, folder, "orders"), "o_totalprice", "o_orderpriority")
    return rounded(box, 4, "q1", "median", "q3")


@query("box_by_group_counted", ORACLES["box_by_group"])
def box_by_group_counted(spark, folder):
    """The way for tables of over a million rows."""
    box = distribution.box_stats(table(spark, folder, "orders"), "o_totalprice", "o_orderpriority", accuracy=100)
    return rounded(box, 4, "q1", "median", "q3")


@query("point_set", f"SELECT p_brand, p_size, p_retailprice FROM ({PART_SQL}) WHERE p_brand IS NOT NULL AND p_size IS NOT NULL AND p_retailprice IS NOT NULL")
def point_set(spark, folder):
    return distribution.point_set(part_with_gaps(spark, folder), ["p_brand", "p_size", "p_retailprice"])


# ---------------------------------------------------------------- correlations

_NUM = ["p_partkey", "p_size", "p_retailprice", "scaled", "constant"]
_NUMERIC = f"n AS (SELECT p_partkey, p_size, p_retailprice, p_size * 3.0 + p_partkey * 0.0001 AS scaled, 1.0::DOUBLE AS constant FROM ({PART_SQL}))"


def _r(a: str, b: str) -> str:
    both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
    return f"CASE WHEN var_pop({a}) FILTER ({both}) > 0 AND var_pop({b}) FILTER ({both}) > 0 THEN round_even(corr({a}, {b}), 6) END"


_MATRIX = " UNION ALL ".join(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {_r(a, b)} AS r FROM n" for a in _NUM for b in _NUM)


def _numbers(spark, folder):
    part = part_with_gaps(spark, folder)
    return part.select(
        "p_partkey", "p_size", "p_retailprice",
        (F.col("p_size") * 3.0 + F.col("p_partkey") * 0.0001).alias("scaled"), F.lit(1.0).alias("constant"),
    )


@query("corr_pair", f"WITH {_NUMERIC} SELECT {_r('p_partkey', 'p_retailprice')} AS r FROM n")
def corr_pair(spark, folder):
    return rounded(relate.corr_pair(_numbers(spark, folder), "p_partkey", "p_retailprice"), 6, "r")


@query(
    "corr_with_target",
    f"WITH {_NUMERIC} " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {_r(c, 'scaled')} AS r FROM n" for c in _NUM),
)
def corr_with_target(spark, folder):
    return rounded(relate.corr_with_target(_numbers(spark, folder), _NUM, "scaled"), 6, "r")


@query("corr_matrix_long", f"WITH {_NUMERIC} {_MATRIX}")
def corr_matrix_long(spark, folder):
    return rounded(relate.corr_matrix(_numbers(spark, folder), _NUM), 6, "r")


@query(
    "corr_drop_list",
    f"""WITH {_NUMERIC}, m AS ({_MATRIX}), o(c, i) AS (VALUES {', '.join(f"('{c}', {i})" for i, c in enumerate(_NUM))})
SELECT col_b AS "column", max(abs(r)) AS max_abs_r FROM m JOIN o a ON a.c = col_a JOIN o b ON b.c = col_b
WHERE a.i < b.i AND abs(r) > 0.95 GROUP BY 1""",
)
def corr_drop_list(spark, folder):
    return rounded(relate.redundant_columns(_numbers(spark, folder), _NUM), 6, "max_abs_r")


@query(
    "corr_submatrix",
    f"""WITH {_NUMERIC}, m AS ({_MATRIX}), near AS (SELECT col_b AS c FROM m WHERE col_a = 'p_size' AND abs(r) > 0.9)
SELECT * FROM m WHERE col_a IN (SELECT c FROM near) AND col_b IN (SELECT c FROM near)""",
)
def corr_submatrix(spark, folder):
    return rounded(relate.corr_submatrix(_numbers(spark, folder), _NUM, "p_size"), 6, "r")


@query("strong_features", f"WITH {_NUMERIC}, m AS ({_MATRIX}) SELECT col_a AS \"column\", r FROM m WHERE col_b = 'scaled' AND abs(r) > 0.5")
def strong_features(spark, folder):
    return rounded(relate.strong_columns(_numbers(spark, folder), _NUM, "scaled"), 6, "r")


# ---------------------------------------------------------------- cumulative shares

_IMPORTANCE = """i AS (SELECT p_brand AS feature, round_even(sum(l_extendedprice), 2) AS importance FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1),
s AS (SELECT *, importance / sum(importance) OVER () AS share FROM i),
c AS (SELECT *, row_number() OVER w AS position, sum(share) OVER (w ROWS UNBOUNDED PRECEDING) AS cumulative FROM s WINDOW w AS (ORDER BY importance DESC, feature))"""


def _importance(spark, folder):
    """Revenue by brand in place of importance by feature; lines are summed by part before the join."""
    line = table(spark, folder, "lineitem").groupBy("l_partkey").agg(F.sum("l_extendedprice").alias("v"))
    part = table(spark, folder, "part").select("p_partkey", "p_brand")
    joined = line.join(part, line["l_partkey"] == part["p_partkey"])
    return joined.groupBy(col("p_brand").alias("feature")).agg(round_even(F.sum("v"), 2).alias("importance"))


@query(
    "cum_importance",
    f"WITH {_IMPORTANCE} SELECT feature, importance, position, round_even(share, 9) AS share, round_even(cumulative, 9) AS cumulative FROM c",
)
def cum_importance(spark, folder):
    return rounded(order.cumulative_share(_importance(spark, folder), "feature", "importance"), 9, "share", "cumulative")


@query(
    "top_importance",
    f"WITH {_IMPORTANCE} SELECT feature, position, round_even(share, 9) AS share FROM c WHERE position <= 11",
)
def top_importance(spark, folder):
    shares = order.cumulative_share(_importance(spark, folder), "feature", "importance")
    return rounded(order.first_rows(shares, [F.col("position")], 10).select("feature", "position", "share"), 9, "share")


@query(
    "features_for_threshold",
    f"WITH {_IMPORTANCE} SELECT CAST(0.95 AS DOUBLE) AS threshold, min(position) AS needed FROM c WHERE cumulative > 0.95",
)
def features_for_threshold(spark, folder):
    return order.count_to_threshold(order.cumulative_share(_importance(spark, folder), "feature", "importance"), 0.95)
