"""Parsing, filling, encoding and binning."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import binning, parse
from ..operators import clean, distribution, frame
from .registry import ORACLES, PART_SQL, part_with_gaps, query, rounded, table

# ---------------------------------------------------------------- text to number


@query(
    "parse_percent",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_partkey % 9 = 0 THEN NULL
ELSE CAST(CAST(l_discount * 100 AS INT) AS DOUBLE) / 100 END AS discount FROM lineitem""",
)
def parse_percent(spark, folder):
    text = F.concat(F.rint(F.col("l_discount") * 100).cast("int").cast("string"), F.lit("%"))
    line = table(spark, folder, "lineitem").withColumn("pct", F.when(F.col("l_partkey") % 9 != 0, text))
    return line.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", parse.percent_to_fraction("pct").alias("discount"))


@query("parse_money", "SELECT o_orderkey, o_totalprice AS amount, CAST(NULL AS DOUBLE) AS broken FROM orders")
def parse_money(spark, folder):
    orders = table(spark, folder, "orders").withColumn(
        "money", F.concat(F.lit("$"), F.format_number("o_totalprice", 2), F.lit(" "))
    )
    return orders.select(
        "o_orderkey",
        parse.money_to_number("money").alias("amount"),
        parse.money_to_number(F.concat("money", F.lit("x")), strict=False).alias("broken"),
    )


@query("strip_marker", "SELECT p_partkey, p_name FROM part")
def strip_marker(spark, folder):
    part = table(spark, folder, "part")
    marked = part.withColumn("p_name", F.when(F.col("p_partkey") % 3 == 0, F.concat("p_name", F.lit("*"))).otherwise(F.col("p_name")))
    return marked.select("p_partkey", parse.strip_marker("p_name").alias("p_name"))


def _as_text(spark, folder):
    """Part columns as text: one all numbers, one with bad values, one without any number."""
    return part_with_gaps(spark, folder).select(
        "p_partkey",
        F.col("p_size").cast("string").alias("size"),
        F.when(F.col("p_partkey") % 4 == 0, F.lit("12d")).when(F.col("p_partkey") % 4 == 1, F.lit("nan"))
        .otherwise(F.col("p_size").cast("string")).alias("mixed"),
        F.col("p_brand").alias("brand"),
    )


_TEXT = f"""SELECT p_partkey, CAST(p_size AS DOUBLE) AS size,
CASE WHEN p_partkey % 4 IN (0, 1) THEN NULL ELSE CAST(p_size AS DOUBLE) END AS mixed, p_brand AS brand FROM ({PART_SQL})"""


@query("infer_numeric", _TEXT)
def infer_numeric(spark, folder):
    return clean.infer_numeric(_as_text(spark, folder))


@query("fill_zero", f"SELECT p_partkey, coalesce(size, 0) AS size, coalesce(mixed, 0) AS mixed, coalesce(brand, '0') AS brand FROM ({_TEXT})")
def fill_zero(spark, folder):
    return clean.fill_zero(clean.infer_numeric(_as_text(spark, folder)))


# ---------------------------------------------------------------- filling


@query(
    "fill_mean",
    f"""WITH p AS ({PART_SQL}) SELECT p_partkey, round_even(coalesce(p_size, avg(p_size) OVER ()), 6) AS p_size,
round_even(coalesce(p_retailprice, avg(p_retailprice) OVER ()), 6) AS p_retailprice FROM p""",
)
def fill_mean(spark, folder):
    filled = clean.fill_mean(part_with_gaps(spark, folder), ["p_size", "p_retailprice"])
    return rounded(filled.select("p_partkey", "p_size", "p_retailprice"), 6, "p_size", "p_retailprice")


@query(
    "fill_mean_rounded",
    f"""WITH p AS ({PART_SQL}) SELECT p_partkey, CAST(coalesce(p_size, round_even(avg(p_size) OVER (), 0)) AS DOUBLE) AS p_size,
coalesce(p_retailprice, round_even(avg(p_retailprice) OVER (), 3)) AS p_retailprice FROM p""",
)
def fill_mean_rounded(spark, folder):
    part = clean.fill_mean(part_with_gaps(spark, folder), ["p_size"], 0)
    return clean.fill_mean(part, ["p_retailprice"], 3).select("p_partkey", "p_size", "p_retailprice")


_MODE = "(SELECT {c} FROM p WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, {c} LIMIT 1)"


@query(
    "fill_mode",
    f"""WITH p AS ({PART_SQL}) SELECT p_partkey, coalesce(p_size, {_MODE.format(c='p_size')}) AS p_size,
coalesce(p_brand, {_MODE.format(c='p_brand')}) AS p_brand, p_type FROM p""",
)
def fill_mode(spark, folder):
    return clean.fill_mode(part_with_gaps(spark, folder), ["p_size", "p_brand", "p_type"]).select("p_partkey", "p_size", "p_brand", "p_type")


@query(
    "fill_median",
    f"""WITH p AS ({PART_SQL}) SELECT p_partkey, round_even(coalesce(p_size, (SELECT quantile_cont(CAST(p_size AS DOUBLE), 0.5) FROM p)), 6) AS p_size,
round_even(coalesce(p_retailprice, (SELECT quantile_cont(p_retailprice, 0.5) FROM p)), 6) AS p_retailprice FROM p""",
)
def fill_median(spark, folder):
    filled = clean.fill_median(part_with_gaps(spark, folder), ["p_size", "p_retailprice"])
    return rounded(filled.select("p_partkey", "p_size", "p_retailprice"), 6, "p_size", "p_retailprice")


@query("fill_median_counted", ORACLES["fill_median"])
def fill_median_counted(spark, folder):
    """The way for tables of over a million rows."""
    filled = clean.fill_median(part_with_gaps(spark, folder), ["p_size", "p_retailprice"], accuracy=100)
    return rounded(filled.select("p_partkey", "p_size", "p_retailprice"), 6, "p_size", "p_retailprice")


# ---------------------------------------------------------------- encoding


@query(
    "merge_category",
    "SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN '4-NOT SPECIFIED' ELSE o_orderpriority END AS o_orderpriority FROM orders",
)
def merge_category(spark, folder):
    orders = table(spark, folder, "orders")
    merged = frame.map_columns(orders, ["o_orderpriority"], lambda c: parse.merge_category(c, "5-LOW", "4-NOT SPECIFIED"))
    return merged.select("o_orderkey", "o_orderpriority")


@query(
    "ordinal_encode",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 3 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 1
WHEN '4-NOT SPECIFIED' THEN 1 END AS code FROM orders""",
)
def ordinal_encode(spark, folder):
    codes = {"1-URGENT": 3, "2-HIGH": 2, "3-MEDIUM": 1, "4-NOT SPECIFIED": 1}
    return table(spark, folder, "orders").select("o_orderkey", parse.ordinal("o_orderpriority", codes).alias("code"))


@query(
    "one_hot",
    """SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INT) AS status_F, CAST(o_orderstatus = 'O' AS INT) AS status_O,
CAST(o_orderstatus = 'P' AS INT) AS status_P FROM orders""",
)
def one_hot(spark, folder):
    hot = clean.one_hot(table(spark, folder, "orders"), "o_orderstatus", ["F", "O", "P"], "status")
    return hot.select("o_orderkey", "status_F", "status_O", "status_P")


# ---------------------------------------------------------------- binning

_LINE_KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


@query(
    "bin_share",
    f"""WITH t AS (SELECT {_LINE_KEYS}, CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE l_discount * 10 - 0.1 END AS x FROM lineitem)
SELECT {_LINE_KEYS}, CASE WHEN x = 0 THEN 0 WHEN x > 0 AND x <= 0.33 THEN 1 WHEN x > 0.33 AND x <= 0.67 THEN 2 ELSE 3 END AS code FROM t""",
)
def bin_share(spark, folder):
    x = F.when(F.col("l_partkey") % 9 != 0, F.col("l_discount") * 10 - 0.1)
    return table(spark, folder, "lineitem").select(*_LINE_KEYS.split(", "), binning.share_code(x).alias("code"))


@query(
    "bin_count",
    f"""WITH t AS (SELECT p_partkey, p_size * 2 - 2 AS x FROM ({PART_SQL}))
SELECT p_partkey, CASE WHEN x = 0 THEN 0 WHEN x > 0 AND x <= 15 THEN 1 WHEN x > 15 AND x <= 30 THEN 2 WHEN x > 30 AND x <= 45 THEN 3
WHEN x > 60 AND x <= 75 THEN 4 ELSE 5 END AS code FROM t""",
)
def bin_count(spark, folder):
    return part_with_gaps(spark, folder).select("p_partkey", binning.count_code(F.col("p_size") * 2 - 2).alias("code"))


@query(
    "bin_cutpoints",
    f"""SELECT p_partkey, CAST(CASE WHEN x < 0 THEN x WHEN x <= 176 THEN 1 WHEN x <= 253 THEN 2 WHEN x <= 324 THEN 3 WHEN x <= 454 THEN 4
WHEN x > 454 THEN 5 END AS INT) AS code FROM (SELECT p_partkey, p_size * 12 - 20 AS x FROM ({PART_SQL}))""",
)
def bin_cutpoints(spark, folder):
    x = F.col("p_size") * 12 - 20
    return part_with_gaps(spark, folder).select("p_partkey", binning.cut_code(x, binning.ELA_CUTS).alias("code"))


_EDGES = "e AS (SELECT quantile_cont(o_totalprice, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS q FROM orders)"
_CODE = "CASE WHEN o_totalprice <= q[2] THEN 1 WHEN o_totalprice <= q[3] THEN 2 WHEN o_totalprice <= q[4] THEN 3 WHEN o_totalprice <= q[5] THEN 4 ELSE 5 END"


@query("qcut5_codes", f"WITH {_EDGES} SELECT o_orderkey, {_CODE} AS code FROM orders, e")
def qcut5_codes(spark, folder):
    return distribution.quantile_bins(table(spark, folder, "orders"), "o_totalprice", 5).select("o_orderkey", "code")


@query(
    "qcut5_counts",
    f"""WITH {_EDGES}, c AS (SELECT {_CODE} AS code, count(*) AS n FROM orders, e GROUP BY 1)
SELECT code, round_even(q[code], 4) AS low, round_even(q[code + 1], 4) AS high, n FROM c, e""",
)
def qcut5_counts(spark, folder):
    return rounded(distribution.quantile_bin_counts(table(spark, folder, "orders"), "o_totalprice", 5), 4, "low", "high")


@query("qcut5_codes_counted", ORACLES["qcut5_codes"])
def qcut5_codes_counted(spark, folder):
    """The way for tables of over a million rows."""
    return distribution.quantile_bins(table(spark, folder, "orders"), "o_totalprice", 5, accuracy=100).select("o_orderkey", "code")
