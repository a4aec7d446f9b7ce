"""Projections, filters, joins, roll-ups, cohorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import col, ratio, total
from ..operators import frame, joins, order, profile, rollup
from ..plans import cohort
from ..session import scratch_path
from ..sources.inference import read_inferred
from .registry import PART_SQL, part_with_gaps, query, rounded, table


@query(
    "select_rename",
    'SELECT p_partkey AS id, p_name AS label, p_size AS "size/unit", p_retailprice AS "price%" FROM part',
)
def select_rename(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    return frame.rename_all(part, ["id", "label", "size/unit", "price%"])


@query("select_range", "SELECT p_partkey, p_brand, p_type, p_size, p_retailprice FROM part")
def select_range(spark, folder):
    part = table(spark, folder, "part")
    by_label = frame.columns_between(part, "p_brand", "p_retailprice").columns
    return part.select(*frame.columns_at(part, [0]).columns, *by_label)


@query("select_position", "SELECT p_brand, p_type, p_size, p_retailprice FROM part")
def select_position(spark, folder):
    return frame.columns_at(table(spark, folder, "part"), slice(2, None))


@query("select_integers", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem")
def select_integers(spark, folder):
    line = table(spark, folder, "lineitem")
    return line.select(*frame.names_of_type(line, frame.INTEGRAL))


@query(
    "row_total",
    """SELECT p_partkey, CAST(CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_size END AS DOUBLE)
+ CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_retailprice END + p_partkey AS total FROM part""",
)
def row_total(spark, folder):
    part = part_with_gaps(spark, folder)
    return part.select("p_partkey", total("p_size", "p_retailprice", "p_partkey").alias("total"))


@query(
    "derived_ratio",
    """SELECT c_custkey, round_even(c_acctbal / nullif(c_nationkey, 0), 4) AS per_nation, c_acctbal - c_nationkey AS net
FROM customer""",
)
def derived_ratio(spark, folder):
    customer = table(spark, folder, "customer")
    out = customer.select(
        "c_custkey", ratio("c_acctbal", "c_nationkey").alias("per_nation"), (col("c_acctbal") - col("c_nationkey")).alias("net")
    )
    return rounded(out, 4, "per_nation")


@query(
    "conditional_assign",
    f"""SELECT p_partkey, CASE WHEN p_retailprice > 950 THEN 0.0 ELSE p_retailprice END AS p_retailprice,
CASE WHEN p_size > 40 THEN 100000 END AS big FROM ({PART_SQL})""",
)
def conditional_assign(spark, folder):
    part = part_with_gaps(spark, folder)
    part = frame.assign_where(part, col("p_retailprice") > 950, "p_retailprice", 0.0)
    return frame.assign_where(part, col("p_size") > 40, "big", 100000).select("p_partkey", "p_retailprice", "big")


@query("drop_null_subset", f"SELECT * FROM ({PART_SQL}) WHERE p_size IS NOT NULL AND p_brand IS NOT NULL")
def drop_null_subset(spark, folder):
    return frame.drop_missing(part_with_gaps(spark, folder), ["p_size", "p_brand"])


@query(
    "frequent_categories",
    f"SELECT p_brand, count(*) AS n FROM ({PART_SQL}) WHERE p_brand IS NOT NULL GROUP BY 1 HAVING count(*) > 50",
)
def frequent_categories(spark, folder):
    return profile.frequent_values(part_with_gaps(spark, folder), "p_brand", 50)


_TOTALS = """SELECT o_custkey, o_orderstatus AS tm, count(*) AS g, round_even(sum(o_totalprice), 2) AS mp FROM orders GROUP BY 1, 2
UNION ALL SELECT o_custkey, 'TOT', count(*), round_even(sum(o_totalprice), 2) FROM orders GROUP BY 1
UNION ALL SELECT c_custkey, NULL, 0, 0.0 FROM customer"""


@query("drop_subtotals", f"SELECT * FROM ({_TOTALS}) WHERE tm IS DISTINCT FROM 'TOT'")
def drop_subtotals(spark, folder):
    orders = table(spark, folder, "orders")
    aggs = [F.count("*").alias("g"), F.sum("o_totalprice").alias("mp")]
    by_team = orders.groupBy("o_custkey", F.col("o_orderstatus").alias("tm")).agg(*aggs)
    whole = orders.groupBy("o_custkey").agg(*aggs).withColumn("tm", F.lit("TOT"))
    idle = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.lit(0).cast("bigint").alias("g"), F.lit(0.0).alias("mp"), F.lit(None).cast("string").alias("tm")
    )
    return rounded(frame.drop_value(by_team.unionByName(whole).unionByName(idle), "tm", "TOT"), 2, "mp")


_DICT = """SELECT o_orderpriority, CAST(count(o_custkey) AS BIGINT) AS o_custkey_count, round_even(sum(o_totalprice), 2) AS o_totalprice_sum,
round_even(avg(o_totalprice), 4) AS o_totalprice_mean, min(o_totalprice) AS o_totalprice_min, max(o_totalprice) AS o_totalprice_max
FROM orders GROUP BY 1"""


@query("dict_agg", _DICT)
def dict_agg(spark, folder):
    spec = {"o_custkey": ["count"], "o_totalprice": ["sum", "mean", "min", "max"]}
    out = rollup.aggregate_by(table(spark, folder, "orders"), ["o_orderpriority"], spec)
    return rounded(rounded(out, 2, "o_totalprice_sum"), 4, "o_totalprice_mean")


@query(
    "mean_by_key",
    f"""SELECT p_brand, round_even(avg(p_retailprice), 6) AS p_retailprice, round_even(avg(p_size), 6) AS p_size FROM ({PART_SQL})
WHERE p_brand IS NOT NULL AND p_retailprice IS NOT NULL AND p_size IS NOT NULL GROUP BY 1""",
)
def mean_by_key(spark, folder):
    means = rollup.mean_by(part_with_gaps(spark, folder), ["p_brand"], ["p_retailprice", "p_size"])
    return rounded(means, 6, "p_retailprice", "p_size")


_SIDES = """a AS (SELECT l_suppkey, count(*) AS n, sum(l_quantity) AS qty FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
b AS (SELECT l_suppkey, count(*) AS n, sum(l_quantity) AS qty FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1)"""


@query(
    "join_suffix",
    f"WITH {_SIDES} SELECT a.l_suppkey, a.n AS n_x, a.qty AS qty_x, b.n AS n_y, b.qty AS qty_y FROM a JOIN b USING (l_suppkey)",
)
def join_suffix(spark, folder):
    line = table(spark, folder, "lineitem")

    def side(flag):
        return line.where(F.col("l_returnflag") == flag).groupBy("l_suppkey").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("qty"))

    return joins.merge(side("R"), side("A"), ["l_suppkey"])


@query(
    "join_nullsafe",
    f"""WITH p AS ({PART_SQL}), b AS (SELECT p_brand, count(*) AS n, sum(p_size) AS p_size FROM p GROUP BY 1)
SELECT p.p_partkey, p.p_brand, p.p_size AS p_size_x, CAST(b.p_size AS BIGINT) AS p_size_y, b.n
FROM p JOIN b ON p.p_brand IS NOT DISTINCT FROM b.p_brand""",
)
def join_nullsafe(spark, folder):
    part = part_with_gaps(spark, folder).select("p_partkey", "p_brand", "p_size")
    brands = part.groupBy("p_brand").agg(F.count("*").alias("n"), F.sum("p_size").alias("p_size"))
    return joins.merge(part, brands, ["p_brand"], null_safe=True)


@query(
    "join_salted",
    """SELECT l.l_returnflag, l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity AS l_quantity_x, f.l_quantity AS l_quantity_y
FROM lineitem l JOIN (SELECT l_returnflag, sum(l_quantity) AS l_quantity FROM lineitem GROUP BY 1) f USING (l_returnflag)""",
)
def join_salted(spark, folder):
    """Three keys, each with about a third of the lines."""
    line = table(spark, folder, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    flags = line.groupBy("l_returnflag").agg(F.sum("l_quantity").alias("l_quantity"))
    return joins.merge(line, flags, ["l_returnflag"], salts=8)


# Orders as seasons and customers as players: rookie year = year of the first order.
_COHORT = """seasons AS (SELECT CAST(year(o_orderdate) AS INT) AS "Year", 'c' || o_custkey || '*' AS "Player", o_orderstatus AS "Tm",
  CAST(o_orderkey % 82 + 1 AS DOUBLE) AS "G", o_totalprice / 100 AS "MP", o_totalprice / 1000 AS "PER" FROM orders),
players AS (SELECT 'c' || o_custkey AS "Player", CAST(min(year(o_orderdate)) AS INT) AS "Rookie Year" FROM orders GROUP BY o_custkey),
s AS (SELECT *, replace("Player", '*', '') AS p FROM seasons WHERE "Year" BETWEEN 1995 AND 1999
  AND round_even("MP" / "G", 1) >= 20 AND "Tm" IS DISTINCT FROM 'P'),
cohorts AS (SELECT CAST("Rookie Year" - 1 AS INT) AS "Draft Class", sum("G") AS "G_sum", sum("MP") AS "MP_sum", avg("PER") AS "PER_mean"
  FROM s JOIN players ON s.p = players."Player" WHERE "Rookie Year" IN (1995, 1997) GROUP BY 1)"""


def _cohorts(spark, folder):
    orders = table(spark, folder, "orders")
    seasons = orders.select(
        F.year("o_orderdate").alias("Year"),
        F.format_string("c%d*", "o_custkey").alias("Player"),
        F.when(F.col("o_orderstatus") == "P", "TOT").otherwise(F.col("o_orderstatus")).alias("Tm"),
        (F.col("o_orderkey") % 82 + 1).cast("double").alias("G"),
        (F.col("o_totalprice") / 100).alias("MP"),
        (F.col("o_totalprice") / 1000).alias("PER"),
    )
    players = orders.groupBy("o_custkey").agg(F.min(F.year("o_orderdate")).alias("Rookie Year")).select(
        F.format_string("c%d", "o_custkey").alias("Player"), "Rookie Year"
    )
    spec = {"G": ["sum"], "MP": ["sum"], "PER": ["mean"]}
    return cohort.compare_cohorts(seasons, players, range(1995, 2000), [1995, 1997], spec=spec)


_COHORT_COLS = '"Draft Class", "G_sum", round_even("MP_sum", 2) AS "MP_sum", round_even("PER_mean", 6) AS "PER_mean"'


@query("cohort_join_agg", f"WITH {_COHORT} SELECT {_COHORT_COLS} FROM cohorts")
def cohort_join_agg(spark, folder):
    return rounded(rounded(_cohorts(spark, folder), 2, "MP_sum"), 6, "PER_mean")


@query(
    "sorted_cohorts",
    f"""WITH {_COHORT} SELECT {_COHORT_COLS}, row_number() OVER (ORDER BY cohorts."PER_mean" DESC, "Draft Class") AS position FROM cohorts""",
)
def sorted_cohorts(spark, folder):
    ranked = cohort.ranked_cohorts(_cohorts(spark, folder), "PER_mean")
    return rounded(rounded(ranked, 2, "MP_sum"), 6, "PER_mean")


@query(
    "dedup_first",
    """SELECT event_id, user_id, event_type, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1""",
)
def dedup_first(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value", "props")
    return order.keep_first(events, ["user_id"], [F.col("event_id")])


@query(
    "csv_round_trip",
    """SELECT o_orderkey + 9007199254740993 AS id, CAST(CAST(o_orderkey AS HUGEINT) * 1000000000000000000000 + 7 AS VARCHAR) AS wide_id, o_orderpriority AS priority,
CASE WHEN o_orderkey % 11 = 3 THEN NULL ELSE o_totalprice END AS price, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderkey % 2 = 0 AS even,
strftime(CAST(o_orderdate AS TIMESTAMP) + to_seconds(o_orderkey % 86400), '%Y-%m-%d %H:%M:%S') AS moment, CASE WHEN o_orderkey % 5 = 1 THEN NULL ELSE o_custkey END AS customer FROM orders""",
)
def csv_round_trip(spark, folder):
    """A table written as CSV in the shared folder and read back without a schema."""
    key = F.col("o_orderkey")
    rows = table(spark, folder, "orders").select(
        (key + F.lit(9007199254740993)).alias("id"), F.concat(key.cast("string"), F.lit("000000000000000000007")).alias("wide_id"),
        F.col("o_orderpriority").alias("priority"), F.when(key % 11 == 3, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")).alias("price"),
        F.col("o_orderdate").cast("date").alias("day"), (key % 2 == 0).alias("even"),
        F.date_format(F.expr("timestampadd(SECOND, CAST(o_orderkey % 86400 AS INT), CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP_NTZ))"), "yyyy-MM-dd HH:mm:ss").alias("moment"),
        F.when(key % 5 != 1, F.col("o_custkey")).alias("customer"),
    )
    path = scratch_path(spark, "csv")
    rows.write.option("header", True).csv(path)
    back = read_inferred(spark, path).drop("bad_record")
    return back.withColumns({c: F.col(c).cast("string") for c in ("wide_id", "day", "moment")})  # decimal, date, timestamp
