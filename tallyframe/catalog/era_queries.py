"""Era comparison: filters, roll-ups, rates, ranking, trends."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.metrics import minutes_per_game
from ..functions.numeric import caption, in_years, round_even
from ..operators import order, relate
from ..operators.frame import keep_values
from ..plans import era
from ..session import durable
from .registry import CAREER_SQL, ERAS, MIN_GAMES, SEASON_SQL, query, rates_sql, rounded, stints, table


@query(
    "era_filter",
    """SELECT l_suppkey, CAST(year(l_shipdate) AS INT) AS year, l_returnflag, l_quantity FROM lineitem
WHERE year(l_shipdate) BETWEEN 1995 AND 1998 AND l_returnflag = 'R'""",
)
def era_filter(spark, folder):
    line = table(spark, folder, "lineitem").where(in_years("l_shipdate", 1995, 1998)).withColumn("year", F.year("l_shipdate"))
    kept = keep_values(line, "year", list(range(1995, 1999))).where(F.col("l_returnflag") == "R")
    return kept.select("l_suppkey", "year", "l_returnflag", "l_quantity")


@query("season_rollup", f"WITH {SEASON_SQL} SELECT * FROM era_season")
def season_rollup(spark, folder):
    return era.season_totals(stints(spark, folder), ERAS, MIN_GAMES)


@query("career_rollup", f"WITH {CAREER_SQL} SELECT * FROM career")
def career_rollup(spark, folder):
    return era.career_totals(era.season_totals(stints(spark, folder), ERAS, MIN_GAMES))


@query("rate_stats", f"WITH {CAREER_SQL} {rates_sql('career')} SELECT * FROM players")
def rate_stats(spark, folder):
    return era.era_players(stints(spark, folder), ERAS, MIN_GAMES, "career")


@query("rate_stats_season", f"WITH {SEASON_SQL} {rates_sql('era_season')} SELECT * FROM players")
def rate_stats_season(spark, folder):
    return era.era_players(stints(spark, folder), ERAS, MIN_GAMES, "season")


@query(
    "top_scorers",
    f"""WITH {CAREER_SQL} {rates_sql('career')} SELECT * FROM players
QUALIFY row_number() OVER (PARTITION BY era ORDER BY "R" DESC, "playerID") <= 100""",
)
def top_scorers(spark, folder):
    return era.top_scorers(era.era_players(stints(spark, folder), ERAS, MIN_GAMES))


_STAT_ROWS = "UNPIVOT (SELECT era, \"R\", \"AVG\", \"OPS\", \"OBP\", \"SLG\" FROM players) ON \"AVG\", \"OPS\", \"OBP\", \"SLG\" INTO NAME stat VALUE v"
_TREND_COLS = """CASE WHEN var_pop(v) > 0 THEN round_even(regr_slope("R", v), 2) END AS slope,
CASE WHEN var_pop(v) > 0 THEN round_even(regr_intercept("R", v), 2) END AS intercept,
CASE WHEN var_pop(v) > 0 AND var_pop("R") > 0 THEN round_even(corr(v, "R"), 6) END AS r"""


@query(
    "trend_by_stat",
    f"""WITH {SEASON_SQL} {rates_sql('era_season')}, long AS ({_STAT_ROWS})
SELECT era, stat, {_TREND_COLS} FROM long GROUP BY era, stat""",
)
def trend_by_stat(spark, folder):
    players = era.era_players(stints(spark, folder), ERAS, MIN_GAMES, "season")
    trends = era.trend_by_stat(players, era.RATES, "R", ["era"]).drop("n", "mean")
    return rounded(rounded(trends, 2, "slope", "intercept"), 6, "r")


@query(
    "era_compare",
    f"""WITH {SEASON_SQL} {rates_sql('era_season')}, long AS ({_STAT_ROWS})
SELECT era, stat, count(*) AS n, round_even(avg(v), 6) AS mean, {_TREND_COLS} FROM long GROUP BY era, stat""",
)
def era_compare(spark, folder):
    players = era.era_players(stints(spark, folder), ERAS, MIN_GAMES, "season")
    return rounded(rounded(era.era_compare(players), 2, "slope", "intercept"), 6, "r", "mean")


@query(
    "stat_captions",
    f"""WITH {SEASON_SQL} {rates_sql('era_season')}, long AS ({_STAT_ROWS})
SELECT era, stat, stat || ' against runs: r = ' || format('{{:.3f}}', corr(v, "R")) AS caption
FROM long GROUP BY era, stat""",
)
def stat_captions(spark, folder):
    players = era.era_players(stints(spark, folder), ERAS, MIN_GAMES, "season")
    text = caption("%s against runs: r = %.3f", "stat", "r")
    return era.era_compare(players).select("era", "stat", text.alias("caption"))


@query("era_fit")
def era_fit(spark, folder):
    return era.fit_runs(era.era_players(stints(spark, folder), ERAS, MIN_GAMES))


@query(
    "per_game_filter",
    """WITH s AS (SELECT l_suppkey, CAST(year(l_shipdate) AS INT) AS year, CAST(count(*) AS DOUBLE) AS g, sum(l_quantity) AS mp
FROM lineitem GROUP BY 1, 2)
SELECT l_suppkey, year, round_even(mp / g, 1) AS mpg FROM s WHERE round_even(mp / g, 1) >= 25""",
)
def per_game_filter(spark, folder):
    seasons = table(spark, folder, "lineitem").groupBy("l_suppkey", F.year("l_shipdate").alias("year")).agg(
        F.count("*").alias("G"), F.sum("l_quantity").alias("MP")
    )
    return seasons.withColumn("mpg", minutes_per_game(1)).where("mpg >= 25").select("l_suppkey", "year", "mpg")


_REVENUE = "SELECT l_suppkey, round_even(sum(l_extendedprice), 2) AS revenue FROM lineitem GROUP BY 1"


def _revenue(spark, folder):
    return table(spark, folder, "lineitem").groupBy("l_suppkey").agg(round_even(F.sum("l_extendedprice"), 2).alias("revenue"))


@query("topk", f"SELECT * FROM ({_REVENUE}) ORDER BY revenue DESC, l_suppkey LIMIT 100")
def topk(spark, folder):
    return order.top_k(_revenue(spark, folder), "revenue", 100, ["l_suppkey"])


@query("preview", "SELECT * FROM part ORDER BY p_partkey LIMIT 5")
def preview(spark, folder):
    return table(spark, folder, "part").orderBy("p_partkey").limit(5)


@query(
    "rank_position",
    f"SELECT *, row_number() OVER (ORDER BY revenue DESC, l_suppkey) AS position FROM ({_REVENUE})",
)
def rank_position(spark, folder):
    return order.with_position(durable(_revenue(spark, folder)), order.descending("revenue", tie=["l_suppkey"]))


@query(
    "trend_line",
    """WITH t AS (SELECT regr_slope(o_totalprice, o_custkey) AS m, regr_intercept(o_totalprice, o_custkey) AS b FROM orders)
SELECT o_orderkey, round_even(m * o_custkey + b, 4) AS trend FROM orders, t""",
)
def trend_line(spark, folder):
    orders = table(spark, folder, "orders")
    return rounded(relate.with_trend(orders, "o_custkey", "o_totalprice").select("o_orderkey", "trend"), 4, "trend")


@query(
    "trend_coefficients",
    """SELECT round_even(regr_slope(o_totalprice, o_custkey), 6) AS slope,
round_even(regr_intercept(o_totalprice, o_custkey), 4) AS intercept FROM orders""",
)
def trend_coefficients(spark, folder):
    line = relate.trend(table(spark, folder, "orders"), "o_custkey", "o_totalprice")
    return rounded(rounded(line, 6, "slope"), 4, "intercept")
