"""Registration of queries and the tables they read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import in_years, round_even

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is the DuckDB statement that must give the same rows."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({c: round_even(c, digits) for c in names})


# ``part`` with gaps: the driver tables have no NULLs of their own.
GAPS = {
    "p_size": "CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_size END",
    "p_brand": "CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_brand END",
    "p_retailprice": "CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_retailprice END",
}
PART_SQL = (
    "SELECT p_partkey, p_name, "
    + ", ".join(f"{v} AS {k}" for k, v in GAPS.items())
    + ", p_type FROM part"
)


def part_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    return part.select("p_partkey", "p_name", *[F.expr(v).alias(k) for k, v in GAPS.items()], "p_type")


# ``lineitem`` as batting lines: supplier = player, year shipped = season, line = game.
STINT = {
    "playerID": "l_suppkey",
    "yearID": "CAST(year(l_shipdate) AS INT)",
    "teamID": "l_linestatus",
    "G": "CAST(1 AS BIGINT)",
    "AB": "CAST(l_quantity AS BIGINT)",
    "R": "CAST(floor(l_extendedprice / 1000) AS BIGINT)",
    "H": "CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) ELSE CAST(0 AS BIGINT) END",
    "HR": "CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN CAST(l_quantity AS BIGINT) ELSE CAST(0 AS BIGINT) END",
    "RBI": "CAST(floor(l_extendedprice * l_discount / 100) AS BIGINT)",
    "BB": "CASE WHEN l_returnflag = 'A' AND l_linenumber <= 2 THEN CAST(l_quantity AS BIGINT) ELSE CAST(0 AS BIGINT) END",
    "2B": "CASE WHEN l_returnflag = 'R' AND l_linenumber = 2 THEN CAST(l_quantity AS BIGINT) ELSE CAST(0 AS BIGINT) END",
    "3B": "CASE WHEN l_returnflag = 'R' AND l_linenumber = 3 THEN CAST(l_quantity AS BIGINT) ELSE CAST(0 AS BIGINT) END",
    "HBP": "CASE WHEN l_linenumber = 7 THEN CAST(1 AS BIGINT) END",
    "SF": "CASE WHEN l_returnflag = 'N' THEN CAST(1 AS BIGINT) END",
}
STINT_SQL = "SELECT " + ", ".join(f'{v} AS "{k}"' for k, v in STINT.items()) + " FROM lineitem"
ERAS = {"early": (1995, 1997), "late": (1998, 2001)}
MIN_GAMES = 85

_SUMS = ["G", "AB", "R", "H", "HR", "RBI", "BB", "2B", "3B", "HBP", "SF"]
SEASON_SQL = (
    f"""stint AS ({STINT_SQL}), season AS (SELECT "playerID", "yearID", """
    + ", ".join(f'CAST(coalesce(sum("{c}"), 0) AS BIGINT) AS "{c}"' for c in _SUMS)
    + f""" FROM stint GROUP BY 1, 2 HAVING sum("G") > {MIN_GAMES}),
era_season AS (SELECT CASE WHEN "yearID" BETWEEN 1995 AND 1997 THEN 'early' ELSE 'late' END AS era, * FROM season
               WHERE "yearID" BETWEEN 1995 AND 2001)"""
)
CAREER_SQL = (
    SEASON_SQL
    + """, career AS (SELECT era, "playerID", """
    + ", ".join(f'CAST(sum("{c}") AS BIGINT) AS "{c}"' for c in _SUMS)
    + " FROM era_season GROUP BY 1, 2)"
)


def rates_sql(source: str) -> str:
    """CTE ``players``: a totals table with rates, missing rates filled by the era's mean."""
    return f""", r1 AS (SELECT *, round_even("H" / nullif("AB", 0), 3) AS "AVG",
    "2B" * 2 + "3B" * 3 + "HR" * 4 + ("H" - "HR" - "3B" - "2B") AS "TB",
    round_even(("H" + "BB" + "HBP") / nullif("AB" + "BB" + "HBP" + "SF", 0), 3) AS "OBP" FROM {source}),
r2 AS (SELECT *, round_even("TB" / nullif("AB", 0), 3) AS "SLG" FROM r1),
r3 AS (SELECT *, round_even("OBP" + "SLG", 3) AS "OPS" FROM r2),
players AS (SELECT * REPLACE (coalesce("OBP", round_even(avg("OBP") OVER e, 3)) AS "OBP",
    coalesce("SLG", round_even(avg("SLG") OVER e, 3)) AS "SLG",
    coalesce("OPS", round_even(avg("OPS") OVER e, 3)) AS "OPS") FROM r3 WINDOW e AS (PARTITION BY era))"""


def stints(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of the eras' years; the limits on the date reach the scan, those on the derived year would not."""
    first, last = min(a for a, _ in ERAS.values()), max(b for _, b in ERAS.values())
    line = table(spark, folder, "lineitem").where(in_years("l_shipdate", first, last))
    return line.select(*[F.expr(v).alias(k) for k, v in STINT.items()])
