"""Tables and links out of HTML."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import scrape
from ..sources import html
from .registry import query, rounded, table


@query(
    "html_links",
    r"""WITH li AS (SELECT page_id, regexp_extract_all(regexp_replace(html, '<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'gis'),
  '<li(?:\s[^>]*)?>(.*?)</li\s*>', 1, 'is') AS m FROM pages),
e AS (SELECT page_id, CAST(unnest(range(len(m))) AS INT) AS pos, unnest(m) AS markup FROM li)
SELECT page_id, pos, regexp_extract(markup, 'href="([^"]*)"', 1) AS href,
replace(replace(replace(regexp_replace(markup, '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS label
FROM e WHERE regexp_matches(markup, '^\s*<a\s')""",
)
def html_links(spark, folder):
    return html.links(table(spark, folder, "pages"), "html", ["page_id"])


@query(
    "html_text_elements",
    r"""WITH p AS (SELECT page_id, regexp_extract_all(regexp_replace(html, '<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'gis'),
  '<h1(?:\s[^>]*)?>(.*?)</h1\s*>', 1, 'is') AS m FROM pages)
SELECT page_id, CAST(unnest(range(len(m))) AS INT) AS pos, unnest(m) AS markup FROM p""",
)
def html_text_elements(spark, folder):
    return html.elements(table(spark, folder, "pages"), "html", "h1", ["page_id"])


def _sheets(spark, folder, advanced: bool = False):
    """One page per part brand and size with a season table of its parts.

    Header row, units row, then one row per part; every tenth part is followed by a repeated header.
    A page holds one brand, type, size and run of 5000 part keys: at most 5000 rows at any scale.
    """
    part = table(spark, folder, "part")
    third, fourth = ("Size", "Price") if not advanced else ("Size", "Rate")
    value = F.col("p_retailprice") if not advanced else F.round(F.col("p_retailprice") / 7, 3)
    head = f"<tr><th>Rk</th><th>Player</th><th>{third}</th><th>{fourth}</th></tr>"
    size = F.when(F.col("p_partkey") % 7 == 0, F.lit("")).otherwise(F.col("p_size").cast("string"))
    row = F.concat(
        F.lit("<tr><th>1</th><td class='left'>"), F.format_string("%s &amp; <a href='/p'>no %d</a>", "p_name", "p_partkey"),
        F.lit("</td><td>"), size, F.lit("</td><td>"), value.cast("string"), F.lit("</td></tr>"),
        F.when(F.col("p_partkey") % 10 == 0, F.lit(head)).otherwise(F.lit("")),
    )
    page = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("p_partkey", row.alias("row")))), lambda r: r["row"]), "\n")
    opening = F.lit("<html><!-- <tr><td>no</td></tr> --><table>" + head + "<tr><th>unit</th></tr>")
    key = F.concat_ws("/", "p_brand", "p_type", "p_size", F.floor(F.col("p_partkey") / 5000).cast("string"))
    return part.groupBy(key.alias("page")).agg(F.concat(opening, page, F.lit("</table></html>")).alias("html"))


_PAGE = "concat_ws('/', p_brand, p_type, p_size, CAST(floor(p_partkey / 5000) AS BIGINT))"


@query(
    "html_headers",
    f"""SELECT DISTINCT {_PAGE} AS page, pos, name FROM part, (VALUES (0, 'Player'), (1, 'Size'), (2, 'Price')) h(pos, name)""",
)
def html_headers(spark, folder):
    return html.header_names(_sheets(spark, folder), "html", ["page"])


_ROWS = f"""SELECT {_PAGE} AS page, p_partkey, 0 AS part_of, p_name || ' & no ' || p_partkey AS "Player",
  CASE WHEN p_partkey % 7 = 0 THEN '' ELSE CAST(p_size AS VARCHAR) END AS "Size", p_retailprice AS "Price" FROM part
UNION ALL SELECT {_PAGE}, p_partkey, 1, NULL, NULL, NULL FROM part WHERE p_partkey % 10 = 0"""


@query(
    "html_table_rows",
    f"""SELECT page, CAST(row_number() OVER (PARTITION BY page ORDER BY p_partkey, part_of) - 1 AS INT) AS row,
"Player", "Size", "Price" FROM ({_ROWS})""",
)
def html_table_rows(spark, folder):
    rows = scrape.season_table(_sheets(spark, folder), "html", "page", ["Player", "Size", "Price"])
    return rows.withColumn("Price", F.col("Price").cast("double"))


@query(
    "scrape_join",
    """SELECT p_name || ' & no ' || p_partkey AS "Player", CASE WHEN p_partkey % 7 = 0 THEN 0.0 ELSE p_size END::DOUBLE AS "Size_x",
p_retailprice AS "Price", CASE WHEN p_partkey % 7 = 0 THEN 0.0 ELSE p_size END::DOUBLE AS "Size_y", round_even(p_retailprice / 7, 2) AS "Rate" FROM part""",
)
def scrape_join(spark, folder):
    sides = [
        scrape.clean_season(scrape.season_table(_sheets(spark, folder, advanced), "html", "page", ["Player", "Size", "Rate" if advanced else "Price"]), "page")
        for advanced in (False, True)
    ]
    return rounded(scrape.joined_seasons(*sides), 2, "Rate")


@query(
    "scrape_mixed_headers",
    f"""SELECT page, p_partkey, "Player", "Size", "Price", "Rate" FROM (
  SELECT 'a' || {_PAGE} AS page, p_partkey, p_name || ' & no ' || p_partkey AS "Player",
    CASE WHEN p_partkey % 7 = 0 THEN '' ELSE CAST(p_size AS VARCHAR) END AS "Size", p_retailprice AS "Price", NULL::DOUBLE AS "Rate" FROM part
  UNION ALL SELECT 'b' || {_PAGE}, p_partkey, p_name || ' & no ' || p_partkey,
    CASE WHEN p_partkey % 7 = 0 THEN '' ELSE CAST(p_size AS VARCHAR) END, NULL, round_even(p_retailprice / 7, 2) FROM part)""",
)
def scrape_mixed_headers(spark, folder):
    """Pages with two different headers in one table: a column that a page lacks is NULL."""
    pages = None
    for advanced, prefix in ((False, "a"), (True, "b")):
        own = _sheets(spark, folder, advanced).withColumn("page", F.concat(F.lit(prefix), "page"))
        pages = own if pages is None else pages.unionByName(own)
    rows = scrape.season_table(pages, "html", "page").where("Player IS NOT NULL")
    key = F.regexp_extract("Player", r"(\d+)$", 1).cast("long").alias("p_partkey")
    typed = rows.select("page", key, "Player", "Size", F.col("Price").cast("double").alias("Price"), F.col("Rate").cast("double").alias("Rate"))
    return rounded(typed, 2, "Rate")
