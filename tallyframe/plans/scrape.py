"""Season tables out of crawled pages, cleaned and joined."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import col
from ..operators.clean import fill_zero, infer_numeric
from ..operators.frame import drop_missing
from ..operators.joins import merge
from ..operators.order import keep_first
from ..session import durable
from ..sources.html import header_names, named_rows, to_columns


MOST_COLUMNS = 10_000


def page_columns(pages: DataFrame, html: str, key: str) -> list[str]:
    """All column names of all pages, by the first place they stand at, then by name."""
    found = header_names(pages, html, [key]).groupBy("name").agg(F.min("pos").alias("pos")).orderBy("pos", "name")
    names = [r["name"] for r in found.limit(MOST_COLUMNS + 1).collect()]
    if len(names) > MOST_COLUMNS:
        raise ValueError(f"more than {MOST_COLUMNS} different column names")
    return names


def season_table(
    pages: DataFrame, html: str, key: str, names: Sequence[str] | None = None, skip: int = 2
) -> DataFrame:
    """All data rows of all pages as text columns, with page key and row number.

    A cell belongs to the name in its own page's header, so pages may order or choose columns differently.  Given
    ``names``, the pages are read once; otherwise a pass over the headers finds all names first.
    """
    chosen = list(names) if names is not None else page_columns(pages, html, key)
    return to_columns(named_rows(pages, html, [key], skip), chosen, [key], header="names")


def clean_season(table: DataFrame, key: str, player: str = "Player") -> DataFrame:
    """Drop header rows, make numbers numeric, fill gaps with 0, keep each player's first row.

    The cells are checkpointed: the pass that decides the types must not parse the pages a second time.
    """
    named = durable(drop_missing(table, [player]))
    typed = fill_zero(infer_numeric(named, [c for c in table.columns if c not in (key, "row")]))
    return keep_first(typed, [player], [col(key), F.col("row")]).drop(key, "row")


def joined_seasons(basic: DataFrame, advanced: DataFrame, player: str = "Player") -> DataFrame:
    """Basic and advanced statistics of the same players side by side."""
    return merge(basic, advanced, [player])
