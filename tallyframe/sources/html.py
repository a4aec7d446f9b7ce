"""Tables and elements out of a column of crawled HTML.

Everything is regular expressions inside the JVM.  Comments, scripts and styles are removed first, cells
may lack their end tag, and markup inside a cell is dropped, leaving its text.  Pages with tables nested
in cells go through ``parsed_table_rows`` instead.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import col

# The entities decoded in cell text (&amp; last, so that nothing is decoded twice).
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def visible(html: Column) -> Column:
    """HTML without comments, scripts and styles."""
    return F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>", "")


def text_of(markup: Column) -> Column:
    """Text of a piece of markup: tags dropped, entities decoded."""
    out = F.regexp_replace(markup, r"(?s)<[^>]*>", "")
    for entity, char in ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


def _inner(html: Column, tag: str) -> Column:
    """Array of the inner markup of every element with this tag."""
    ends = {
        "tr": r"(?=</tr|<tr\b|</table|</tbody|</thead|\z)",
        "td": r"(?=</td|<td\b|<th\b|</th|</tr|\z)",
        "th": r"(?=</th|<th\b|<td\b|</td|</tr|\z)",
    }
    end = ends.get(tag, rf"</{tag}\s*>")
    return F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}(?:\s[^>]*)?>(.*?){end}"), F.lit(1))


def elements(pages: DataFrame, html: str, tag: str, keys: Sequence[str]) -> DataFrame:
    """Every element with a tag: the key columns, ``pos`` (0-based in the page) and inner ``markup``."""
    return pages.select(*[col(k) for k in keys], F.posexplode(_inner(visible(col(html)), tag)).alias("pos", "markup"))


def attribute(open_tags: Column, name: str) -> Column:
    """Value of a quoted attribute in an opening tag."""
    return F.regexp_extract(open_tags, rf"(?is)\b{name}\s*=\s*[\"']([^\"']*)[\"']", 1)


def links(pages: DataFrame, html: str, keys: Sequence[str]) -> DataFrame:
    """Links that are list items: key columns, ``pos``, ``href`` and ``label``."""
    items = elements(pages, html, "li", keys).where(F.col("markup").rlike(r"(?i)^\s*<a\s"))
    opening = F.regexp_extract("markup", r"(?is)(<a\s[^>]*>)", 1)
    return items.select(*[col(k) for k in keys], "pos", attribute(opening, "href").alias("href"), text_of(F.col("markup")).alias("label"))


def header_names(pages: DataFrame, html: str, keys: Sequence[str]) -> DataFrame:
    """Header texts of the first row of each page, without the first one (the rank column)."""
    first = F.get(_inner(visible(col(html)), "tr"), F.lit(0))
    cells = _inner(first, "th")
    named = F.slice(cells, F.lit(2), F.greatest(F.size(cells) - 1, F.lit(0)))
    return pages.select(*[col(k) for k in keys], F.posexplode(named).alias("pos", "markup")).select(
        *[col(k) for k in keys], "pos", text_of(F.col("markup")).alias("name")
    )


def table_rows(pages: DataFrame, html: str, keys: Sequence[str], skip: int = 2) -> DataFrame:
    """Data rows: key columns, ``row`` (0-based after the skipped ones) and ``cells``, an array of texts.

    Rows without any data cell (headers repeated in the body) come out with an empty array.  ``skip``
    counts leading rows to leave out: 2 is what the original reads; 1 fits a single header row.
    """
    rows = elements(pages, html, "tr", keys).where(F.col("pos") >= skip)
    cells = F.transform(_inner(F.col("markup"), "td"), text_of)
    return rows.select(*[col(k) for k in keys], (F.col("pos") - skip).alias("row"), cells.alias("cells"))


def named_rows(pages: DataFrame, html: str, keys: Sequence[str], skip: int = 2) -> DataFrame:
    """Like ``table_rows``, each row with ``names``: the header of its own page without the rank column."""
    rows = pages.select(*[col(k) for k in keys], _inner(visible(col(html)), "tr").alias("_rows"))
    heads = _inner(F.get("_rows", F.lit(0)), "th")
    names = F.transform(F.slice(heads, F.lit(2), F.greatest(F.size(heads) - 1, F.lit(0))), text_of)
    each = rows.withColumn("names", names).select(*[col(k) for k in keys], "names", F.posexplode("_rows").alias("pos", "markup"))
    cells = F.transform(_inner(F.col("markup"), "td"), text_of)
    return each.where(F.col("pos") >= skip).select(*[col(k) for k in keys], (F.col("pos") - skip).alias("row"), "names", cells.alias("cells"))


def to_columns(rows: DataFrame, names: Sequence[str], keys: Sequence[str], header: str | None = None) -> DataFrame:
    """Cells as named text columns; short rows end in NULLs.

    With ``header``, a column with each row's own names, a cell goes to the column of its name, and columns that
    the row's header lacks are NULL; a name outside ``names`` is left out by choice of the caller.  A row with
    more cells than names is an error either way, not a shorter row.
    """
    known = F.col(header) if header is not None else F.array(*[F.lit(n) for n in names])
    message = F.concat(F.lit("a row has "), F.size("cells").cast("string"), F.lit(" cells under "), F.size(known).cast("string"), F.lit(" names"))
    safe = F.when(F.size("cells") > F.size(known), F.raise_error(message).cast("array<string>")).otherwise(F.col("cells"))
    place = lambda i, n: F.lit(i) if header is None else F.array_position(known, n).cast("int") - 1
    cell = lambda i, n: F.when(place(i, n) >= 0, F.get("_cells", place(i, n)))
    return rows.withColumn("_cells", safe).select(*[col(k) for k in keys], "row", *[cell(i, n).alias(n) for i, n in enumerate(names)])


class _Rows(HTMLParser):
    """Collect the td texts of each tr; text of a nested table counts for its outer cell as well."""

    def __init__(self) -> None:
        super().__init__()
        self.rows: list[list[str]] = []
        self.open_rows: list[int] = []
        self.open_cells: list[tuple[int, int]] = []
        self.hidden = 0

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self.open_rows.append(len(self.rows))
            self.rows.append([])
        elif tag == "td" and self.open_rows:
            row = self.open_rows[-1]
            self.open_cells.append((row, len(self.rows[row])))
            self.rows[row].append("")
        elif tag in ("script", "style"):
            self.hidden += 1

    def handle_endtag(self, tag):
        if tag == "tr" and self.open_rows:
            done = self.open_rows.pop()
            self.open_cells = [c for c in self.open_cells if c[0] != done]
        elif tag == "td" and self.open_cells:
            self.open_cells.pop()
        elif tag in ("script", "style"):
            self.hidden = max(0, self.hidden - 1)

    def handle_data(self, data):
        if not self.hidden:
            for row, cell in self.open_cells:
                self.rows[row][cell] += data


def parsed_table_rows(pages: DataFrame, html: str, keys: Sequence[str], skip: int = 2) -> DataFrame:
    """Like ``table_rows`` with the standard library's parser, for tables nested in cells."""
    kept = [pages.schema[k] for k in keys]
    schema = T.StructType(
        [*kept, T.StructField("row", T.IntegerType()), T.StructField("cells", T.ArrayType(T.StringType()))]
    )
    names = list(keys)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for record in batch.itertuples(index=False):
                parser = _Rows()
                parser.feed(record[-1] or "")
                parser.close()
                found += [(*record[:-1], i, cells) for i, cells in enumerate(parser.rows[skip:])]
            yield pd.DataFrame(found, columns=[*names, "row", "cells"])

    return pages.select(*[col(k) for k in keys], col(html)).mapInPandas(parse, schema)
