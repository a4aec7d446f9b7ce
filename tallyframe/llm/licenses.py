"""License scans: canonical texts looked up by digest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .license_digests import FULL

# Spellings that count as equal.
SAME = [
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sub license", "sublicense"), ("sub licensable", "sublicensable"),
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("authorise", "authorize"), ("authorised", "authorized"), ("behaviour", "behavior"),
    ("copyright owner", "copyright holder"), ("copyright owners", "copyright holders"), ("favour", "favor"), ("fulfil", "fulfill"), ("honour", "honor"),
    ("judgement", "judgment"), ("merchantibility", "merchantability"), ("non commercial", "noncommercial"), ("organisation", "organization"),
    ("per cent", "percent"), ("programme", "program"), ("recognise", "recognize"), ("utilise", "utilize"), ("whilst", "while"), ("wilful", "willful"),
    ("https", "http"), ("v", "version"),
]
COPYRIGHT = r"(?i)^[^\p{L}\p{N}]*(copyright[^\n]*([0-9]{4}|\(c\)|©)|\(c\)|©|all rights reserved)"
OTHER = r"[^\p{L}\p{N}]+"

# Licenses and notices of a line.
KNOWN = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Released under CC0 1.0.",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
}


def canonical(text: Column) -> Column:
    """Lower case, lines that only state a copyright gone, words of letters and digits parted by one space, and one
    spelling for words that count as equal.  NULL is an empty text."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: ~line.rlike(COPYRIGHT))
    words = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(F.array_join(lines, "\n")), OTHER, "  ")), F.lit(" "))
    for old, new in SAME:
        words = F.replace(words, F.lit(f" {old.replace(' ', '  ')} "), F.lit(f" {new.replace(' ', '  ')} "))
    return F.trim(F.regexp_replace(words, " +", " "))


def sql_canonical(text: str) -> str:
    """The same as ``canonical`` in DuckDB's SQL."""
    lines = f"array_to_string(list_filter(string_split(coalesce({text}, ''), chr(10)), lambda l: NOT regexp_matches(l, '{COPYRIGHT}')), chr(10))"
    words = f"' ' || trim(regexp_replace(lower({lines}), '{OTHER}', '  ', 'g')) || ' '"
    for old, new in SAME:
        words = f"replace({words}, ' {old.replace(' ', '  ')} ', ' {new.replace(' ', '  ')} ')"
    return f"trim(regexp_replace({words}, ' +', ' ', 'g'))"


def digest(kept: Column) -> Column:
    """SHA-256 of a canonical text, NULL when nothing is left of it."""
    return F.when(kept != "", F.sha2(kept, 256))


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is worked out once: a row generated from it is a border for the optimiser, which would else copy
    the expression into every filter and projection that reads it."""
    return df.select(*df.columns, F.explode(F.array(value)).alias(name))


def known_licenses(spark: SparkSession) -> DataFrame:
    """(license_id, text, canonical_sha256) of the built-in list, full texts as digests alone; a longer list is a table
    of the caller's."""
    rows = [(i, text, None) for i, text in KNOWN.items()] + [(i, None, d) for i, digests in FULL.items() for d in digests]
    return spark.createDataFrame(rows, "license_id string, text string, canonical_sha256 string")


def scan(docs: DataFrame, licenses: DataFrame, text: str = "text") -> DataFrame:
    """Look whole texts, and each of their lines, up among known licenses: (license_id, text) or, where a license has no
    text, its canonical_sha256.

    Adds canonical_sha256 (NULL for a text of which nothing is left), license_id (the license that the entire text is,
    the least id of several with one canonical text, or NULL), line_licenses (ids of the licenses that entire lines
    are, sorted) and n_license_lines.  NULL texts are empty; columns of the added names are replaced.

    Texts do not move: lines are exchanged as digests, and only those of known licenses come back, one row per text.
    The known digests are joined without a hint, so that Spark broadcasts a short list and shuffles a long one, whose
    hot digests adaptive execution splits.
    """
    added = ["canonical_sha256", "license_id", "line_licenses", "n_license_lines"]
    own = docs.drop(*added)
    given = F.col("canonical_sha256") if "canonical_sha256" in licenses.columns else F.lit(None).cast("string")
    known = licenses.select(F.coalesce(digest(canonical(F.col("text"))), given).alias("__known"), "license_id").where("__known is not null").groupBy("__known").agg(F.min("license_id").alias("license_id"))
    named = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    marked = once(own, "__kept", canonical(F.col(text))).withColumns({"canonical_sha256": digest(F.col("__kept")), "__text": named}).drop("__kept")
    whole = marked.join(known, marked["canonical_sha256"] == known["__known"], "left").drop("__known")
    lines = once(own.select(F.col(text)), "__text", named).select("__text", F.posexplode(F.split(text, "\n")).alias("__line", "line"))
    lines = once(lines, "__kept", canonical(F.col("line"))).select("__text", "__line", digest(F.col("__kept")).alias("__known"))
    found = lines.join(known, "__known").select("__text", "__line", "license_id").distinct()
    found = found.groupBy("__text").agg(F.array_sort(F.collect_set("license_id")).alias("line_licenses"), F.count(F.lit(1)).alias("n_license_lines"))
    out = whole.join(found, "__text", "left").withColumns({
        "line_licenses": F.coalesce("line_licenses", F.array().cast("array<string>")),
        "n_license_lines": F.coalesce("n_license_lines", F.lit(0)).cast("long"),
    })
    return out.select(*own.columns, *added)
