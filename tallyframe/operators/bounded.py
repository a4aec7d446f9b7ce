"""Broadcast only what is proven small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import quote

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20  # of columns whose values have no fixed size


def small_table(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int | None = None) -> DataFrame | None:
    """The table as a local one if it has at most max_rows rows and max_bytes (``BROADCAST_BYTES``) of texts, arrays
    and the like, else None.

    Such columns are measured where the rows are, before any row comes to the driver; a table without them is read at
    once, max_rows + 1 rows at most.  What was read is not computed again by the caller's plan.
    """
    long = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DatetimeType))]
    if long:
        size = F.sum(F.octet_length(F.to_json(F.struct(*[F.col(quote(c)) for c in long]))))
        found = df.limit(max_rows + 1).agg(F.count("*").alias("n"), size.alias("size")).first()
        if found["n"] > max_rows or (found["size"] or 0) > (BROADCAST_BYTES if max_bytes is None else max_bytes):
            return None
    rows = df.limit(max_rows + 1).collect()
    return df.sparkSession.createDataFrame(rows, df.schema) if len(rows) <= max_rows else None


def join_lookup(
    big: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "inner", max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Join a lookup table: broadcast after its size was checked, else a shuffle join.

    The shuffle join leaves hot keys to adaptive skew handling, which splits their partitions.
    """
    local = small_table(lookup, max_rows)
    return big.join(lookup if local is None else F.broadcast(local), list(on), how)
