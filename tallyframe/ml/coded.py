"""Features as ranks: a table in a few bytes a row, and sums over its rows by value.

Where a feature has few values, one pass finds them, and a row keeps the rank of its value times the number of classes plus its
class: in one, two or four bytes.  A feature of more values travels as it is and is ranked where the rows arrive.  Ranks
lose nothing: every cut between values is a cut between ranks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

MOST_VALUES = 1 << 16  # values of a feature whose ranks are made before rows travel
VALUES_BYTES = 1 << 26  # bytes of the values of all features on the driver
CHUNK = 1 << 16  # rows summed at a time, so that they stay in the processor's cache
FOUND = "f int, found binary, half boolean, gaps boolean"

Blocks = Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[pa.Table, np.ndarray]]]  # rows -> blocks and their features


def _union(a: np.ndarray | None, b: np.ndarray | None, most: int) -> np.ndarray | None:
    """The values of both in order, or None for more than ``most``."""
    if a is None or b is None:
        return None
    both = np.unique(np.concatenate([a, b]))
    return both if len(both) <= most else None


@dataclass(frozen=True)
class Coding:
    """How rows travel: per feature its values in order and the type of its codes, or None and the type of its numbers."""

    values: list[np.ndarray | None]
    kinds: list[str]
    classes: int

    FIXED = (("h", "u8"), ("fold", "i4"), ("y", "i2"))

    @property
    def row_bytes(self) -> int:
        return sum(np.dtype(kind).itemsize for kind in (*self.kinds, *(kind for _, kind in self.FIXED)))

    @property
    def held_bytes(self) -> int:
        """Of one row where the features are ranked: those of many values take a code and, at worst, a value of their own."""
        wide = sum(values is None for values in self.values)
        return self.row_bytes + 12 * wide - sum(np.dtype(kind).itemsize for values, kind in zip(self.values, self.kinds) if values is None)

    def pack(self, h: np.ndarray, fold: np.ndarray, y: np.ndarray, x: np.ndarray) -> bytes:
        """Some rows, column after column.  A row without a fold belongs to none; one without a class is an error."""
        if y.dtype.kind == "f":
            raise ValueError("rows without a label")
        fold = np.nan_to_num(fold, nan=-1)
        columns = [a.astype(kind) for a, (_, kind) in zip((h, fold, y), self.FIXED)]
        for f, (values, kind) in enumerate(zip(self.values, self.kinds)):
            columns.append((x[:, f] if values is None else np.searchsorted(values, x[:, f]) * self.classes + y).astype(kind))
        return b"".join(c.tobytes() for c in columns)

    def unpack(self, records: Iterator[bytes], n: int) -> tuple[np.ndarray, np.ndarray, Coded]:
        """Hashes and folds of ``n`` rows, and their features."""
        kinds = [kind for _, kind in self.FIXED] + self.kinds
        columns, at = [np.empty(n, kind) for kind in kinds], 0
        for record in records:
            size, start = len(record) // self.row_bytes, 0
            for column in columns:
                column[at : at + size] = np.frombuffer(record, column.dtype, size, start)
                start += size * column.itemsize
            at += size
        if at != n:
            raise ValueError(f"{at} rows came, not {n}")
        (h, fold, y), codes, values = columns[:3], columns[3:], list(self.values)
        for f, found in enumerate(values):
            if found is None:
                codes[f], values[f] = ranked(codes[f], y, self.classes)
        return h, fold, Coded(codes, values, y, self.classes)


def ranked(x: np.ndarray, y: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of some numbers, and the numbers in order, each once."""
    order = np.argsort(x)
    inside = x[order]
    new = np.append(True, inside[1:] > inside[:-1])[: len(inside)]
    codes = np.empty(len(x), np.uint32 if len(x) * classes < 1 << 32 else np.int64)
    codes[order] = np.cumsum(new) - 1
    codes *= codes.dtype.type(classes)
    codes += y.astype(codes.dtype)
    return codes, inside[new].astype(np.float64)


def coding(rows: DataFrame, d: int, classes: int, blocks: Blocks) -> Coding | None:
    """The coding of rows (x, y, ...) by one pass over them; None if a number is missing."""
    most = max(1, min(MOST_VALUES, VALUES_BYTES // 8 // max(d, 1)))
    names = [c.split()[0] for c in FOUND.split(", ")]

    def record(found: dict[int, tuple]) -> pa.Table:
        columns = zip(*[(f, None if v is None else v.tobytes(), half, gaps) for f, (v, half, gaps) in found.items()])
        return pa.table([pa.array(c, kind) for c, kind in zip(columns, (pa.int32(), pa.binary(), pa.bool_(), pa.bool_()))], names)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple] = {}
        for _, x in blocks(batches):
            for f in range(d):
                column = np.ascontiguousarray(x[:, f])
                values, half, gaps = found.get(f, (column[:0], True, False))
                values = None if values is None else _union(values, np.unique(column), most)
                with np.errstate(over="ignore"):
                    half = half and bool((column.astype(np.float32) == column).all())
                found[f] = (values, half, gaps or bool(np.isnan(column).any()))
        if found:
            yield from record(found).to_batches()

    def merge(group: pa.Table) -> pa.Table:
        values: np.ndarray | None = np.empty(0)
        for part in group["found"].to_pylist():
            values = None if part is None else _union(values, np.frombuffer(part, np.float64), most)
            if values is None:
                break
        return record({group["f"][0].as_py(): (values, all(group["half"].to_pylist()), any(group["gaps"].to_pylist()))})

    found = rows.select("x").mapInArrow(look, FOUND).groupBy("f").applyInArrow(merge, FOUND).collect()
    if any(r["gaps"] for r in found):
        return None
    values, kinds = [None] * d, [""] * d
    for r in found:
        if r["found"] is None:
            kinds[r["f"]] = "f4" if r["half"] else "f8"
        else:
            values[r["f"]] = np.frombuffer(bytes(r["found"]), np.float64)
            kinds[r["f"]] = np.min_scalar_type(len(values[r["f"]]) * classes - 1).str[1:]
    return Coding(values, kinds, classes)


class Coded:
    """The features of some rows as codes: the rank of a value among its feature's values, times the classes, plus the row's class."""

    def __init__(self, codes: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, classes: int):
        self.codes, self.values, self.y, self.classes = codes, values, y, classes

    def sums(self, f: int, rows: np.ndarray, w: np.ndarray | None) -> np.ndarray:
        """The weight of some rows by value and class of a feature; every row weighs 1 without weights."""
        codes, bins = self.codes[f], len(self.values[f]) * self.classes
        step = max(CHUNK, 4 * bins)
        out = np.zeros(bins)
        for at in range(0, len(rows), step):
            out += np.bincount(codes.take(rows[at : at + step]), None if w is None else w[at : at + step], bins)
        return out.reshape(-1, self.classes)

    def ranks(self, f: int, rows: np.ndarray) -> np.ndarray:
        return (self.codes[f].take(rows) // self.codes[f].dtype.type(self.classes)).astype(np.int64)

    def above(self, f: int, cut: float, rows: np.ndarray) -> np.ndarray:
        """Which rows have a value above a cut."""
        first, codes = int(np.searchsorted(self.values[f], cut, side="right")) * self.classes, self.codes[f]
        if first > np.iinfo(codes.dtype).max:
            return np.zeros(len(rows), bool)
        return codes.take(rows) >= codes.dtype.type(first)
