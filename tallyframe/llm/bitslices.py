"""Exact top-k inner products over a bit-sliced index.

The index holds blocks of rows.  In a block every attribute is a set of slices: bitmaps over the rows, one for each
bit of the attribute's value above the block's least.  A query adds the slices of all attributes, shifted by the bits
of its own weights, with bitmap arithmetic alone (carry-save adders), which gives the slices of the scores of all rows
at once.  The best rows are picked from the most significant slice downward; rows still tied after the last slice are
equal, and the order of ids decides between them (O'Neil & Quass 1997; Rinfret, O'Neil & O'Neil 2001).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .store import stored

WIDEST = float(1 << 58)  # values beyond count as this much, so that sums of 1000 products stay below 38 digits


def quantised(vector: str, scale: float) -> Column:
    """floor(scale * x) of every component as long; NULL for a vector that is or holds NULL, NaN or infinity."""
    scaled = F.transform(F.col(vector), lambda x: F.lit(float(scale)) * x.cast("double"))
    finite = F.forall(scaled, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.when(finite, F.transform(scaled, lambda x: F.floor(F.greatest(F.least(x, F.lit(WIDEST)), F.lit(-WIDEST)))))


class Block:
    """Slices of a block of rows.

    ``slices`` has one bitmap a line: bit ``bit[i]`` of attribute ``attribute[i]``, above that attribute's ``least``.
    Rows stand in the order of their keys, so among equal scores the first wins.
    """

    def __init__(self, n_rows: int, slices: np.ndarray, widths: list[int], least: list[int]):
        self.n_rows, self.slices, self.least = n_rows, slices, least
        self.width = np.array(widths, int)
        self.attribute = np.repeat(np.arange(len(widths)), self.width)
        self.bit = np.concatenate([np.arange(w) for w in widths] or [np.empty(0, int)]).astype(int)
        self.all_rows = bitmap(np.ones(n_rows, bool))

    @classmethod
    def of(cls, values: np.ndarray) -> Block:
        least = values.min(axis=0)
        above = values - least
        widths = [int(m).bit_length() for m in above.max(axis=0)]
        slices = [bitmap((above[:, a] >> b) & 1) for a, w in enumerate(widths) for b in range(w)]
        return cls(len(values), np.stack(slices) if slices else np.empty((0, words(len(values))), np.uint64), widths, [int(v) for v in least])

    def scores(self, weights: list[int]) -> tuple[list[np.ndarray], int]:
        """Slices of the sum of weight * attribute over all attributes, least significant first, and what to add.

        A negative weight takes the complement of the attribute's slices, so that nothing is ever subtracted.
        """
        weights = weights[: len(self.least)] + [0] * (len(self.least) - len(weights))
        size = np.array([abs(w) for w in weights], np.uint64)[self.attribute]
        flip = np.where(np.array(weights)[self.attribute] < 0, ~np.uint64(0), np.uint64(0))
        offset = sum(w * m for w, m in zip(weights, self.least))
        offset -= sum(-w * ((1 << int(n)) - 1) for w, n in zip(weights, self.width) if w < 0)
        at: dict[int, list[np.ndarray]] = {}
        for b in range(int(size.max()).bit_length() if len(size) else 0):
            set_bits = np.flatnonzero((size >> np.uint64(b)) & np.uint64(1))
            for place in np.unique(self.bit[set_bits]).tolist():
                rows = set_bits[self.bit[set_bits] == place]
                at.setdefault(place + b, []).append(self.slices[rows] ^ flip[rows, None])
        out, place = [], 0
        while at and place <= max(at):
            total, carries = add_bitmaps(np.concatenate(at.pop(place))) if place in at else (np.zeros_like(self.all_rows), [])
            out.append(total)
            if carries:
                at.setdefault(place + 1, []).extend(carries)
            place += 1
        return out, offset

    def top(self, weights: list[int], k: int, own: int | None = None, floor: int | None = None) -> list[tuple[int, int]]:
        """(position, score) of the k best rows but ``own``, best first; rows below ``floor`` are left out."""
        sums, offset = self.scores(weights)
        open_rows = self.all_rows.copy()
        if own is not None:
            open_rows[own >> 6] &= ~(np.uint64(1) << np.uint64(own & 63))
        if floor is not None:
            open_rows = at_least(sums, floor - offset, open_rows)
        sure = np.zeros_like(open_rows)
        n_sure = 0
        for total in reversed(sums):  # from the most significant slice downward
            with_bit = open_rows & total
            n = n_sure + int(np.bitwise_count(with_bit).sum())
            if n > k:
                open_rows = with_bit
            else:
                sure, n_sure, open_rows = sure | with_bit, n, open_rows & ~total
                if n == k:
                    break
        best = positions(sure)
        if n_sure < k:  # what is open has one score
            best = np.concatenate([best, positions(open_rows)[: k - n_sure]])
        scores = [offset] * len(best)
        for i, total in enumerate(sums):
            for j in np.flatnonzero((total[best >> 6] >> (best & 63).astype(np.uint64)) & np.uint64(1)).tolist():
                scores[j] += 1 << i
        return sorted(zip(best.tolist(), scores), key=lambda r: (-r[1], r[0]))


def words(n: int) -> int:
    return -(-n // 64)


def bitmap(bits: np.ndarray) -> np.ndarray:
    """Bits as 64-bit words, padded with zeros."""
    padded = np.zeros(words(len(bits)) * 64, np.uint8)
    padded[: len(bits)] = bits
    return np.packbits(padded, bitorder="little").view(np.uint64)


def positions(rows: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(rows.view(np.uint8), bitorder="little"))


def add_bitmaps(rows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Bitmaps of one place value: the slice of their sum at that place, and the carries into the next."""
    carries = []
    while len(rows) > 1:
        third = len(rows) // 3
        if third:
            a, b, c = rows[:third], rows[third : 2 * third], rows[2 * third : 3 * third]
            either = a ^ b
            carries.append((a & b) | (either & c))
            rows = np.concatenate([either ^ c, rows[3 * third :]])
        else:
            carries.append(rows[:1] & rows[1:])
            rows = rows[:1] ^ rows[1:]
    return rows[0], carries


def at_least(sums: list[np.ndarray], number: int, rows: np.ndarray) -> np.ndarray:
    """Those of ``rows`` whose sum is ``number`` or more."""
    if number <= 0:
        return rows
    if number >> len(sums):
        return np.zeros_like(rows)
    more, equal = np.zeros_like(rows), rows
    for i in reversed(range(len(sums))):
        if number >> i & 1:
            equal = equal & sums[i]
        else:
            more, equal = more | (equal & sums[i]), equal & ~sums[i]
    return more | equal


INDEX = "block int, ids array<long>, n_null int, dims int, widths array<int>, least array<long>, slices binary"


def build_index(df: DataFrame, key: str, vector: str, block_rows: int = 16_384) -> tuple[DataFrame, int]:
    """The index of all rows whose ``vector`` (array of long) is not NULL, one row per block, and the number of blocks.

    Rows are dealt to blocks by a hash of key, vector and place in the stored table, so that equal rows spread too.
    Rows of a block stand in the order of their keys, the ``n_null`` without one last (0 in ``ids``).  Shorter vectors
    end in zeros.
    """
    slim = df.select(F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("id"), F.col(key).isNull().alias("no_id"), F.col(vector).alias("v"))
    rows = stored(slim.where("v is not null"))
    n_blocks = max(1, -(-rows.count() // block_rows))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "v", F.monotonically_increasing_id()), F.lit(n_blocks)).cast("int"))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["no_id", "id"], kind="stable")
        dims = int(group["v"].map(len).max())
        values = np.zeros((len(group), dims), np.int64)
        for i, v in enumerate(group["v"]):
            values[i, : len(v)] = v
        made = Block.of(values)
        row = (int(group["block"].iloc[0]), group["id"].tolist(), int(group["no_id"].sum()), dims, made.width.tolist(), made.least, made.slices.tobytes())
        return pd.DataFrame([row], columns=["block", "ids", "n_null", "dims", "widths", "least", "slices"])

    return stored(dealt.groupBy("block").applyInPandas(build, INDEX)), n_blocks


def read_block(row: dict) -> Block:
    slices = np.frombuffer(row["slices"], np.uint64).reshape(int(sum(row["widths"])), words(len(row["ids"])))
    return Block(len(row["ids"]), slices, [int(w) for w in row["widths"]], [int(v) for v in row["least"]])


def values_of(block: Block) -> np.ndarray:
    """The block's rows back from their slices."""
    out = np.tile(np.array(block.least, np.int64), (block.n_rows, 1))
    for slice_, a, b in zip(block.slices, block.attribute, block.bit):
        out[:, a] += np.unpackbits(slice_.view(np.uint8), bitorder="little")[: len(out)].astype(np.int64) << b
    return out


def top_products(
    df: DataFrame, key: str, vector: str, k: int = 20, every: int = 20, scale: float = 64.0,
    block_rows: int = 16_384, query_rows: int = 1_024, chunk_blocks: int = 16,
) -> DataFrame:
    """For every row whose key is divisible by ``every``: the k other rows of largest inner product.

    Components become floor(scale * x), beyond 2**58 that number; vectors that are or hold NULL, NaN or infinity take no
    part, and shorter vectors end in zeros.  Returns query_id, rank (from 1), the key and score (long; ranks follow the exact
    score, which comes back as the nearest long).  Equal scores go by key, NULL last.  Every row is a candidate and, if its
    key says so, a query of its own, also where keys repeat; a NULL key asks nothing.  An empty table gives no rows.

    Query and index blocks meet by the number of their pair.  A task holds ``query_rows`` queries and up to
    ``chunk_blocks`` index blocks one after the other; the k-th best score so far keeps rows of later blocks out.
    """
    whole = df.select(F.col(key).cast("long").alias(key), quantised(vector, scale).alias("__v"))
    index, n_blocks = build_index(whole, key, "__v", block_rows)
    per_chunk = max(1, min(chunk_blocks, n_blocks // 64))
    n_chunks = -(-n_blocks // per_chunk)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = [i for i, v in enumerate(row["ids"][: len(row["ids"]) - row["n_null"]]) if v % every == 0]
                values = values_of(read_block(row))[own]
                for start in range(0, len(own), query_rows):
                    part = own[start : start + query_rows]
                    yield pa.RecordBatch.from_pydict({
                        "block": pa.array([row["block"]] * len(part), pa.int32()), "at": pa.array(part, pa.int32()),
                        "query_id": pa.array([row["ids"][i] for i in part], pa.int64()),
                        "w": pa.array(values[start : start + query_rows].tolist(), pa.list_(pa.int64())),
                    })

    queries = stored(index.mapInArrow(pick, "block int, at int, query_id long, w array<long>"))
    n_groups = max(1, -(-queries.count() // query_rows))
    asked = queries.withColumn("group", F.pmod(F.xxhash64("block", "at"), F.lit(n_groups)).cast("int"))
    left = asked.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))))
    right = index.withColumn("chunk", F.floor(F.col("block") / per_chunk).cast("int")).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))))

    def search(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        best: list[list[tuple]] = [[] for _ in range(len(asked))]
        weights = [[int(v) for v in w] for w in asked["w"]]
        for row in held.sort_values("block").to_dict("records"):
            block, ids = read_block(row), [int(i) for i in row["ids"]]
            ids[len(ids) - row["n_null"] :] = [None] * row["n_null"]
            for i, (home, at) in enumerate(zip(asked["block"], asked["at"])):
                floor = best[i][-1][0] if len(best[i]) == k else None
                found = block.top(weights[i], k, at if home == row["block"] else None, floor)
                merged = best[i] + [(score, ids[p]) for p, score in found]
                best[i] = sorted(merged, key=lambda r: (-r[0], r[1] is None, r[1] or 0))[:k]
        rows = [(b, a, q, i, str(s)) for (b, a, q), found in zip(zip(asked["block"], asked["at"], asked["query_id"]), best) for s, i in found]
        return pd.DataFrame(rows, columns=["block", "at", "query_id", "id", "exact"]).astype({"id": "Int64"})

    pair = ["group", "chunk"]
    found = left.groupBy(*pair).cogroup(right.groupBy(*pair)).applyInPandas(search, "block int, at int, query_id long, id long, exact string")
    exact = F.col("exact").cast("decimal(38,0)")
    order = Window.partitionBy("block", "at").orderBy(exact.desc(), F.col("id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
    limits = [F.lit(v).cast("decimal(38,0)") for v in (-(1 << 63), (1 << 63) - 1)]
    score = F.greatest(F.least(exact, limits[1]), limits[0]).cast(LongType())
    return ranked.select("query_id", "rank", F.col("id").alias(key), score.alias("score"))
