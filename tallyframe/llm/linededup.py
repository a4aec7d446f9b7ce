"""Reversible line deduplication: sharded cuckoo filters over exact reference counts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import schema_with, stored
from .text import mixed, utf8

SLOTS = 4
FILTERS = "shard int, filter binary"


class Cuckoo:
    """A cuckoo filter of 64-bit keys: buckets of four 32-bit fingerprints, each key in one of two buckets.

    ``add`` and ``remove`` undo each other; a key that was added is always found, another one is found with a
    probability of about 8 / 2**32.  It grows to twice as many buckets by a rebuild, for which the caller gives the keys.
    """

    def __init__(self, n_buckets: int, table: np.ndarray | None = None):
        self.n = n_buckets  # a power of two
        self.table = np.zeros((n_buckets, SLOTS), np.uint32) if table is None else table

    @classmethod
    def of(cls, keys: np.ndarray) -> Cuckoo:
        """A filter of distinct keys, at most 84 % full."""
        n = 1 << max(0, int(np.ceil(np.log2(max(1, len(keys) / (SLOTS * 0.84))))))
        while True:
            made = cls(n)
            if all(made.add(k) for k in keys.tolist()):
                return made
            n *= 2

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h = mixed(keys.astype(np.uint64))
        print_ = (h >> np.uint64(32)).astype(np.uint32)
        print_[print_ == 0] = 1
        first = h & np.uint64(self.n - 1)
        return print_, first.astype(np.int64), (first ^ self.step(print_)).astype(np.int64)

    def step(self, print_: np.ndarray) -> np.ndarray:
        return mixed(print_.astype(np.uint64)) & np.uint64(self.n - 1)

    def add(self, key: int) -> bool:
        """False if there is no room (a rebuild with more buckets is needed)."""
        prints, first, second = self.places(np.array([key], np.uint64))
        p, at = prints[0], int(first[0])
        for b in (at, int(second[0])):
            free = np.flatnonzero(self.table[b] == 0)
            if len(free):
                self.table[b, free[0]] = p
                return True
        undo = []
        for turn in range(500):  # move a fingerprint on to its other bucket
            slot = (int(p) + turn) % SLOTS
            undo.append((at, slot, self.table[at, slot]))
            p, self.table[at, slot] = self.table[at, slot], p
            at ^= int(self.step(np.array([p], np.uint32))[0])
            free = np.flatnonzero(self.table[at] == 0)
            if len(free):
                self.table[at, free[0]] = p
                return True
        for b, slot, old in reversed(undo):
            self.table[b, slot] = old
        return False

    def remove(self, key: int) -> bool:
        """Take out one copy of a key that was added before."""
        prints, first, second = self.places(np.array([key], np.uint64))
        for b in (int(first[0]), int(second[0])):
            slots = np.flatnonzero(self.table[b] == prints[0])
            if len(slots):
                self.table[b, slots[0]] = 0
                return True
        return False

    def has(self, keys: np.ndarray) -> np.ndarray:
        prints, first, second = self.places(keys)
        return ((self.table[first] == prints[:, None]) | (self.table[second] == prints[:, None])).any(axis=1)

    def dump(self) -> bytes:
        return self.table.tobytes()

    @classmethod
    def load(cls, data: bytes) -> Cuckoo:
        table = np.frombuffer(data, np.uint32).reshape(-1, SLOTS).copy()
        return cls(len(table), table)


def digest(line: bytes) -> bytes | None:
    """A line's key as 16 bytes, None for a line that is empty when stripped and lower-cased."""
    key = line.strip().lower()
    return hashlib.blake2b(key, digest_size=16).digest() if key else None


def low64(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), np.uint64)[::2]


def line_keys(docs: DataFrame, text: str) -> DataFrame:
    """One row (key) per document and distinct line key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [k for data in utf8(batch.column(0)) for k in {digest(line) for line in (data or b"").split(b"\n")} if k]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary())], names=["key"])

    return docs.select(F.col(text).cast("string").alias(text)).mapInArrow(run, "key binary")


def shard_of(key, n_shards: int):
    return F.pmod(F.xxhash64(key), F.lit(n_shards)).cast("int")


def held_by(filters: dict[int, Cuckoo], keys: list[bytes], n_shards: int) -> np.ndarray:
    """Which keys the filters of their shards hold."""
    import xxhash  # on the executors too

    found = np.zeros(len(keys), bool)
    if len(keys) and filters:
        shard = np.array([xxhash.xxh64_intdigest(k, 42) for k in keys], np.uint64).view(np.int64) % n_shards
        low = low64(keys)
        for s, f in filters.items():
            mine = np.flatnonzero(shard == s)
            found[mine] = f.has(low[mine])
    return found


def built(frequent: DataFrame) -> DataFrame:
    """A new filter for every shard of (shard, key)."""

    def build(shard: tuple, table: pa.Table) -> pa.Table:
        keys = np.sort(low64(table.column("key").to_pylist()))
        return pa.table({"shard": pa.array([shard[0].as_py()], pa.int32()), "filter": pa.array([Cuckoo.of(keys).dump()], pa.binary())})

    return frequent.select("shard", "key").groupBy("shard").applyInArrow(build, FILTERS)


class LineIndex:
    """How many documents hold each line, and which lines are frequent.

    ``counts``: the exact table (shard, key, n), n = documents with the line.  ``filters``: (shard, filter), a cuckoo
    filter of the keys with n >= ``least``.  ``insert`` and ``delete`` return a new index: counts are added to or
    taken from the table, keys that cross the threshold are put into or taken out of their shard's filter.  Deleting
    the inserted documents brings back the same index.  All tables are stored in the shared folder.
    """

    def __init__(self, counts: DataFrame, filters: DataFrame, least: int, n_shards: int):
        self.counts, self.filters, self.least, self.n_shards = counts, filters, least, n_shards

    @classmethod
    def of(cls, docs: DataFrame, text: str = "text", least: int = 10, n_shards: int = 64) -> LineIndex:
        """The index of the documents; ``n_shards`` should grow with the data so that a shard's filter (4.8 bytes a
        frequent line) and its keys fit in a task."""
        held = line_keys(docs, text).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        counts = stored(held.select(shard_of(F.col("key"), n_shards).alias("shard"), "key", "n"))
        filters = stored(built(counts.where(F.col("n") >= least)))
        return cls(counts, filters, least, n_shards)

    def insert(self, docs: DataFrame, text: str = "text") -> LineIndex:
        return self._changed(docs, text, 1)

    def delete(self, docs: DataFrame, text: str = "text") -> LineIndex:
        """Documents that were never inserted are an error when a count would fall below 0."""
        return self._changed(docs, text, -1)

    def _changed(self, docs: DataFrame, text: str, sign: int) -> LineIndex:
        least = self.least
        change = line_keys(docs, text).groupBy("key").agg((F.count(F.lit(1)) * sign).alias("change"))
        both = self.counts.select("key", "n").join(change, "key", "full")
        merged = both.select(
            shard_of(F.col("key"), self.n_shards).alias("shard"),
            "key",
            F.coalesce("n", F.lit(0)).alias("old"),
            (F.coalesce("n", F.lit(0)) + F.coalesce("change", F.lit(0))).alias("n"),
        )
        safe = F.when(F.col("n") < 0, F.raise_error(F.lit("a deleted document was not in the index")).cast("long")).otherwise(F.col("n"))
        merged = stored(merged.withColumn("n", safe))
        crossed = merged.where((F.col("old") >= least) != (F.col("n") >= least)).select("shard", "key", (F.col("n") >= least).alias("add"))
        frequent = merged.where(F.col("n") >= least).select("shard", "key")

        def update(shard: tuple, old: pa.Table, changes: pa.Table) -> pa.Table:
            filters, keys, adds = old.column("filter").to_pylist(), low64(changes.column("key").to_pylist()), changes.column("add").to_pylist()
            order = np.argsort(keys, kind="stable").tolist()
            if not filters:
                made = Cuckoo.of(keys[order])
            else:
                made = Cuckoo.load(filters[0])
                for i in order:
                    if not adds[i]:
                        made.remove(int(keys[i]))
                for i in order:
                    if adds[i] and not made.add(int(keys[i])):
                        return pa.table({"shard": pa.array([shard[0].as_py()], pa.int32()), "filter": pa.array([None], pa.binary())})
            return pa.table({"shard": pa.array([shard[0].as_py()], pa.int32()), "filter": pa.array([made.dump()], pa.binary())})

        updated = stored(self.filters.groupBy("shard").cogroup(crossed.groupBy("shard")).applyInArrow(update, FILTERS))
        full = updated.where(F.col("filter").isNull()).select("shard")
        grown = built(frequent.join(full, "shard", "left_semi"))  # shards without room
        filters = stored(updated.where(F.col("filter").isNotNull()).unionByName(grown))
        return LineIndex(merged.where(F.col("n") > 0).select("shard", "key", "n"), filters, least, self.n_shards)

    def drop_lines(self, docs: DataFrame, text: str = "text", max_bytes: int = 64 << 20) -> DataFrame:
        """Take all frequent lines out of the texts; the other lines stay, joined by \\n.

        Adds n_lines and n_dropped, replaces the text (a NULL text is one empty line and becomes an empty text).
        The filters tell lines that are surely not frequent.  What they take for frequent is looked up in the exact counts:
        the lines of these documents that the filters hold, each key once, less the frequent ones, are sent along as wrongly
        found, whether they were ever counted or not.  Filters and those keys are broadcast up to ``max_bytes``; beyond,
        documents and frequent keys meet in a join on the key.  Both ways give the same rows.
        """
        own = docs.drop("n_lines", "n_dropped")
        held = self.filters.agg(F.coalesce(F.sum(F.length("filter")), F.lit(0))).first()[0]
        if held <= max_bytes:
            shards = dict(self.filters.collect())
            wrong = self._wrongly_found(own, text, shards)
            if 64 * wrong.count() <= max_bytes:
                return self._by_filter(own, text, shards, {bytes(r[0]) for r in wrong.collect()})
        return self._by_join(own, text)

    def _wrongly_found(self, docs: DataFrame, text: str, shards: dict[int, bytes]) -> DataFrame:
        """Keys of the documents' lines that the filters hold though they are not frequent."""
        shared, n_shards = docs.sparkSession.sparkContext.broadcast(shards), self.n_shards

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            filters = {s: Cuckoo.load(f) for s, f in shared.value.items()}
            for batch in batches:
                keys = list({k for data in utf8(batch.column(0)) for line in (data or b"").split(b"\n") if (k := digest(line))})
                found = held_by(filters, keys, n_shards)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()).filter(pa.array(found))], names=["key"])

        hits = docs.select(F.col(text).cast("string").alias(text)).mapInArrow(run, "key binary").distinct()
        return stored(hits.join(self.counts.where(F.col("n") >= self.least).select("key"), "key", "left_anti"))

    def _by_filter(self, docs: DataFrame, text: str, shards: dict[int, bytes], wrong: set[bytes]) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast((shards, wrong))
        n_shards, names = self.n_shards, docs.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            filters, wrong = {s: Cuckoo.load(f) for s, f in shared.value[0].items()}, shared.value[1]
            for batch in batches:
                lines = [(data or b"").split(b"\n") for data in utf8(batch.column(names.index(text)))]
                keys = [digest(line) for doc in lines for line in doc]
                real = [i for i, k in enumerate(keys) if k]
                drop = np.zeros(len(keys), bool)
                if real:
                    drop[real] = held_by(filters, [keys[i] for i in real], n_shards)
                    if wrong:
                        for i in np.flatnonzero(drop).tolist():
                            drop[i] = keys[i] not in wrong
                yield cut(batch, names, text, lines, drop)

        return docs.mapInArrow(run, schema_with(docs, "n_lines long, n_dropped long"))

    def _by_join(self, docs: DataFrame, text: str) -> DataFrame:
        whole = F.coalesce(F.col(text), F.lit(""))
        own = docs.withColumn("__digest", F.sha2(whole, 256))

        def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [(d, k) for d, data in zip(batch.column(0).to_pylist(), utf8(batch.column(1))) for k in {digest(x) for x in (data or b"").split(b"\n")} if k]
                a, b = zip(*rows) if rows else ([], [])
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.binary())], names=["__digest", "key"])

        pairs = own.select("__digest", text).mapInArrow(explode, "__digest string, key binary")
        frequent = self.counts.where(F.col("n") >= self.least).select("key")
        dropped = pairs.join(frequent, "key").groupBy("__digest").agg(F.collect_set("key").alias("__keys"))
        joined = own.join(dropped, "__digest", "left").select(*docs.columns, "__keys")
        names = joined.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lines = [(data or b"").split(b"\n") for data in utf8(batch.column(names.index(text)))]
                gone = [set(k or ()) for k in batch.column(names.index("__keys")).to_pylist()]
                drop = np.array([digest(line) in g for doc, g in zip(lines, gone) for line in doc], bool)
                yield cut(batch.drop_columns(["__keys"]), names[:-1], text, lines, drop)

        return joined.mapInArrow(run, schema_with(docs, "n_lines long, n_dropped long"))


def cut(batch: pa.RecordBatch, names: list[str], text: str, lines: list[list[bytes]], drop: np.ndarray) -> pa.RecordBatch:
    kept, n_lines, n_dropped, at = [], [], [], 0
    for doc in lines:
        gone = drop[at : at + len(doc)]
        at += len(doc)
        n_lines.append(len(doc))
        n_dropped.append(int(gone.sum()))
        kept.append(b"\n".join(line for line, g in zip(doc, gone) if not g))
    columns = dict(zip(names, batch.columns)) | {text: pa.array(kept, pa.binary()).cast(pa.string())}
    columns |= {"n_lines": pa.array(n_lines, pa.int64()), "n_dropped": pa.array(n_dropped, pa.int64())}
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
