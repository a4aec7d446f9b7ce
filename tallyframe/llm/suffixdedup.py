"""Exact substring deduplication: every byte inside a repeated string of some length is found, and cut out.

Strings meet in shards by an anchor inside them, and each shard has a suffix array of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import schema_with, stored
from .suffixes import repeated_windows
from .text import BASE, mixed, powers, utf8

BLOCK = 1 << 19
PLACE = np.uint64((1 << 20) - 1)
SHARD_REGIONS = 2000  # of a shard; about half a megabyte at 200 bytes
HOT_REGIONS = 5000  # of one anchor, above which its windows are compared by digest

ANCHORS = "key long, h long, d long, t binary, at long, size int, n int"


class Anchors:
    """Anchors of a text: in each window of ``width`` bytes the least hash of ``gram`` bytes, the leftmost of equals.

    Equal windows have equal anchors at equal places.  Windows in a row with one anchor make a region; every window
    is in one region.
    """

    def __init__(self, width: int, gram: int):
        self.width, self.gram = width, gram
        size = BLOCK + width + 1
        self.up, self.down = powers(BASE, size), powers(pow(BASE, -1, 1 << 64), size)

    def __call__(self, data: bytes) -> tuple[np.ndarray, ...]:
        """Per region: hash of the anchor, digest of the region's bytes, where it begins, its bytes."""
        n_windows = len(data) - self.width + 1
        parts = [self._block(data[a : a + BLOCK + self.width - 1], a) for a in range(0, n_windows, BLOCK)]
        return tuple(np.concatenate(x) for x in zip(*parts)) if parts else (np.empty(0, np.uint64),) * 2 + (np.empty(0, np.int64),) * 2

    def sums(self, data: bytes) -> np.ndarray:
        a = np.frombuffer(data, np.uint8).astype(np.uint64)
        total = np.zeros(len(a) + 1, np.uint64)
        np.cumsum((a + np.uint64(1)) * self.up[: len(a)], out=total[1:])
        return total

    def _block(self, data: bytes, offset: int) -> tuple[np.ndarray, ...]:
        total, n = self.sums(data), len(data)
        grams = mixed((total[self.gram :] - total[: -self.gram]) * self.down[: n - self.gram + 1])
        least = (grams & ~PLACE) | np.arange(len(grams), dtype=np.uint64)
        n_windows, span, have = n - self.width + 1, self.width - self.gram + 1, 1
        while have * 2 <= span:
            least = np.minimum(least[:-have], least[have:])
            have *= 2
        if have < span:
            least = np.minimum(least[: n_windows], least[span - have : span - have + n_windows])
        place = (least & PLACE).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        size = np.diff(np.append(first, n_windows)) + self.width - 1
        digest = mixed((total[first + size] - total[first]) * self.down[first] + size.astype(np.uint64))
        return grams[place[first]], digest, first + offset, size


def _regions(docs: DataFrame, width: int, gram: int) -> DataFrame:
    """Regions (h, d, t, at, size) of each text t, with a key to meet by.

    Of the regions with one anchor in a batch one has n = 1 (alone) or 2 and meets others of its anchor by it; the rest
    (n = 0) are known to be shared already.  Of equal texts in a partition two are enough.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, seen = Anchors(width, gram), {}
        for batch in batches:
            found, digests = [], []
            for data in utf8(batch.column(0)):
                if data is None or len(data) < width:
                    continue
                t = hashlib.blake2b(data, digest_size=16).digest()
                seen[t] = seen.get(t, 0) + 1
                if seen[t] <= 2:
                    found.append(anchors(data))
                    digests.append((t, len(found[-1][0])))
            if not found:
                continue
            h, d, at, size = (np.concatenate(x) for x in zip(*found))
            _, first, which, count = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
            n = np.zeros(len(h), np.int32)
            n[first] = 1
            n[first[count > 1]] = 2
            key = np.where(n > 0, h, mixed(d + np.arange(len(h), dtype=np.uint64)))
            t = pa.array([x for x, m in digests for _ in range(m)], pa.binary())
            columns = [pa.array(key.view(np.int64)), pa.array(h.view(np.int64)), pa.array(d.view(np.int64)), t, pa.array(at), pa.array(size.astype(np.int32)), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "h", "d", "t", "at", "size", "n"])

    return docs.mapInArrow(run, ANCHORS)


def _texts(docs: DataFrame) -> DataFrame:
    """(t, text) of the texts, of equal ones in a partition once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            made = [hashlib.blake2b(x or b"", digest_size=16).digest() for x in utf8(batch.column(0))]
            new = [not (t in seen or seen.add(t)) for t in made]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary()), batch.column(0)], names=["t", "text"]).filter(pa.array(new, pa.bool_()))

    return docs.mapInArrow(run, "t binary, text string")


def _bytes(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h, d, t, at, bytes) of the wanted regions (h, d, t, at, size)."""
    lists = wanted.groupBy("t").agg(F.collect_list(F.struct("h", "d", "at", "size")).alias("r"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(r["h"], r["d"], t, r["at"], data[r["at"] : r["at"] + r["size"]]) for t, data, own in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), batch.column(2).to_pylist()) for r in own]
            columns = list(zip(*rows)) if rows else [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["h", "d", "t", "at", "bytes"])

    return _texts(docs).join(lists, "t").select("t", "text", "r").mapInArrow(run, "h long, d long, t binary, at long, bytes binary")


def _by_suffixes(regions: DataFrame, width: int) -> DataFrame:
    """(t, start, stop) of the repeated windows of each region, a suffix array per shard of anchors."""
    shards = F.ceil(F.count(F.lit(1)) / SHARD_REGIONS)
    n_shards = max(1, regions.agg(shards).first()[0] or 1)

    def run(shard: tuple, table: pa.Table) -> pa.Table:
        rows = {(h, d): (t, at, x) for h, d, t, at, x in zip(*(table.column(c).to_pylist() for c in ("h", "d", "t", "at", "bytes")))}
        t_out, start, stop = [], [], []
        order = sorted(rows)
        for key, places in zip(order, repeated_windows([rows[k][2] for k in order], width)):
            t, at, _ = rows[key]
            for run_ in np.split(places, np.flatnonzero(np.diff(places) > 1) + 1):
                if len(run_):
                    t_out.append(t)
                    start.append(at + int(run_[0]))
                    stop.append(at + int(run_[-1]) + width)
        return pa.table({"t": pa.array(t_out, pa.binary()), "start": pa.array(start, pa.int64()), "stop": pa.array(stop, pa.int64())})

    return regions.withColumn("shard", F.pmod(F.xxhash64("h"), F.lit(n_shards))).groupBy("shard").applyInArrow(run, "t binary, start long, stop long")


def _by_windows(regions: DataFrame, width: int, gram: int) -> DataFrame:
    """The same for anchors with very many regions: each window is met by its digest, so no task holds an anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(width, gram)
        for batch in batches:
            for h, t, at, data in zip(*(batch.column(c).to_pylist() for c in (0, 2, 3, 4))):
                total = anchors.sums(data)
                w = mixed((total[width:] - total[:-width]) * anchors.down[: len(data) - width + 1]).view(np.int64)
                n = len(w)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, h)), pa.array(w), pa.array([t] * n, pa.binary()), pa.array(at + np.arange(n))], names=["h", "w", "t", "start"])

    windows = regions.mapInArrow(run, "h long, w long, t binary, start long").distinct()
    twice = windows.groupBy("h", "w").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h", "w")
    return windows.join(twice, ["h", "w"]).select("t", "start", (F.col("start") + width).alias("stop"))


def repeated_spans(docs: DataFrame, text: str = "text", width: int = 200, gram: int = 48, hot_regions: int = HOT_REGIONS) -> DataFrame:
    """(t, spans) of every distinct text with a repeated string of ``width`` bytes; t is the text's BLAKE2b digest of
    16 bytes, spans the covered (start, stop), not yet merged.

    Regions whose anchor occurs once hold nothing that is repeated.  A region that occurs twice, byte for byte, is
    repeated as a whole.  Where an anchor has several different regions, one of them met once, these meet in a shard, whose suffixes are
    sorted by induction; a window is repeated when it is a common prefix of neighbours.
    """
    own = docs.select(F.col(text).cast("string").alias("text"))
    met = Window.partitionBy("key")
    rows = _regions(own, width, gram).withColumn("met", F.sum(F.signum("n").cast("int")).over(met))
    shared = stored(rows.where((F.col("n") != 1) | (F.col("met") > 1)).select("h", "d", "t", "at", "size"))
    kinds = stored(shared.groupBy("h", "d").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("t", "at", "size")).alias("one")))
    twice = kinds.where("n > 1").select("h", "d")
    whole = shared.join(twice, ["h", "d"]).select("t", F.col("at").alias("start"), (F.col("at") + F.col("size")).alias("stop"))
    several = kinds.groupBy("h").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least")).where("kinds > 1 and least = 1").select("h", "kinds")
    wanted = kinds.join(several, "h").select("h", "d", "one.t", "one.at", "one.size", "kinds")
    regions = stored(_bytes(own, wanted.drop("kinds")).join(several, "h"))
    common = regions.where(F.col("kinds") <= hot_regions).drop("kinds")
    hot = regions.where(F.col("kinds") > hot_regions).drop("kinds")
    spans = whole.unionByName(_by_suffixes(common, width)).unionByName(_by_windows(hot, width, gram))
    return spans.groupBy("t").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))


def remove_repeats(docs: DataFrame, text: str = "text", width: int = 200, gram: int = 48, hot_regions: int = HOT_REGIONS) -> DataFrame:
    """Cut out of every whole text, as UTF-8 bytes, all that a string of ``width`` bytes covers that also begins
    anywhere else, in the same text or another; strings don't run over the end of a text, and are judged on the input.

    Adds kept (the remaining bytes; a cut may fall inside a character), n_bytes, n_removed, n_spans (maximal runs) and
    spans.  NULL texts are empty; texts shorter than ``width`` stay; all rows of one text are cut alike; columns of
    the added names are replaced.
    """
    if not 0 < gram <= width < BLOCK:
        raise ValueError(f"width must be below {BLOCK} and not below gram")
    added = "kept binary, n_bytes long, n_removed long, n_spans long, spans array<struct<start:long,stop:long>>"
    own = docs.drop("kept", "n_bytes", "n_removed", "n_spans", "spans")
    found = repeated_spans(own, text, width, gram, hot_regions)
    names = own.columns

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [hashlib.blake2b(x or b"", digest_size=16).digest() for x in utf8(batch.column(names.index(text)))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())], names=[*names, "__t"])

    marked = own.mapInArrow(digest, schema_with(own, "__t binary"))
    joined = marked.join(found.withColumnsRenamed({"t": "__t", "spans": "__spans"}), "__t", "left").select(*names, "__spans")
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for data, spans in zip(utf8(batch.column(names.index(text))), batch.column(len(names)).to_pylist()):
                runs: list[list[int]] = []
                for a, b in sorted((s["start"], s["stop"]) for s in spans or ()):
                    if runs and a <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], b)
                    else:
                        runs.append([a, b])
                data = data or b""
                kept = b"".join(data[a:b] for a, b in zip([0, *(r[1] for r in runs)], [*(r[0] for r in runs), len(data)]))
                out.append((kept, len(data), len(data) - len(kept), len(runs), [{"start": a, "stop": b} for a, b in runs]))
            columns = list(zip(*out)) if out else [[]] * 5
            made = [pa.array(c, k) for c, k in zip(columns, (pa.binary(), pa.int64(), pa.int64(), pa.int64(), span))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], names=[*names, "kept", "n_bytes", "n_removed", "n_spans", "spans"])

    return joined.mapInArrow(cut, schema_with(own, added))
