"""Benchmark decontamination: find word windows of benchmark items in documents, verify them, cut them out."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import schema_with, stored
from .text import WordHasher, by_letters, slices, utf8, windows

NOT_WORD = bytes(32 if not w else i for i, w in enumerate(by_letters()))
HITS = "array<struct<at:int,n:int,item:string>>"


def normal_words(data: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words of digits, letters and anything beyond ASCII."""
    return data.lower().translate(NOT_WORD).split()


def benchmark_windows(benchmark: DataFrame, text: str, item: str, n: int) -> DataFrame:
    """Distinct (hash, length, words joined by spaces, item as text) of every window of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(by_letters())
        for batch in batches:
            rows: list[tuple] = []
            for name, data in zip(batch.column(1).to_pylist(), utf8(batch.column(0))):
                words = normal_words(data or b"")
                m = min(n, len(words))
                for i, h in enumerate(windows(hasher((data or b"").lower()), n).view(np.int64).tolist()):
                    rows.append((h, m, b" ".join(words[i : i + m]).decode(), name))
            columns = list(zip(*rows)) if rows else [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.string(), pa.string()))], names=["hash", "length", "words", "item"])

    return benchmark.select(F.col(text).cast("string"), F.col(item).cast("string")).mapInArrow(run, "hash long, length int, words string, item string").distinct()


Find = Callable[[bytes | None], list[tuple[int, int, str | None]]]


def by_length(block: list) -> dict[int, dict[int, dict[bytes, list]]]:
    """Items by length, hash and words of a block of windows."""
    out: dict[int, dict[int, dict[bytes, list]]] = {}
    for h, length, words, item in block:
        out.setdefault(length, {}).setdefault(h, {}).setdefault(words.encode(), []).append(item)
    return out


def finder(lengths: dict[int, dict[int, dict[bytes, list]]]) -> Find:
    """What finds the verified occurrences (first word, number of words, item) of a block of windows in a text."""
    hasher = WordHasher(by_letters())
    maybe = {}  # of each length: which values the low 20 bits of its hashes take
    for length, table in lengths.items():
        maybe[length] = np.zeros(1 << 20, bool)
        maybe[length][np.fromiter(table, np.int64, len(table)) & 0xFFFFF] = True

    def find(data: bytes | None) -> list[tuple[int, int, str | None]]:
        hits, words, hashes = [], None, hasher((data or b"").lower())
        for length, table in lengths.items():
            if len(hashes) < length:
                continue
            runs = windows(hashes, length).view(np.int64)
            at = np.flatnonzero(maybe[length][runs & 0xFFFFF])
            for i, h in zip(at.tolist(), runs[at].tolist()):
                if h in table:
                    words = words or normal_words(data)
                    for item in table[h].get(b" ".join(words[i : i + length]), ()):
                        hits.append((i, length, item))
        return hits

    return find


def find_hits(texts: DataFrame, text: str, block: list) -> DataFrame:
    """Texts with a hit, and ``__hits``: their verified occurrences of a broadcast block of windows."""
    shared = texts.sparkSession.sparkContext.broadcast(by_length(block))
    hit_type = pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32()), ("item", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = finder(shared.value)
        for batch in slices(batches):
            found = [find(data) for data in utf8(batch.column(0))]
            hit = batch.filter(pa.array([bool(hits) for hits in found], pa.bool_()))
            rows = [[{"at": i, "n": m, "item": item} for i, m, item in hits] for hits in found if hits]
            yield pa.RecordBatch.from_arrays([hit.column(0), pa.array(rows, hit_type)], names=[text, "__hits"])

    own = texts.select(F.col(text).cast("string").alias(text))
    return own.mapInArrow(run, schema_with(own, f"__hits {HITS}"))


def with_hits(docs: DataFrame, found: DataFrame, text: str, blocks: int) -> DataFrame:
    """``docs`` with ``__hits``, of a benchmark too large to be broadcast at once: it goes in blocks, one pass over the
    documents each, whose hits are joined back by text."""
    number = F.pmod(F.col("hash"), F.lit(blocks))
    digest = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    parts = [find_hits(docs.select(text), text, found.where(number == b).collect()) for b in range(blocks)]
    hits = parts[0]
    for part in parts[1:]:
        hits = hits.unionByName(part)
    hits = hits.select(digest.alias("__digest"), F.explode("__hits").alias("hit")).groupBy("__digest").agg(F.collect_set("hit").alias("__hits"))
    joined = docs.withColumn("__digest", digest).join(hits, "__digest", "left")
    return joined.select(*docs.columns, F.coalesce(F.col("__hits"), F.expr(f"cast(array() as {HITS})")).alias("__hits"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", n: int = 10, remove: str | None = "spans", max_windows: int = 500_000) -> DataFrame:
    """Find benchmark passages of ``n`` words (an item of fewer words, but not none, is one passage) in whole texts.

    Words are runs of digits, letters and characters beyond ASCII, A-Z lower-cased.  Window hashes of the benchmark
    are broadcast, up to ``max_windows`` at once, hits are verified word by word in the pass that cuts them out.  ``remove``: "spans" cuts the hit words and what stands between
    them (text between two runs becomes one space), "documents" drops hit documents, None only reports.

    Adds n_words, n_hit (words in any hit window), spans (array of first word and number of words of each maximal
    run), items (ids as text, sorted, without NULL).  NULL texts have no words and stay NULL; items without words
    match nothing, equal items are each reported; columns of the added names are replaced.
    """
    if remove not in ("spans", "documents", None):
        raise ValueError(f"unknown way to remove: {remove}")
    added = ["n_words", "n_hit", "spans", "items"]
    own = docs.drop(*added)
    found = stored(benchmark_windows(benchmark, text, item, n))
    blocks = max(1, -(-found.count() // max_windows))
    shared = own.sparkSession.sparkContext.broadcast(by_length(found.collect())) if blocks == 1 else None
    hit = own if blocks == 1 else with_hits(own, found, text, blocks)
    names = hit.columns
    span = pa.list_(pa.struct([("at", pa.int64()), ("n", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        in_word, find = by_letters(), finder(shared.value) if shared else None
        for batch in slices(batches):
            texts = utf8(batch.column(names.index(text)))
            if find:
                found = [find(data) for data in texts]
            else:
                found = [[(h["at"], h["n"], h["item"]) for h in hits] for hits in batch.column(names.index("__hits")).to_pylist()]
            if remove == "documents" and any(found):
                batch = batch.filter(pa.array([not hits for hits in found], pa.bool_()))
                texts = [data for data, hits in zip(texts, found) if not hits]
                found = [[]] * len(texts)
            out: list[tuple] = []
            for data, hits in zip(texts, found):
                inside = np.zeros(len(data or b"") + 2, np.int8)
                inside[1:-1] = in_word[np.frombuffer((data or b"").lower(), np.uint8)]
                step = np.diff(inside)
                first, last = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
                if not hits:
                    out.append((len(first), 0, [], [], data))
                    continue
                level = np.zeros(len(first) + 1, np.int64)
                np.add.at(level, [at for at, _, _ in hits], 1)
                np.add.at(level, [at + m for at, m, _ in hits], -1)
                covered = np.concatenate(([False], np.cumsum(level[:-1]) > 0, [False])).astype(np.int8)
                edge = np.diff(covered)
                runs = list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))
                if remove == "spans":
                    keep, at = [], 0
                    for a, b in runs:
                        keep.append(data[at : first[a]].rstrip())
                        at = last[b - 1]
                    data = b" ".join(x for x in (*keep, data[at:].lstrip()) if x)
                items = sorted({name for _, _, name in hits if name is not None})
                out.append((len(first), int(covered.sum()), [{"at": a, "n": b - a} for a, b in runs], items, data))
            n_words, n_hit, spans, items, kept = zip(*out) if out else ([],) * 5
            columns = dict(zip(names, batch.columns)) | {text: pa.array(kept, pa.binary()).cast(pa.string())}
            columns.pop("__hits", None)
            columns |= dict(zip(added, (pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(spans, span), pa.array(items, pa.list_(pa.string())))))
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    schema = schema_with(own, "n_words long, n_hit long, spans array<struct<at:long,n:long>>, items array<string>")
    return hit.mapInArrow(run, schema)
