"""Ranked lexical search by NRA: impact-sorted lists read in sequence, score intervals per document.

Documents are tokenised once; only their terms that some item asks for are kept, beside their length.  The index is
divided by document: a task turns the documents of its part into lists of (document, impact) per term, largest impact
first, and answers every item on them without random access (Fagin, Lotem & Naor 2003).  A part's answer has exact
scores, so the best of all parts are the best of all documents.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from .store import stored
from .text import utf8

TERM, EDGE = re.compile(rb"[0-9a-z\x80-\xff]+"), re.compile(rb"[^0-9a-z\x80-\xff]")
PIECE = 1 << 20
SIEVE_BITS = 23  # a sieve of one megabyte, however many terms there are


def term_counts(data: bytes) -> Counter[bytes]:
    """Occurrences of every term: runs of digits, letters (A-Z lower-cased) and characters beyond ASCII.

    Works in pieces that end between terms, so a long text never stands in memory as a list of words.
    """
    data, counts, at = data.lower(), Counter(), 0
    while at < len(data):
        edge = EDGE.search(data, at + PIECE)
        end = edge.start() if edge else len(data)
        counts.update(TERM.findall(data, at, end))
        at = end
    return counts


def item_terms(items: DataFrame, item: str, text: str) -> DataFrame:
    """(number of the item's row, its id, term) for the distinct terms of every item, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [list(term_counts(data or b"")) for data in utf8(batch.column(2))]
            sizes = [len(f) for f in found]
            rows = pa.array(np.repeat(np.arange(len(found)), sizes))
            terms = pa.array([t.decode() for f in found for t in f], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), terms], names=["row", "item", "term"])

    kind = items.schema[item].dataType.simpleString()
    asked = items.select(F.monotonically_increasing_id().alias("row"), F.col(item).alias("item"), F.col(text).cast("string"))
    return stored(asked.mapInArrow(run, f"row long, item {kind}, term string"))


def sieve(terms: DataFrame) -> bytes:
    """One byte per residue of crc32: whether some term has it.  Lets every asked term pass, and few others."""
    place = F.pmod(F.crc32(F.col("term").cast("binary")), F.lit(1 << SIEVE_BITS))
    bits = terms.select(F.floor(place / 64).alias("word"), F.expr("1L").alias("one"), (place % 64).cast("int").alias("bit"))
    words = bits.groupBy("word").agg(F.bit_or(F.expr("shiftleft(one, bit)")).alias("bits")).collect()  # at most 2**17 rows
    table = np.zeros(1 << (SIEVE_BITS - 6), np.int64)
    for word, value in words:
        table[word] = value
    return np.unpackbits(table.view(np.uint8), bitorder="little").tobytes()


def postings(docs: DataFrame, key: str, text: str, passing: bytes) -> DataFrame:
    """One row per document with a term: id, number of its terms, and those terms that pass the sieve with their counts."""
    shared = docs.sparkSession.sparkContext.broadcast(passing)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes, mask = shared.value, (1 << SIEVE_BITS) - 1
        for batch in batches:
            keep, sizes, terms, times = [], [], [], []
            for i, data in enumerate(utf8(batch.column(1))):
                counts = term_counts(data or b"")
                if counts:
                    known = [(t, c) for t, c in counts.items() if passes[zlib.crc32(t) & mask]]
                    keep.append(i)
                    sizes.append(counts.total())
                    terms.append([t.decode(errors="replace") for t, _ in known])
                    times.append([c for _, c in known])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep, pa.int32())), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.string())), pa.array(times, pa.list_(pa.int64()))],
                names=["doc", "n", "terms", "times"],
            )

    slim = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string"))
    return stored(slim.mapInArrow(run, "doc long, n long, terms array<string>, times array<long>"))


def no_random_access(lists: list[tuple[np.ndarray, np.ndarray]], n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents that hold the k largest sums of impacts, all that tie with the k-th included, and their exact sums.

    ``lists`` has (documents, impacts) per term, impacts above 0 and falling.  All lists are read down to one impact, which
    halves with each turn.  What was read of a document is its lower bound; its upper bound adds the next impact of
    every list in which it was not met.  When the k-th lower bound is above the sum of all next impacts, no new
    document can enter; from then on only documents whose upper bound reaches the k-th lower bound are followed.
    The reading ends when the bounds of all that are left are equal.
    """
    lower = np.zeros(n_docs, np.int64)
    done, alive = [0] * len(lists), None
    limit = max((int(c[0]) for _, c in lists if len(c)), default=0)
    while True:
        limit >>= 1
        for t, (docs, c) in enumerate(lists):
            upto = len(c) - int(np.searchsorted(c[::-1], max(limit, 1)))
            lower[docs[done[t] : upto]] += c[done[t] : upto]  # a list names a document once
            done[t] = upto
        ahead = [int(c[n]) if n < len(c) else 0 for (_, c), n in zip(lists, done)]
        met = np.flatnonzero(lower) if alive is None else alive
        if len(met) >= k:
            kth = int(np.partition(lower[met], len(met) - k)[len(met) - k])
        else:
            kth = 0
        if not sum(ahead):
            return met[lower[met] >= kth], lower[met[lower[met] >= kth]]
        if alive is None and sum(ahead) >= kth:
            continue
        known = np.zeros(n_docs, np.int64)
        for (docs, _), n, a in zip(lists, done, ahead):
            if a:
                known[docs[:n]] += a
        upper = lower[met] + sum(ahead) - known[met]
        alive = met[upper >= kth]
        if (upper[upper >= kth] == lower[alive]).all():
            return alive, lower[alive]
        follow = np.zeros(n_docs, bool)
        follow[alive] = True
        for t, (docs, c) in enumerate(lists):  # the rest of a list, without documents that are out
            on = follow[docs]
            done[t] = int(on[: done[t]].sum())
            lists[t] = docs[on], c[on]


class Part:
    """Lists of the documents of one part, gathered row by row."""

    def __init__(self, number: dict[str, tuple[int, int]], n_docs: int, n_terms: int):
        self.number, self.n_docs, self.n_terms = number, n_docs, n_terms
        self.ids: list[int | None] = []
        self.rows: list[tuple[int, int, int]] = []

    def add(self, doc: int | None, n: int, terms: list[str], times: list[int]) -> None:
        m = 50 + 50 * n * self.n_docs // self.n_terms
        at = len(self.ids)
        self.ids.append(doc)
        for term, tf in zip(terms, times):
            known = self.number.get(term)
            if known is not None:
                self.rows.append((known[0], known[1] * (1_000_000_000 * tf // (1000 * tf + 20 * m)), at))

    def search(self, items: list[tuple[int, object, list[int]]], k: int) -> Iterator[tuple[int, object, int | None, int]]:
        """(row of the item, item, document, score) of each item's k best documents; ties by id, NULL last."""
        table = np.array(self.rows, np.int64).reshape(-1, 3)
        table = table[table[:, 1] > 0]
        table = table[np.lexsort((-table[:, 1], table[:, 0]))]
        term, docs, c = table[:, 0], np.ascontiguousarray(table[:, 2]), np.ascontiguousarray(table[:, 1])
        starts = np.searchsorted(term, np.arange(len(self.number) + 1))
        missing = np.array([i is None for i in self.ids], bool)
        ids = np.array([i or 0 for i in self.ids], np.int64)
        for row, item, asked in items:
            lists = [(docs[a:b], c[a:b]) for a, b in ((starts[t], starts[t + 1]) for t in asked) if a < b]
            if lists:
                found, scores = no_random_access(lists, len(ids), k)
                best = np.lexsort((ids[found], missing[found], -scores))[:k]
                for at, score in zip(found[best].tolist(), scores[best].tolist()):
                    yield row, item, self.ids[at], score


def best_documents(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    k: int = 50, max_terms: int = 500_000, part_postings: int = 1_000_000,
) -> DataFrame:
    """The ``k`` documents of highest score for every row of ``items``: (item, rank, key, score), scores above 0 only.

    A term weighs floor(1000 * ln((2N + 2) / (2 df + 1))); a document scores weight * (10^9 tf div (1000 tf + 20 m)) for
    each distinct term of the item, m = 50 + (50 n N) div L.  N counts documents with a term, L their terms, n the
    document's, df documents with the term.  Equal scores go by key, NULL last.  Every row of either table counts for
    itself, also where ids repeat or are NULL; texts that are NULL, empty or without terms match nothing.

    Items go in blocks of about ``max_terms`` terms, which are broadcast one after the other, each over the stored
    lists alone; a task holds ``part_postings`` entries of lists at a time (and those of one more document).
    """
    asked = item_terms(items, item, item_text)
    kept = postings(docs, key, text, sieve(asked))
    n_docs, n_terms = kept.agg(F.count("*"), F.sum("n")).first()
    found = docs.sparkSession.createDataFrame([], f"row long, item {items.schema[item].dataType.simpleString()}, doc long, score long")
    if n_docs:
        holders = kept.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
        weighed = stored(asked.join(holders, "term"))
        n_blocks = max(1, -(-weighed.count() // max_terms))
        parts = [_search(kept, weighed.where(F.pmod(F.xxhash64("row"), F.lit(n_blocks)) == b), n_docs, n_terms, k, part_postings, found.schema) for b in range(n_blocks)]
        found = parts[0]
        for part in parts[1:]:
            found = found.unionByName(part)
    best = Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k)
    return ranked.select(F.col("item").alias(item), "rank", F.col("doc").alias(key), "score")


def _search(kept: DataFrame, block: DataFrame, n_docs: int, n_terms: int, k: int, part_postings: int, schema: StructType) -> DataFrame:
    """Each part's best documents for the items of one block, stored, so that the next block's terms take its place."""
    number: dict[str, tuple[int, int]] = {}
    items: dict[int, tuple[int, object, list[int]]] = {}
    for term, row, item, df in block.select("term", "row", "item", "df").collect():
        weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
        if weight:
            at, _ = number.setdefault(term, (len(number), weight))
            items.setdefault(row, (row, item, []))[2].append(at)
    shared = kept.sparkSession.sparkContext.broadcast((number, list(items.values())))
    types = [to_arrow_type(f.dataType) for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, items = shared.value

        def answers(part: Part) -> pa.RecordBatch:
            columns = list(zip(*part.search(items, k))) or [(), (), (), ()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            return pa.RecordBatch.from_arrays(arrays, names=["row", "item", "doc", "score"])

        part = Part(number, n_docs, n_terms)
        for batch in batches:
            for doc, n, terms, times in zip(*(c.to_pylist() for c in batch.columns)):
                part.add(doc, n, terms, times)
                if len(part.rows) >= part_postings:
                    yield answers(part)
                    part = Part(number, n_docs, n_terms)
        if part.rows:
            yield answers(part)

    return stored(kept.mapInArrow(run, schema))
