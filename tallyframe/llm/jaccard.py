"""Near duplicates: a Jaccard join of word shingles by PartEnum signatures."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components, downward, joined_up, labels
from .store import batches_of, stored
from .text import WordHasher, by_spaces, mixed, utf8, windows

FEW = 1  # members of a group that are compared with all others in the first turn, and eight times more in each further one
PAIR_BYTES = "8m"  # of whole texts or sets that a task takes from Spark at once
LARGE = 16  # members of a group that, without being one class after the first turn, is dealt anew by rarest features


class Signer:
    """PartEnum signatures of sets of 64-bit features.

    Sizes are cut into bands; a set joins the instance of its band, and that of the band below when a partner of
    100/percent less size may stand there.  An instance knows the most features k in which two of its sets of the
    wanted similarity differ, and deals the feature domain out to n1 parts of n2 = 2 cells.  Enumerating the
    subsets of n2 - 1 cells of every part gives 2 n1 > k projections of a set, and similar sets share one: a
    differing feature changes one projection only.

    Of its own projections a set sends the k + 1 first in an order that all sets share (more features first):
    the first one that two similar sets have in common comes after at most k others in either.  Empty projections
    are not sent.  A set with no more than k projections that hold a feature might share none with another such
    set; those few also send their first features by hash, as many as their prefix needs.
    """

    def __init__(self, percent: int):
        self.percent = percent
        self.bounds = [1]

    def band(self, size: int) -> int:
        while self.bounds[-1] <= size:
            self.bounds.append(max(self.bounds[-1] + 1, self.bounds[-1] * 195 // 100))
        return int(np.searchsorted(self.bounds, size, side="right")) - 1

    def __call__(self, features: np.ndarray) -> np.ndarray:
        size, p = len(features), self.percent
        if size == 0:
            return np.empty(0, np.uint64)
        band = self.band(size)
        out = [self.instance(features, band)]
        if band and -(-p * size // 100) < self.bounds[band]:
            out.append(self.instance(features, band - 1))
        return np.unique(np.concatenate(out))

    def instance(self, features: np.ndarray, band: int) -> np.ndarray:
        p, size, most = self.percent, len(features), self.bounds[band + 1] - 1
        differ = size * (100 - p) // p  # features of this set and its partner that the other one lacks, at most
        n1 = (most * (100 - p) // p * 13 // 10 + 5) // 2
        salt = mixed(np.array([band * 1_000_003 + 1], np.uint64))
        spread = mixed(features ^ salt)
        cell = (((spread >> np.uint64(32)) * np.uint64(2 * n1)) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(cell, kind="stable")
        cell, value = cell[order], mixed(spread + np.uint64(0x51ED270B))[order]
        starts = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
        held = np.diff(np.append(starts, size))
        projection = mixed(np.add.reduceat(value, starts) ^ mixed(cell[starts].astype(np.uint64) + salt))
        if len(projection) <= differ:
            first = np.sort(value)[: size - -(-p * size // 100) + 1]
            return np.concatenate((projection, mixed(first + np.uint64(1))))
        rank = ((np.uint64(255) - np.minimum(held, 255).astype(np.uint64)) << np.uint64(56)) | (projection >> np.uint64(8))
        return projection[np.argpartition(rank, differ)[: differ + 1]] if differ + 1 < len(rank) else projection


def shingles(hasher: WordHasher, data: bytes | None, n: int) -> np.ndarray:
    """The distinct hashes of the text's n-word shingles, sorted."""
    return np.unique(windows(hasher((data or b"").lower()), n))


def _signatures(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(key, id, n): signatures (n NULL), documents (n = set size) and copies of an earlier document of the same
    partition (n = -1, key = the earlier id), which send no signatures of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, signer, seen = WordHasher(by_spaces()), Signer(percent), {}
        for batch in batches:
            keys, ids, sizes = [], [], []
            for key, data in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                found = shingles(hasher, data, n)
                rows, kind = [mixed(np.array([key], np.int64).view(np.uint64))], [len(found)]
                if len(found):
                    digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
                    first = seen.setdefault(digest, key)
                    if first != key:
                        rows.append(np.array([first], np.int64).view(np.uint64))
                        kind.append(-1)
                    else:
                        rows.append(signer(found))
                        kind.extend([-2] * len(rows[-1]))
                keys.append(np.concatenate(rows))
                ids.append(np.full(len(kind), key, np.int64))
                sizes.append(np.array(kind, np.int32))
            if not keys:
                continue
            size = np.concatenate(sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(ids)), pa.array(size, mask=size == -2)], names=["key", "id", "n"]
            )

    return docs.mapInArrow(run, "key long, id long, n int")


def _shared(rows: DataFrame) -> DataFrame:
    """Signature rows whose signature two or more ids have, and all other rows."""
    group = Window.partitionBy("key")
    own = F.when(F.col("n").isNull(), F.col("id"))
    marked = rows.withColumns({"lo": F.min(own).over(group), "hi": F.max(own).over(group)})
    return marked.where(F.col("n").isNotNull() | (F.col("lo") < F.col("hi"))).select("key", "id", "n")


def _sets(docs: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """(id, features) of the documents that share a signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(by_spaces())
        for batch in batches:
            made = [shingles(hasher, data, n).tobytes() for data in utf8(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["id", "features"])

    return docs.join(ids, "id", "left_semi").select("id", "text").mapInArrow(run, "id long, features binary")


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, compared whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = 0
                if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], names=["a", "b"])

    x, y = sets.select(F.col("id").alias("a"), F.col("features").alias("x")), sets.select(F.col("id").alias("b"), F.col("features").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _by_rarest(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The members of groups dealt anew (key, id, place), by their rarest features; place counts those before, 1 and up.

    Long passages that many texts share make large groups of texts that are not similar.  Of two similar sets, each
    ordered by how many members have a feature, rare ones first, the prefixes share a feature when a prefix leaves out
    one feature less than the smallest overlap.  So every similar pair still meets, and the shared passages stand last.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                made = np.frombuffer(data.as_buffer(), np.int64)
                prefix = len(made) - -(-percent * len(made) // 100) + 1
                yield pa.RecordBatch.from_arrays([pa.array(made), pa.array(np.full(len(made), i, np.int64)), pa.array(np.full(len(made), prefix, np.int32)), pa.array(np.full(len(made), np.bitwise_xor.reduce(made)))], names=["key", "id", "prefix", "text"])

    features = stored(sets.join(groups.select("id").distinct(), "id", "left_semi").mapInArrow(run, "key long, id long, prefix int, text long"))
    spread = features.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    rarest = Window.partitionBy("id", "text").orderBy("n", "key")  # the texts of a repeated id each by itself
    ranked = features.join(spread, "key").withColumn("__rank", F.row_number().over(rarest))
    return ranked.where(F.col("__rank") <= F.col("prefix")).where("n > 1").select("key", "id", F.col("__rank").cast("int").alias("place")).groupBy("key", "id").agg(F.min("place").alias("place"))


def _once(rows: DataFrame) -> DataFrame:
    """One of all groups (key, id, place) of two or more members that have the same members, with their least places."""
    kinds = rows.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.bit_xor(F.xxhash64("id")).alias("x"), F.min("id").alias("lo"), F.max("id").alias("hi")).where("m > 1")
    named = kinds.select("key", F.xxhash64("m", "x", "lo", "hi").alias("one"))  # should unlike groups get one name, their members meet in one group
    return rows.join(named, "key").groupBy(F.col("one").alias("key"), "id").agg(F.min("place").alias("place"))


def _classed(groups: DataFrame, forest: DataFrame) -> DataFrame:
    """Members of the groups that are not of one class yet, with their class c, its ``members`` and the group's size m.

    What is used twice is stored, so that Spark doesn't make it twice.
    """
    known = stored(labels(forest))
    sizes = known.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    known = known.join(sizes, "component").select("id", F.col("component").alias("c"), "members")
    now = stored(groups.join(known, "id", "left").withColumns({"c": F.coalesce("c", "id"), "members": F.coalesce("members", F.lit(0))}))
    mixed_groups = now.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count(F.lit(1)).alias("m")).where("lo < hi").select("key", "m")
    return stored(now.join(mixed_groups, "key"))


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """Classes of documents whose sets of ``n``-word shingles reach a Jaccard similarity of ``percent`` / 100.

    Words are split at spaces and \\t to \\r, A-Z lower-cased; a shorter text, but not an empty one, is one shingle.
    Returns doc id (under the name ``key``), n_shingles (0 for NULL and empty texts, which link with nothing) and
    component_id, the smallest id that links lead to.  Ids are whole numbers; rows of a repeated id are one document
    in the graph and one row each here; rows without an id are returned with a NULL component.

    Signatures meet in one shuffle.  In a group of documents with one signature, a few members, then ever more of them, are compared
    with the others that no link has joined to them yet, over several turns, so that copies are not compared pairwise
    and no link between classes is lost: a turn ends only those members that have been compared with all.  Members of
    large groups that are no class are dealt anew by their rarest features.
    """
    docs = df.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    nameless = docs.where(F.col("id").isNull())
    docs = docs.where(F.col("id").isNotNull())
    with batches_of(df.sparkSession, PAIR_BYTES):
        rows = stored(_shared(_signatures(docs, n, percent)))
    copies = rows.where("n = -1").select(F.col("key").alias("a"), F.col("id").alias("b"))
    counts = rows.where("n >= 0").groupBy("id").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    groups = stored(_once(rows.where("n is null").select("key", "id").distinct().withColumn("place", F.lit(1))).join(counts, "id"))
    forest = stored(downward(copies, "a", "b"))
    with batches_of(df.sparkSession, PAIR_BYTES):
        sets = None if groups.isEmpty() else stored(_sets(docs, groups.select("id").distinct(), n))
    tested, turn = None, 0
    while sets is not None:
        held = _classed(groups, forest)
        if held.isEmpty():
            break
        first = Window.partitionBy("key").orderBy(F.log2(F.col("members") + 1).cast("int"), F.xxhash64("id", F.lit(turn)), "id")  # small classes first
        hubs = held.withColumn("__turn", F.row_number().over(first)).where(F.col("__turn") <= FEW * 8**turn).select("key", *[F.col(c).alias(f"hub_{c}") for c in ("id", "c", "place", "least", "most")])
        # of sizes a and b at least p / (100 + p) of a + b must be common: this feature and at most all after it, in either
        after = F.least(F.col("most") - F.col("place"), F.col("hub_most") - F.col("hub_place")) + 1
        enough = (after * (100 + percent) >= percent * (F.col("least") + F.col("hub_least"))) & (100 * F.least("most", "hub_most") >= percent * F.greatest("least", "hub_least"))
        meet = held.join(hubs, "key").where((F.col("c") != F.col("hub_c")) & enough)
        pairs = meet.select(F.least("id", "hub_id").alias("a"), F.greatest("id", "hub_id").alias("b")).distinct()
        pairs = stored(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"))
        tested = pairs if tested is None else tested.unionByName(pairs)
        with batches_of(df.sparkSession, PAIR_BYTES):
            found = stored(_links(pairs, sets, percent))
        if not found.isEmpty():
            forest = stored(joined_up(forest.unionByName(downward(found, "a", "b"))))
        rest = held.join(hubs.select("key", F.col("hub_id").alias("id")), ["key", "id"], "left_anti")
        if turn == 0:
            large = held.where(F.col("m") > LARGE)
            rest = rest.where(F.col("m") <= LARGE)
            if not large.isEmpty():
                rest = rest.select(*groups.columns).unionByName(_once(_by_rarest(large, sets, percent)).join(counts, "id"))
        groups = stored(rest.select(*groups.columns))
        turn += 1
    classes = components(forest)
    named = rows.where("n >= 0").select("id", "n").join(classes, "id", "left")
    out = named.select(F.col("id").alias(key), F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
    return out.unionByName(_nameless(nameless, key, n))


def _nameless(docs: DataFrame, key: str, n: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(by_spaces())
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(shingles(hasher, data, n)) for data in utf8(batch.column(0))], pa.int64())], names=["n_shingles"])

    counted = docs.select("text").mapInArrow(run, "n_shingles long")
    return counted.select(F.lit(None).cast("long").alias(key), "n_shingles", F.lit(None).cast("long").alias("component_id"))
