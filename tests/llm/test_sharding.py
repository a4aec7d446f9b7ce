"""Rendezvous sharding against xxHash and zlib, and its law."""

import math
import zlib
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from tallyframe.llm.queries import QUERIES
from tallyframe.llm.sharding import shard_of, shards


def winner(key, weights):
    def score(i, w):
        u = ((xxhash.xxh64_intdigest(f"shard{i}:{key}", 42) >> 11) + 0.5) / 2**53
        return -w / math.log(u)

    return max(range(len(weights)), key=lambda i: (score(i, weights[i]), -i) if weights[i] else (-1, -i))


def test_query(spark, folder, nasty):
    rows = [*nasty, *[(i, f"text {i % 7}") for i in range(300)]]
    out = QUERIES["op3_sharding"](spark, folder(rows)).collect()
    assert len(out) == len(rows)
    keys = {i: "\x00null" if i is None else str(i) for i, _ in rows}
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in out) == sorted((i or -1, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    for r in out:
        assert r.law == "key" and r.shard == winner(keys[r.doc_id], [1.0] * 16) and r.grown_shard == winner(keys[r.doc_id], [1.0] * 17)
        assert r.grown_shard in (r.shard, 16)
    for shard in range(16):
        assert sorted(r.slot for r in out if r.shard == shard) == list(range(sum(r.shard == shard for r in out)))


def test_weights_and_growth(spark):
    df = spark.range(8000).withColumnRenamed("id", "key")
    placed = df.select("key", shard_of("key", [1.0, 2.0, 0.0, 5.0]).alias("a"), shard_of("key", [1.0, 2.0, 0.0, 5.0, 2.0]).alias("b")).collect()
    share = Counter(r.a for r in placed)
    assert share[2] == 0 and abs(share[3] / 8000 - 5 / 8) < 0.02 and abs(share[0] / 8000 - 1 / 8) < 0.02
    assert all(r.b in (r.a, 4) for r in placed) and abs(sum(r.b == 4 for r in placed) / 8000 - 0.2) < 0.02


def test_slots_do_not_move_with_partitions_and_names_may_clash(spark, docs, nasty):
    df = docs(nasty).withColumn("slot", F.lit("mine"))
    one = shards(df, "doc_id", [1.0] * 3, ties=["text"])
    assert one.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "slot"]
    many = shards(df.repartition(5), "doc_id", [1.0] * 3, ties=["text"])
    assert sorted(one.collect(), key=repr) == sorted(many.collect(), key=repr)
    assert shards(df.where("false"), "doc_id", [1.0]).count() == 0
