"""Rendezvous hashing of stable record keys over weighted shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .totals import bucket_count, running


def unit(h: Column) -> Column:
    """A 64-bit hash as a number in (0, 1)."""
    return (F.shiftrightunsigned(h, 11).cast("double") + 0.5) / F.lit(float(1 << 53))


def key_hash(key: str, salt: str) -> Column:
    """xxHash64 (seed 42) of the salt, a colon and the key as text; NULL counts as a key of its own."""
    return F.xxhash64(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col(key).cast("string"), F.lit("\x00null"))))


def shard_of(key: str, weights: Sequence[float], salt: str = "shard") -> Column:
    """The shard that wins the key: the largest of -weight / ln(u), u drawn by key and shard.

    A shard's draw depends on nothing but the key and its own number, so one more shard takes records only
    into itself, and a shard's share follows its weight.  Shards of weight 0 get nothing.
    """
    if not weights or min(weights) < 0 or max(weights) <= 0:
        raise ValueError("weights must not be negative, and one must be above 0")
    drawn = [
        F.struct((-float(w) / F.log(unit(key_hash(key, f"{salt}{i}")))).alias("score"), F.lit(-i).alias("minus"))
        for i, w in enumerate(weights)
        if w > 0
    ]
    best = drawn[0] if len(drawn) == 1 else F.greatest(*drawn)
    return (-best["minus"]).cast("int")


def shards(df: DataFrame, key: str, weights: Sequence[float], ties: Sequence[str] = (), shard: str = "shard", slot: str = "slot") -> DataFrame:
    """Add ``shard`` and ``slot``: the place of the record in its shard, from 0 without gaps.

    Slots follow the hash of the key, then the key, then ``ties``; rows equal in all of them are
    interchangeable.  NULL keys share one shard, repeated keys too.  Columns of these names are replaced.
    The slots need one shuffle of the rows and one small one of bucket totals; no task orders a whole shard.
    """
    placed = df.drop(shard, slot).withColumn(shard, shard_of(key, weights))
    order = [F.col(key), *[F.col(t) for t in ties]]
    return running(placed, [shard], unit(key_hash(key, "slot")), order, F.lit(1), bucket_count(df.count()), slot)
