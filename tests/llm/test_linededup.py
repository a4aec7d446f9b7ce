"""Line deduplication against brute force, and back."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.llm.linededup import Cuckoo, LineIndex, built, digest, shard_of
from tallyframe.llm.store import stored

ROWS = [(i, f"Shared line \nown {i}\n\n{'twice' if i < 4 else 'rare'} {i // 2}") for i in range(12)]
ROWS += [(50, None), (51, ""), (52, "  SHARED LINE\t"), (53, "\n\n"), (None, "shared line\nélan"), (54, "own 54"), (54, "own 54"), (55, "x" * 50_000 + "\nshared line")]


def brute(rows, least):
    strip = " \t\n\x0b\x0c\r"
    lower = {i: chr(i + 32) for i in range(65, 91)}
    key = lambda line: line.strip(strip).translate(lower)
    count = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")} if k)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not key(x) or count[key(x)] < least]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("least", [1, 2, 10])
@pytest.mark.parametrize("max_bytes", [0, 64 << 20])
def test_against_brute_force(docs, least, max_bytes):
    df = docs(ROWS)
    out = LineIndex.of(df, least=least, n_shards=3).drop_lines(df, max_bytes=max_bytes)
    assert out.columns == [*df.columns, "n_lines", "n_dropped"]
    assert got(out) == brute(ROWS, least)


def test_insert_and_delete_are_reversible(docs):
    first, second = docs(ROWS[:9]), docs(ROWS[9:])
    start = LineIndex.of(first, least=3, n_shards=2)
    both = start.insert(second)
    assert got(both.drop_lines(docs(ROWS))) == brute(ROWS, 3)
    back = both.delete(second)
    table = lambda x: sorted((r["shard"], bytes(r["key"]), r["n"]) for r in x.counts.collect())
    assert table(back) == table(start)
    assert got(back.drop_lines(first)) == brute(ROWS[:9], 3)
    with pytest.raises(Exception, match="not in the index"):
        back.delete(second)


@pytest.mark.parametrize("max_bytes", [0, 64 << 20])
def test_lines_that_a_filter_holds_by_chance_stay(spark, docs, max_bytes):
    """Keys that were never counted, or too seldom, but meet a fingerprint: here they are put into the filters."""
    index = LineIndex.of(docs(ROWS), least=2, n_shards=3)
    chance = spark.createDataFrame([(digest(b"never counted"),), (digest(b"own 3"),)], "key binary")
    chance = chance.select(shard_of(F.col("key"), 3).alias("shard"), "key")
    filters = stored(built(index.counts.where("n >= 2").select("shard", "key").unionByName(chance)))
    out = LineIndex(index.counts, filters, 2, 3).drop_lines(docs([(900, "Never counted\nshared line\nnew\nown 3")]), max_bytes=max_bytes)
    assert got(out) == [(900, 4, 1, "Never counted\nnew\nown 3")]


def test_empty_table_and_clashing_names(spark, docs):
    empty = docs(ROWS).where("false")
    assert LineIndex.of(empty).drop_lines(empty).count() == 0
    named = docs(ROWS).withColumns({"key": F.lit(1), "shard": F.lit("s"), "n_lines": F.lit(-1)})
    out = LineIndex.of(named, least=2).drop_lines(named)
    assert got(out) == brute(ROWS, 2) and {(r["key"], r["shard"]) for r in out.collect()} == {(1, "s")}


def test_cuckoo_finds_all_and_removes():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, 3000).astype(np.uint64)
    made = Cuckoo.of(keys)
    assert made.has(keys).all()
    assert made.has(rng.integers(0, 2**63, 100_000).astype(np.uint64)).sum() == 0
    for k in keys[:1000].tolist():
        assert made.remove(k)
    assert Cuckoo.load(made.dump()).has(keys[1000:]).all() and not made.has(keys[:1000]).any()
    assert not Cuckoo(1).remove(5)


def test_query(spark, docs, tmp_path):
    from tallyframe.llm.queries import QUERIES

    docs(ROWS).write.parquet(f"{tmp_path}/documents.parquet")
    out = QUERIES["op1_line_dedup"](spark, str(tmp_path)).collect()
    want = [(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute(ROWS, 10)]
    assert sorted(map(tuple, out), key=repr) == sorted(want, key=repr)
