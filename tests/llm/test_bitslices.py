"""Bit-sliced top-k against sorted integer products."""

import math

import numpy as np
import pytest

from tallyframe.llm import bitslices
from tallyframe.llm.bitslices import Block, add_bitmaps, at_least, bitmap, positions

SCHEMA = "vec_id long, embedding array<float>, label int"
WIDE = "vec_id long, embedding array<double>, score long, block int, rank int"


def by_hand(rows, k, every=20, scale=64.0):
    """Sorted (query, rank, id, score) by comparing everything."""
    def usable(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    whole = [(i, [max(-(1 << 58), min(1 << 58, math.floor(scale * x))) for x in r[1]]) for i, r in enumerate(rows) if usable(r[1])]
    out = []
    for i, q in whole:
        if rows[i][0] is not None and rows[i][0] % every == 0:
            found = [(-sum(a * b for a, b in zip(q, v)), rows[j][0] is None, rows[j][0] or 0) for j, v in whole if j != i]
            out += [(rows[i][0], n + 1, None if none else key, max(-(1 << 63), min((1 << 63) - 1, -s))) for n, (s, none, key) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.select("query_id", "rank", "vec_id", "score").collect()), key=repr)


def test_adders_sum_bitmaps():
    rng = np.random.default_rng(1)
    for m in (1, 2, 3, 7, 40):
        bits = rng.random((m, 130)) < 0.4
        left, sums, place = [np.stack([bitmap(b) for b in bits])], [], 0
        while left:
            total, carries = add_bitmaps(np.concatenate(left))
            sums.append(total)
            left = carries
        value = sum(np.isin(np.arange(192), positions(s)).astype(int) << i for i, s in enumerate(sums))
        assert value[:130].tolist() == bits.sum(axis=0).tolist()
        for number in (0, 1, m // 2, m, m + 1, 4 * m + 5):
            wanted = np.flatnonzero(bits.sum(axis=0) >= number).tolist()
            assert positions(at_least(sums, number, bitmap(np.ones(130, bool)))).tolist() == wanted


@pytest.mark.parametrize("seed", range(6))
def test_block_picks_the_best_rows(seed):
    rng = np.random.default_rng(seed)
    values = rng.integers(-9, 9, (rng.integers(1, 200), rng.integers(1, 7)))
    block = Block.of(values)
    assert (bitslices.values_of(block) == values).all()
    for _ in range(20):
        w, k, own = rng.integers(-5, 6, values.shape[1]).tolist(), int(rng.integers(1, 30)), int(rng.integers(0, len(values)))
        wanted = sorted((-int(s), i) for i, s in enumerate(values @ np.array(w)) if i != own)
        assert block.top(w, k, own) == [(i, -s) for s, i in wanted[:k]]
        floor = -wanted[len(wanted) // 2][0] if wanted else 0
        assert block.top(w, k, own, floor) == [(i, -s) for s, i in wanted if -s >= floor][:k]


@pytest.mark.parametrize("blocks", [(16_384, 1_024), (16, 3)])
def test_all_rows_against_all(spark, blocks):
    rng = np.random.default_rng(3)
    rows = [(i % 90, [float(np.float32(x)) for x in rng.normal(0, 0.3, 5)], 0) for i in range(120)]
    rows += [(200 + i, [0.25, -0.5, 0.125, 0.0, 1.0], 1) for i in range(60)]  # equal vectors
    rows += [(20, None, 0), (40, [0.5, None, 0.1, 0.0, 0.2], 0), (60, [float("nan")] * 5, 0), (80, [float("inf"), 0.0, 0.0, 0.0, 0.0], 0)]
    rows += [(None, [1.0, 1.0, 1.0, 1.0, 1.0], 0), (None, [1.0, 1.0, 1.0, 1.0, 1.0], 0), (100, [], 0), (-20, [0.5, -0.25], 0), (100, [], 0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert got(bitslices.top_products(df, "vec_id", "embedding", 20, block_rows=blocks[0], query_rows=blocks[1], chunk_blocks=2)) == by_hand(rows, 20)


def test_huge_components_and_clashing_names(spark):
    rows = [(20 * i, [x, 1.0], 7, 1, 2) for i, x in enumerate([1e300, -1e300, 3e15, -3e15, 0.5, 1e-300, (1 << 60) * 1.0])]
    df = spark.createDataFrame(rows, WIDE)
    out = bitslices.top_products(df, "vec_id", "embedding", 3)
    assert out.columns == ["query_id", "rank", "vec_id", "score"] and got(out) == by_hand(rows, 3)
    assert bitslices.top_products(df.where("false"), "vec_id", "embedding").count() == 0
    assert bitslices.top_products(df.limit(1), "vec_id", "embedding").count() == 0
