"""Targets, flow and selection of a mix against brute force."""

import itertools
import random

import pytest

from tallyframe.llm.mixing import mix, quotas, route
from tallyframe.llm.queries import QUERIES


def test_quotas_stop_at_their_cap_and_share_the_rest():
    assert quotas([10, 10, 10], [1, 2, 3]) == [5, 10, 15]
    assert quotas([100, 1, 1], [1, 1, 1], 102) == [96, 3, 3]
    assert quotas([10, 0, 10], [1, 5, 1]) == [10, 0, 10]
    assert quotas([1, 1], [1, 1], 100) == [3, 3]
    assert quotas([], []) == []


def best(capacity, members, wanted, most):
    """Most tokens, then least cost, over all whole flows."""
    ways = [[f for f in itertools.product(range(most * c + 1), repeat=len(m)) if sum(f) <= most * c] for c, m in zip(capacity, members)]
    found = None
    for flows in itertools.product(*ways):
        into = [0] * len(wanted)
        for m, f in zip(members, flows):
            for s, x in zip(m, f):
                into[s] += x
        if all(x <= w for x, w in zip(into, wanted)):
            cost = sum(sum(r * r * max(0, min(c, sum(f) - (r - 1) * c)) for r in range(1, most + 1)) for c, f in zip(capacity, flows))
            key = (sum(into), -cost)
            found = key if found is None else max(found, key)
    return found


def test_flow_is_largest_and_cheapest():
    rng = random.Random(3)
    for _ in range(40):
        n, m = rng.randint(1, 3), rng.randint(1, 2)
        capacity = [rng.randint(0, 2) for _ in range(n)]
        members = [sorted(rng.sample(range(m), rng.randint(0, m))) for _ in range(n)]
        wanted = [rng.randint(0, 6) for _ in range(m)]
        flow = route(capacity, members, wanted, 3)
        sent = [sum(f.values()) for f in flow]
        cost = sum(sum(r * r * max(0, min(c, x - (r - 1) * c)) for r in (1, 2, 3)) for c, x in zip(capacity, sent))
        assert (sum(sent), -cost) == best(capacity, members, wanted, 3)
        assert all(x <= 3 * c for c, x in zip(capacity, sent)) and all(set(f) <= set(mem) for f, mem in zip(flow, members))


def test_overlapping_sources(spark):
    rows = [(i, 10, ["a"] if i < 30 else ["b"] if i < 40 else ["a", "b"] if i < 90 else [] if i < 95 else None) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, n long, s array<string>")
    out = mix(df, "id", "n", "s", {"a": 1, "b": 1}, seed=5).collect()
    target = quotas([800, 600], [1, 1], 1000)
    filled = {"a": 0, "b": 0}
    for pattern in (["a"], ["b"], ["a", "b"]):
        own = [r for r in out if r.s == pattern]
        assert sum(r.taken for r in own) == sum(own[0].filled.values())
        for s, x in own[0].filled.items():
            filled[s] += x
    assert [filled["a"], filled["b"]] == target
    assert all(r.taken == 0 for r in out if not r.s) and all(r.taken <= 30 for r in out)
    again = mix(df.repartition(7), "id", "n", "s", {"a": 1, "b": 1}, seed=5).collect()
    assert {r.id: r.taken for r in again} == {r.id: r.taken for r in out}
    other = mix(df, "id", "n", "s", {"a": 3, "b": 1}, seed=6).collect()
    assert {r.id: r.taken for r in other} != {r.id: r.taken for r in out}
    with pytest.raises(ValueError, match="patterns"):
        mix(df, "id", "n", "s", {"a": 1}, max_patterns=1)


def test_query_edge_cases(spark, folder, nasty):
    rows = [*nasty, *[(i, "w " * (i % 9), None if i % 3 else "src") for i in range(60)]]
    out = QUERIES["op10_mixing"](spark, folder(rows)).collect()
    assert len(out) == len(rows)
    by_source = {}
    for r in out:
        assert 0 <= r.taken <= 3 * r.size and r.target <= 3 * r.source_size
        by_source.setdefault((r.source_size, r.target), []).append(r.taken)
    assert sum(t for _, t in by_source) == pytest.approx(sum(r.size for r in out))
    for (_, target), taken in by_source.items():
        assert sum(taken) == round(target)
    assert QUERIES["op10_mixing"](spark, folder([])).count() == 0
