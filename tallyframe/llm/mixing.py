"""Mixing overlapping sources to target weights by min-cost flow."""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .totals import bucket_count, running


def quotas(sizes: Sequence[int], weights: Sequence[float], total: float | None = None, most: int = 3) -> list[float]:
    """Shares of ``total`` (default: all sizes) by weight; none above ``most`` times its size, the excess
    reshared by weight among the others until none is above."""
    caps = [most * int(s) for s in sizes]
    rest = Fraction(sum(sizes) if total is None else total)
    weights = [Fraction(w) for w in weights]
    left, out = set(range(len(sizes))), [Fraction(0)] * len(sizes)
    while left:
        weight = sum(weights[i] for i in left)
        full = {i for i in left if weight == 0 or rest * weights[i] >= caps[i] * weight}
        for i in full or left:
            out[i] = Fraction(caps[i]) if i in full else rest * weights[i] / weight
        if not full:
            break
        rest -= sum(caps[i] for i in full)
        left -= full
    return [float(x) for x in out]


def route(capacity: Sequence[int], members: Sequence[Sequence[int]], wanted: Sequence[int], most: int = 3) -> list[dict[int, int]]:
    """Min-cost flow from patterns through sources to their quotas.

    Pattern p holds ``capacity[p]`` tokens and may feed the sources ``members[p]``; its r-th repetition costs
    r squared a token, at most ``most`` of them.  Source s takes up to ``wanted[s]``.  The result is, per pattern,
    {source: tokens}: as much of the quotas as can be met, and of all such flows one of the least total cost.
    Successive cheapest paths; the graph has one node per pattern and source, not per document.
    """
    n, m = len(capacity), len(wanted)
    sink, size = n + m, n + m + 1
    edges: list[list[int]] = [[] for _ in range(size + 1)]  # of node: numbers of edges; edge: to, room, cost
    to: list[int] = []
    room: list[int] = []
    cost: list[int] = []

    def edge(a: int, b: int, most_flow: int, price: int) -> int:
        for x, y, c, p in ((a, b, most_flow, price), (b, a, 0, -price)):
            edges[x].append(len(to))
            to.append(y), room.append(c), cost.append(p)
        return len(to) - 2

    start, feed = size, {}
    for p in range(n):
        for r in range(1, most + 1):
            edge(start, p, int(capacity[p]), r * r)
        for s in members[p]:
            feed[p, s] = edge(p, n + s, most * int(capacity[p]), 0)
    for s in range(m):
        edge(n + s, sink, int(wanted[s]), 0)

    potential = [0] * (size + 1)
    while True:
        far: list[float] = [float("inf")] * (size + 1)
        via = [-1] * (size + 1)
        far[start], queue = 0, [(0, start)]
        while queue:
            d, x = heapq.heappop(queue)
            if d > far[x]:
                continue
            for e in edges[x]:
                if room[e] and (nd := d + cost[e] + potential[x] - potential[to[e]]) < far[to[e]]:
                    far[to[e]], via[to[e]] = nd, e
                    heapq.heappush(queue, (nd, to[e]))
        if far[sink] == float("inf"):
            break
        for x in range(size + 1):
            if far[x] < float("inf"):
                potential[x] += int(far[x])
        path, x = [], sink
        while x != start:
            path.append(via[x])
            x = to[via[x] ^ 1]
        flow = min(room[e] for e in path)
        for e in path:
            room[e] -= flow
            room[e ^ 1] += flow
    out: list[dict[int, int]] = [{} for _ in range(n)]
    for (p, s), e in feed.items():
        if room[e ^ 1]:
            out[p][s] = room[e ^ 1]
    return out


def place(key: str, seed: int) -> Column:
    """A document's place in the seeded order, in [0, 1): the first 52 bits of an MD5."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("\x00null")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def mix(df: DataFrame, key: str, size: str, sources: str, weights: dict[str | None, float], seed: int = 0, most: int = 3, total: float | None = None, max_patterns: int = 20_000) -> DataFrame:
    """Choose how many tokens of each document the mix takes, so that sources meet their targets.

    ``sources`` is an array column: the sources that a document belongs to (NULL inside the array is a source,
    a NULL or empty array means the document can't be taken).  ``size`` is its tokens (NULL or below 0: none).
    Documents are summed by membership pattern; a min-cost flow routes pattern capacity to the quotas, where the
    r-th repetition costs more than the one before; inside a pattern, documents are taken in seeded order.

    Adds ``taken`` (tokens, repeats counted: whole repeats, and one document per pattern in part, so that the
    total is the flow exactly) and ``filled``, {source: tokens} of the document's whole pattern.  More than
    ``max_patterns`` patterns are an error: the flow runs on the driver and its graph has a node for each.
    Repeated rows count each; an empty table stays empty.
    """
    tokens = F.greatest(F.coalesce(F.col(size).cast("long"), F.lit(0)), F.lit(0))
    member = F.array_sort(F.array_distinct(F.transform(F.coalesce(F.col(sources), F.array()), lambda s: F.coalesce(F.concat(F.lit("="), s.cast("string")), F.lit("~")))))
    own = df.drop("taken", "filled").withColumns({"__tokens": tokens, "__pattern": F.concat_ws("\x00", member)})
    found = own.groupBy("__pattern").agg(F.sum("__tokens").alias("tokens"), F.count(F.lit(1)).alias("n")).orderBy("__pattern").limit(max_patterns + 1).collect()
    if len(found) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns")
    coded = {("~" if s is None else f"={s}"): w for s, w in weights.items()}
    names = list(coded)
    members = [[names.index(s) for s in r["__pattern"].split("\x00") if s in coded] for r in found]
    held = [sum(r["tokens"] for r, mem in zip(found, members) if s in mem) for s in range(len(names))]
    everything = sum(r["tokens"] for r in found)
    targets = quotas(held, list(coded.values()), everything if total is None else total, most)
    flows = route([r["tokens"] for r in found], members, [round(t) for t in targets], most)

    entries, spark = [], df.sparkSession
    for r, flow in zip(found, flows):
        whole, part = divmod(sum(flow.values()), r["tokens"]) if r["tokens"] else (0, 0)
        entries.append((r["__pattern"], whole, part, {names[s][1:] if names[s] != "~" else "\x00null": f for s, f in flow.items()}))
    plan = spark.createDataFrame(entries, "pattern string, whole long, part long, filled map<string,long>")
    n_rows = sum(r["n"] for r in found)
    ordered = running(own, ["__pattern"], place(key, seed), [F.col(key), F.col("__tokens")], F.col("__tokens"), bucket_count(n_rows), "__before")
    extra = F.least(F.greatest(F.col("part") - F.col("__before"), F.lit(0)), F.col("__tokens"))
    joined = ordered.join(F.broadcast(plan), ordered["__pattern"] == plan["pattern"])  # at most max_patterns rows
    return joined.withColumn("taken", F.col("whole") * F.col("__tokens") + extra).select(*[c for c in df.columns if c not in ("taken", "filled")], "taken", "filled")
