"""Random forests and extremely randomised trees without a depth limit.

Trees grow in two phases.  While a node has many rows, its split comes from sums over the whole table, level by level:
one pass gives the classes and the range of every feature per node, one the classes on both sides of the candidate cuts.
The rows of a smaller node then go to one task, which finishes the subtree.  Trees whose root is small share their rows
in bundles; so do all trees of a table that one task holds whole in codes (``WHOLE`` bytes, see ``coded``), where the task
itself takes the large nodes' splits from sums, by the same cuts.  Finished subtrees are rows of a table; the driver holds only nodes of the first phase, whose number is bounded.

Every draw is a hash of the seed, the tree and the node or row, so trees depend on neither partitioning nor retries.  With
``folds``, one forest per fold grows in the same passes, on the rows of the other folds.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed, Param, Params, TypeConverters
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.bounded import join_lookup
from ..session import durable
from .coded import Coded, Coding, coding
from .moments import class_labels, feature_array, width

SMALL = 50_000  # rows of a node that one task finishes, and of a block that one task scores
MOST_OPEN = 20_000  # nodes of the first phase at a time; more trees wait
MOST_NODES = 2_000_000  # nodes of the first phase in all, which the driver holds
STEPS = 64  # cuts tried per feature in the first phase: equal steps of the node's range
BUNDLES = 32
WHOLE = 1 << 28  # bytes that a task holds of a table whose trees grow from their roots in tasks; a copy goes to each bundle
ALONE = 1 << 12  # rows of a node whose sums are taken for itself; nodes of fewer rows share arrays
BLOCK_ROWS, BLOCK_BYTES = 1 << 16, 1 << 25  # rows, and bytes of their features, that a task looks at together
FEW_PARTS, MOST_PARTS, PART_ROWS = 64, 4096, 25_000  # partitions that units of work are dealt to, and rows of one
LEAF, DEALT = -1, -2  # in place of a feature
ARROW = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<double>": pa.list_(pa.float64())}

# The Poisson distribution of mean 1, how often a row is drawn into a tree.
POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(20)])


def scramble(h: np.ndarray | int) -> np.ndarray:
    """Spread 64-bit numbers over all bits."""
    h = np.atleast_1d(np.asarray(h, np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def uniform(h: np.ndarray) -> np.ndarray:
    return (scramble(h) >> np.uint64(11)).astype(np.float64) * 2.0**-53


def root_of(seed: int, tree: int) -> np.uint64:
    return scramble(scramble(seed)[0] ^ np.uint64(tree + 1))[0]


def children_of(nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return scramble(nodes ^ np.uint64(0xA5A5)), scramble(nodes ^ np.uint64(0x5A5A))


def feature_draws(nodes: np.ndarray, d: int) -> np.ndarray:
    """One number per node and feature; a node tries its non-constant features in the order of these."""
    return scramble(nodes[:, None] ^ (np.arange(1, d + 1, dtype=np.uint64) << np.uint64(20)))


def random_cuts(draws: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """A cut in [low, high) from each draw."""
    cut = low + uniform(draws) * (high - low)
    return np.where(cut < high, cut, low)


def row_weights(hashes: np.ndarray, fold: np.ndarray, tree: int, spec: dict) -> np.ndarray:
    """How often each row counts in a tree: drawn with replacement, or once; never in the forest of its own fold."""
    if spec["extra"]:
        weight = np.ones(len(hashes))
    else:
        weight = np.searchsorted(POISSON, uniform(hashes ^ root_of(spec["seed"], tree)), side="right").astype(float)
    return np.where(fold == tree // spec["trees"], 0.0, weight) if spec["folds"] else weight


def candidates(nodes: np.ndarray, low: np.ndarray, high: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """The first m non-constant features of every node in its order, -1 where there are fewer, and their draws."""
    draws = feature_draws(nodes, low.shape[1])
    order = np.lexsort((draws, low >= high))[:, :m] if low.shape[1] else np.empty((len(nodes), 0), int)
    rows = np.arange(len(nodes))[:, None]
    return np.where((low < high)[rows, order], order, -1), draws[rows, order]


def purity(counts: np.ndarray) -> np.ndarray:
    """Sum of squared class weights over the weight; what a split raises is the impurity it removes."""
    total = counts.sum(axis=-1)
    return (counts**2).sum(axis=-1) / np.where(total > 0, total, 1)


class Tree:
    """Nodes in the order they were made; the right child stands after the left one."""

    def __init__(self, root: np.uint64, n_classes: int):
        self.ids, self.feature, self.cut, self.left, self.value, self.gain = [np.uint64(root)], [LEAF], [0.0], [0], [np.zeros(n_classes)], [0.0]

    def split(self, at: int, feature: int, cut: float, gain: float) -> int:
        """Make two children; returns the place of the left one."""
        self.feature[at], self.cut[at], self.gain[at], self.left[at] = feature, cut, gain, len(self.ids)
        for side in children_of(np.array([self.ids[at]], np.uint64)):
            self.ids.append(side[0])
            for column, empty in ((self.feature, LEAF), (self.cut, 0.0), (self.left, 0), (self.gain, 0.0)):
                column.append(empty)
            self.value.append(np.zeros_like(self.value[0]))
        return self.left[at]

    def arrays(self) -> dict[str, np.ndarray]:
        return {
            "feature": np.array(self.feature, np.int32), "cut": np.array(self.cut), "left": np.array(self.left, np.int32),
            "value": np.array(self.value), "gain": np.array(self.gain),
        }


def leaves(tree: dict[str, np.ndarray], x: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
    """The place of the node where each row ends, or each of some rows."""
    rows = np.arange(len(x)) if rows is None else rows
    at, moving = np.zeros(len(rows), np.int64), np.arange(len(rows))
    while len(moving):
        f = tree["feature"][at[moving]]
        moving, f = moving[f >= 0], f[f >= 0]
        here = at[moving]
        at[moving] = tree["left"][here] + (x[rows[moving], f] > tree["cut"][here])
    return at


class Columns:
    """The features of some rows one after the other, and of every value its rank in its feature (equal values share one)."""

    def __init__(self, x: np.ndarray, ranks: bool | np.ndarray):
        self.n, self.x, self.ranks = len(x), np.ascontiguousarray(x.T).ravel(), None
        self.gaps = bool(np.isnan(self.x).any())
        if isinstance(ranks, np.ndarray):  # known, by feature
            self.ranks = ranks.ravel()
        elif ranks:
            self.ranks = np.empty(x.shape[::-1], np.int32)
            for rank, column in zip(self.ranks, self.x.reshape(x.shape[::-1])):
                order = np.argsort(column)
                inside = column[order]
                rank[order] = np.cumsum(np.append(False, inside[1:] > inside[:-1])[: len(inside)])
            self.ranks = self.ranks.ravel()


def grow(
    root: np.uint64 | np.ndarray, x: np.ndarray | Columns, y: np.ndarray, w: np.ndarray, spec: dict, seg: np.ndarray | None = None
) -> dict[str, np.ndarray]:
    """The whole subtree under a node from all its rows, level by level over all open nodes at once.

    A node looks at its features in the order of their draws until it has tried as many as it should that are not constant.
    Of more than ``small`` rows it tries equal steps of each feature's range, as in the first phase.  With ``seg``, the place of
    each row's node in ``root``, the subtrees of several nodes grow side by side; their roots come first.
    """
    x = x if isinstance(x, Columns) else Columns(x, not spec["extra"])
    k, m, d = spec["classes"], spec["m"], spec["d"]
    rows, ids = np.flatnonzero(w > 0), np.atleast_1d(np.asarray(root, np.uint64))
    made = len(ids)
    seg = np.zeros(len(rows), np.int64) if seg is None else seg[rows]  # of each row the place of its node in ids
    levels = []
    while len(ids):
        n = len(ids)
        if n > 1:
            order = np.argsort(seg.astype(np.uint16) if n <= 1 << 16 else seg, kind="stable")
            rows, seg = rows[order], seg[order]
        totals = np.bincount(seg * k + y[rows], weights=w[rows], minlength=n * k).reshape(n, k)
        sizes = np.bincount(seg, minlength=n)
        best, feature, cut = np.full(n, -np.inf), np.full(n, -1), np.zeros(n)
        looking = np.flatnonzero((totals > 0).sum(axis=1) > 1)  # nodes that still look for features
        draws = feature_draws(ids[looking], d)
        wanted = np.argsort(draws, axis=1)
        left_to_try, r, s = np.full(len(looking), m), rows, np.full(n, -1)
        s[looking] = np.arange(len(looking))
        s = s[seg]
        if len(looking) < n:
            r, s = r[s >= 0], s[s >= 0]
        for place in range(d):
            if not len(looking):
                break
            f = wanted[:, place]
            at = f[s] * x.n + r
            v = x.x[at] if spec["extra"] else x.ranks[at]
            starts = np.searchsorted(s, np.arange(len(looking)))
            low, high = np.minimum.reduceat(v, starts), np.maximum.reduceat(v, starts)
            use = taken = low < high
            if x.gaps:  # a feature with a missing number counts as tried, but its ranks say nothing
                missing = np.isnan(np.maximum.reduceat(x.x[at], starts))
                use, taken = use & ~missing, taken | missing
            if use.any():
                nodes = looking[use]
                if use.all():
                    ru, su, vu, low_u, high_u, d_u = r, s, v, low, high, draws[np.arange(len(f)), f]
                else:
                    on = use[s]
                    ru, su, vu, low_u, high_u, d_u = r[on], (np.cumsum(use) - 1)[s[on]], v[on], low[use], high[use], draws[use, f[use]]
                if spec["extra"]:
                    cuts = random_cuts(d_u, low_u, high_u)
                    side = vu <= cuts[su]
                    below = np.bincount((su * k + y[ru])[side], weights=w[ru[side]], minlength=len(nodes) * k).reshape(-1, k)
                    score = purity(below) + purity(totals[nodes] - below)
                else:
                    score, cuts, few = np.empty(len(nodes)), np.empty(len(nodes)), np.ones(len(nodes), bool)
                    for i in np.flatnonzero(sizes[nodes] > spec.get("small", SMALL)):
                        few[i], on = False, ru[slice(*np.searchsorted(su, [i, i + 1]))]
                        score[i], cuts[i] = _best_step(x.x[f[use][i] * x.n + on], y[on], w[on], totals[nodes[i]])
                    if few.any():
                        if not few.all():
                            on = few[su]
                            ru, su, vu = ru[on], (np.cumsum(few) - 1)[su[on]], vu[on]
                        own = f[use][few] * x.n
                        score[few], lower, upper = _best_cuts(vu, su, y[ru], w[ru], totals[nodes[few]])
                        v0, v1 = x.x[own + ru[lower]], x.x[own + ru[upper]]
                        middle = (v0 + v1) / 2
                        cuts[few] = np.where(middle < v1, middle, v0)
                better = score > best[nodes]
                best[nodes[better]], feature[nodes[better]], cut[nodes[better]] = score[better], f[use][better], cuts[better]
            left_to_try -= taken
            if not left_to_try.all():
                go = left_to_try > 0
                on = go[s]
                r, s = r[on], (np.cumsum(go) - 1)[s[on]]
                looking, draws, wanted, left_to_try = looking[go], draws[go], wanted[go], left_to_try[go]
        split = np.flatnonzero(feature >= 0)
        left, gain = np.zeros(n, np.int32), np.zeros(n)
        left[split] = made + 2 * np.arange(len(split))
        gain[split] = best[split] - purity(totals[split])
        levels.append((feature.astype(np.int32), cut, left, totals, gain))
        made += 2 * len(split)
        stay = feature[seg] >= 0
        rows, seg = rows[stay], seg[stay]
        where = np.zeros(n, np.int64)
        where[split] = 2 * np.arange(len(split))
        seg = where[seg] + (x.x[feature[seg] * x.n + rows] > cut[seg])
        ids = np.stack(children_of(ids[split]), axis=1).ravel() if len(split) else ids[:0]
    return dict(zip(("feature", "cut", "left", "value", "gain"), (np.concatenate(a) for a in zip(*levels))))


def _in_order(*keys: np.ndarray) -> np.ndarray:
    """The places of rows sorted by whole numbers from 0, the first one first; ties keep their order."""
    held, bits = np.zeros(len(keys[0]), np.int64), 0
    last = np.arange(len(held))
    for key in (*keys, last):
        width = int(key.max()).bit_length()
        bits += width
        if bits > 63:
            return np.lexsort(keys[::-1])
        held = (held << width) | key
    held.sort()
    return held & ((1 << int(last[-1]).bit_length()) - 1)


def _best_cuts(v: np.ndarray, s: np.ndarray, y: np.ndarray, w: np.ndarray, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every node the score of the best cut between two neighbouring ranks of its feature (the first of equals), and the
    places of a row on either side of it.  Every node has two ranks at least.

    With l of a class before a row and t of it in the node, the squares before the cut grow by w (2 l + w), those after it
    shrink by w (2 (t - l) - w).  Weights are whole, so all sums are exact.
    """
    n, k = totals.shape
    order = _in_order(s, v)
    v, s, y, w = v[order], s[order], y[order], w[order]
    group = s * k + y
    by_class = _in_order(group)
    own = w[by_class]
    upto = np.cumsum(own)
    first = np.flatnonzero(np.append(True, np.diff(group[by_class]) > 0))
    before = np.empty(len(v))
    before[by_class] = upto - own - np.repeat((upto - own)[first], np.diff(np.append(first, len(v))))
    starts = np.searchsorted(s, np.arange(n))
    border = np.flatnonzero((s[1:] == s[:-1]) & (v[1:] > v[:-1]))
    node = s[border]

    def inside(each: np.ndarray) -> np.ndarray:
        sums = np.cumsum(each)
        return sums[border] - np.append(0.0, sums)[starts][node]

    weight, squares, crossed = inside(w), inside(w * (2 * before + w)), inside(w * totals.ravel()[group])
    whole, whole_squares = totals.sum(axis=1)[node], (totals**2).sum(axis=1)[node]
    score = np.round(squares / weight + (whole_squares - 2 * crossed + squares) / (whole - weight), 9)
    starts = np.searchsorted(node, np.arange(n))
    top = np.maximum.reduceat(score, starts)
    hits = np.flatnonzero(score == top[node])
    at = border[hits[np.searchsorted(node[hits], np.arange(n))]]
    return top, order[at], order[at + 1]


def _steps(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The cuts that a large node tries: equal steps of the range, below its end."""
    cuts = low[:, None] + (high - low)[:, None] * np.arange(1, STEPS) / STEPS
    return np.minimum(cuts, np.nextafter(high, low)[:, None])


def _best_step(v: np.ndarray, y: np.ndarray, w: np.ndarray, totals: np.ndarray) -> tuple[float, float]:
    """The score and the place of the best cut of a large node (the first of equals)."""
    cuts, k = _steps(v.min(keepdims=True), v.max(keepdims=True))[0], len(totals)
    side = np.searchsorted(cuts, v)  # cuts below the value: 0 is the far left
    return _first_step(cuts, np.bincount(side * k + y, weights=w, minlength=STEPS * k).reshape(STEPS, k), totals)


def _first_step(cuts: np.ndarray, sides: np.ndarray, totals: np.ndarray) -> tuple[float, float]:
    """The score and the place of the best of some cuts (the first of equals), from the class weights between them."""
    below = np.cumsum(sides, axis=0)[:-1]
    score = np.round(purity(below) + purity(totals - below), 9)
    score[(below.sum(axis=1) <= 0) | ((totals - below).sum(axis=1) <= 0)] = -np.inf
    at = int(score.argmax())
    return float(score[at]), float(cuts[at])


# ---------------------------------------------------------------- whole trees of a table in codes


def _cut_of_sums(f: int, sums: np.ndarray, values: np.ndarray, draw: np.ndarray, totals: np.ndarray, large: bool, spec: dict) -> tuple[float, float]:
    """The score and the place of the cut of a node at a feature, from the class weights of the values that it has."""
    low, high = values[:1], values[-1:]
    if spec["extra"]:
        cut = random_cuts(draw, low, high)
        below = sums[values <= cut].sum(axis=0)
        return float(purity(below) + purity(totals - below)), float(cut[0])
    if large:
        cuts, sides = _steps(low, high)[0], np.zeros((STEPS, len(totals)))
        np.add.at(sides, np.searchsorted(cuts, values), sums)
        return _first_step(cuts, sides, totals)
    below = np.cumsum(sums, axis=0)[:-1]  # the sums of squares as in _best_cuts, so that rounding is the same
    weight, squares, crossed = below.sum(axis=1), (below**2).sum(axis=1), (below * totals).sum(axis=1)
    score = np.round(squares / weight + ((totals**2).sum() - 2 * crossed + squares) / (totals.sum() - weight), 9)
    at = int(score.argmax())
    middle = (values[at] + values[at + 1]) / 2
    return float(score[at]), float(middle if middle < values[at + 1] else values[at])


def _split_alone(x: Coded, rows: np.ndarray, w: np.ndarray | None, totals: np.ndarray, node: np.uint64, live: np.ndarray, spec: dict) -> tuple[int, float, float]:
    """Feature (-1 for none), cut and score of one node; features that are constant in it are no longer ``live``."""
    draws = feature_draws(np.array([node], np.uint64), spec["d"])[0]
    best, left_to_try, large, k = (-1, 0.0, -np.inf), spec["m"], len(rows) > spec["small"], spec["classes"]
    for f in np.argsort(draws):
        if not live[f]:
            continue
        values, draw = x.values[f], draws[f : f + 1]
        if len(values) * k <= 4 * len(rows):
            sums = x.sums(f, rows, w)
            here = np.flatnonzero(sums.any(axis=1))
            if len(here) < 2:
                live[f] = False
                continue
            score, cut = _cut_of_sums(f, sums[here], values[here], draw, totals, large, spec)
        else:  # more values than rows: the rows themselves, in order of their values where all of these are tried
            v, y, own = x.ranks(f, rows), x.y.take(rows).astype(np.int64), np.ones(len(rows)) if w is None else w
            low, high = values[v.min(keepdims=True)], values[v.max(keepdims=True)]
            if low >= high:
                live[f] = False
                continue
            if spec["extra"]:
                cut = float(random_cuts(draw, low, high)[0])
                side = values[v] <= cut
                below = np.bincount(y[side], weights=own[side], minlength=k)
                score = float(purity(below) + purity(totals - below))
            elif large:
                score, cut = _best_step(values[v], y, own, totals)
            else:
                top, lower, upper = _best_cuts(v, np.zeros(len(v), np.int64), y, own, totals[None])
                v0, v1 = values[v[lower[0]]], values[v[upper[0]]]
                score, cut = float(top[0]), float((v0 + v1) / 2 if (v0 + v1) / 2 < v1 else v0)
        if score > best[2]:
            best = (int(f), cut, score)
        left_to_try -= 1
        if not left_to_try:
            break
    return best


def grow_coded(root: np.uint64, x: Coded, w: np.ndarray, spec: dict) -> dict[str, np.ndarray]:
    """The tree that ``grow`` gives, of a table too large for arrays of all its rows and features at every level.

    Nodes of more than ``ALONE`` rows are split one after the other by sums per value; the others are decoded, about
    ``BLOCK_ROWS`` rows at a time, and grow side by side.
    """
    k, d = spec["classes"], spec["d"]
    rows = np.flatnonzero(w > 0)
    w = None if spec["extra"] else w[rows]
    top, few = Tree(root, k), []
    totals = np.bincount(x.y.take(rows), weights=w, minlength=k).astype(float)
    jobs = [(0, rows, w, totals, np.ones(d, bool))]
    del rows, w
    while jobs:
        at, rows, w, totals, live = jobs.pop()
        top.value[at] = totals
        if (totals > 0).sum() < 2:
            continue
        if len(rows) <= ALONE:
            few.append((at, rows, w))
            continue
        live = live.copy()
        f, cut, score = _split_alone(x, rows, w, totals, top.ids[at], live, spec)
        if f < 0:
            continue
        left = top.split(at, f, cut, score - purity(totals))
        above = x.above(f, cut, rows)
        for place, side in ((left, ~above), (left + 1, above)):
            mine, own = rows[side], None if w is None else w[side]
            jobs.append((place, mine, own, np.bincount(x.y.take(mine), weights=own, minlength=k).astype(float), live))
        del rows, w, above, side, mine, own
    parts, made = [top.arrays()], len(top.ids)
    while few:
        group, size = [], 0
        while few and (not group or size + len(few[-1][1]) <= BLOCK_ROWS):
            group.append(few.pop())
            size += len(group[-1][1])
        at, rows = np.array([g[0] for g in group]), np.concatenate([g[1] for g in group])
        own = np.ones(size) if spec["extra"] else np.concatenate([g[2] for g in group])
        ranks, values = np.empty((d, size), np.int32), np.empty((d, size))
        for f in range(d):
            ranks[f] = x.ranks(f, rows)
            values[f] = x.values[f].take(ranks[f])
        columns = Columns(values.T, False if spec["extra"] else ranks)
        below = grow(np.array(top.ids, np.uint64)[at], columns, x.y.take(rows).astype(np.int64), own, spec, np.repeat(np.arange(len(group)), [len(g[1]) for g in group]))
        below["left"] = np.where(below["feature"] >= 0, below["left"] + np.int32(made - len(group)), 0).astype(np.int32)
        for name, column in below.items():
            parts[0][name][at] = column[: len(group)]
        parts.append({name: column[len(group) :] for name, column in below.items()})
        made += len(parts[-1]["cut"])
    return _by_level({name: np.concatenate([p[name] for p in parts]) for name in parts[0]})


def _by_level(tree: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The same tree with its nodes in the order in which ``grow`` makes them."""
    order, level = [], np.zeros(1, np.int64)
    while len(level):
        order.append(level)
        left = tree["left"][level[tree["feature"][level] >= 0]].astype(np.int64)
        level = np.stack([left, left + 1], axis=1).ravel()
    order = np.concatenate(order)
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    tree = {name: column[order] for name, column in tree.items()}
    return tree | {"left": np.where(tree["feature"] >= 0, place[tree["left"]], 0).astype(np.int32)}


# ---------------------------------------------------------------- first phase: sums over the table


def _numbers(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return column.to_numpy() if isinstance(column, pa.ChunkedArray) else column.to_numpy(zero_copy_only=False)


def _blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows with features ``x`` in tables of bounded size, each with its feature matrix."""
    most, held, n = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * max(d, 1)))), [], 0

    def block() -> tuple[pa.Table, np.ndarray]:
        table = pa.Table.from_batches(held)
        values = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in table["x"].chunks])
        return table, values.reshape(n, d).astype(np.float64, copy=False)

    for batch in batches:
        for start in range(0, batch.num_rows, most):
            held.append(batch.slice(start, most))
            n += held[-1].num_rows
            if n >= most:
                yield block()
                held, n = [], 0
    if n:
        yield block()


def _packed(x: np.ndarray) -> pa.Array:
    """Feature rows as bytes; in half of them where single precision loses nothing."""
    half = x.astype(np.float32)
    x = half if np.array_equal(half, x, equal_nan=True) else x
    ends = np.arange(len(x) + 1, dtype=np.int32) * (x.shape[1] * x.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(x))])


def _unpacked(column: pa.ChunkedArray, d: int) -> np.ndarray:
    out, at = np.empty((len(column), d)), 0
    for chunk in column.chunks:
        rows = chunk.to_pylist()
        half = np.fromiter(map(len, rows), np.int64, len(rows)) == 4 * d
        mine = out[at : at + len(rows)]
        mine[half] = np.frombuffer(b"".join(r for r, h in zip(rows, half) if h), np.float32).reshape(-1, d)
        mine[~half] = np.frombuffer(b"".join(r for r, h in zip(rows, half) if not h), np.float64).reshape(-1, d)
        at += len(rows)
    return out


def _per_node(rows: DataFrame, tops: dict[int, dict[str, np.ndarray]], spec: dict, add, finish, schema: str) -> DataFrame:
    """Fold the rows of every open node (feature DEALT, gain 1) of every tree in each task: rows of ``schema``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], object] = {}
        for block, x in _blocks(batches, spec["d"]):
            y, h, fold = _numbers(block["y"]), _numbers(block["h"]).view(np.uint64), _numbers(block["fold"])
            for tree, top in tops.items():
                w = row_weights(h, fold, tree, spec)
                use = np.flatnonzero(w > 0)
                at = leaves(top, x, use)
                on = top["gain"][at] > 0
                use, at = use[on], at[on]
                order = np.argsort(at.astype(np.uint16) if len(top["gain"]) <= 1 << 16 else at, kind="stable")
                use, at = use[order], at[order]
                ends = np.append(np.flatnonzero(np.diff(at)) + 1, len(at))
                for start, end in zip(np.append(0, ends), ends) if len(use) else ():
                    key, part = (tree, int(at[start])), use[start:end]
                    held[key] = add(held.get(key), key, x[part], y[part], w[part])
        if held:
            columns = zip(*[(*key, *finish(value)) for key, value in held.items()])
            fields = [c.split() for c in schema.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, ARROW[kind]) for c, (_, kind) in zip(columns, fields)], [name for name, _ in fields])

    return rows.mapInArrow(run, schema)


def _open_view(trees: dict[int, Tree], open_nodes: dict[int, list[int]]) -> dict[int, dict[str, np.ndarray]]:
    views = {}
    for t, nodes in open_nodes.items():
        if nodes:
            views[t] = trees[t].arrays()
            views[t]["gain"] = np.zeros(len(trees[t].ids))
            views[t]["gain"][nodes] = 1.0
    return views


def _grow_tops(rows: DataFrame, numbers: list[int], spec: dict, small: int) -> dict[int, Tree]:
    """First phase of some trees: nodes of more than ``small`` rows are split; smaller ones are marked as dealt."""
    d, k, m = spec["d"], spec["classes"], spec["m"]
    steps = 2 if spec["extra"] else STEPS
    trees = {t: Tree(root_of(spec["seed"], t), k) for t in numbers}
    open_nodes = {t: [0] for t in numbers}
    while any(open_nodes.values()):

        def add_range(old, key, x, y, w):
            now = (np.bincount(y, weights=w, minlength=k), x.min(axis=0), x.max(axis=0), len(x))
            return now if old is None else (old[0] + now[0], np.minimum(old[1], now[1]), np.maximum(old[2], now[2]), old[3] + now[3])

        ranges = _per_node(rows, _open_view(trees, open_nodes), spec, add_range, lambda v: v, "tree int, node int, counts array<double>, low array<double>, high array<double>, n long")
        vectors = [array_to_vector(c).alias(c) for c in ("counts", "low", "high")]
        found = ranges.select("tree", "node", *vectors, "n").groupBy("tree", "node").agg(
            Summarizer.sum(F.col("counts")).alias("counts"), Summarizer.min(F.col("low")).alias("low"), Summarizer.max(F.col("high")).alias("high"), F.sum("n").alias("n")
        ).collect()
        tried: dict[tuple[int, int], tuple] = {}
        next_open: dict[int, list[int]] = {t: [] for t in numbers}
        for r in found:
            tree, counts, low, high = trees[r["tree"]], r["counts"].toArray(), r["low"].toArray()[None], r["high"].toArray()[None]
            tree.value[r["node"]] = counts
            features, draws = candidates(np.array([tree.ids[r["node"]]], np.uint64), low, high, m)
            if (counts > 0).sum() < 2 or (features < 0).all():
                continue
            if r["n"] <= small:
                tree.feature[r["node"]] = DEALT
                continue
            f = features[0][features[0] >= 0]
            lo, hi = low[0, f], high[0, f]
            cuts = random_cuts(draws[0][features[0] >= 0], lo, hi)[:, None] if spec["extra"] else _steps(lo, hi)
            tried[r["tree"], r["node"]] = (f, cuts, counts)
        if not tried:
            break
        shared = {key: (f, cuts) for key, (f, cuts, _) in tried.items()}

        def add_sides(old, key, x, y, w):
            f, cuts = shared[key]
            out = np.zeros((len(f), steps, k)) if old is None else old
            for j in range(len(f)):
                side = np.searchsorted(cuts[j], x[:, f[j]])  # cuts below the value: 0 is the far left
                out[j] += np.bincount(side * k + y, weights=w, minlength=steps * k).reshape(steps, k)
            return out

        sides = _per_node(rows, _open_view(trees, {t: [n for a, n in tried if a == t] for t in numbers}), spec, add_sides, lambda v: (v.ravel(),), "tree int, node int, counts array<double>")
        summed = sides.select("tree", "node", array_to_vector("counts").alias("counts")).groupBy("tree", "node").agg(Summarizer.sum(F.col("counts")).alias("counts")).collect()
        for r in sorted(summed, key=lambda r: (r["tree"], r["node"])):
            f, cuts, counts = tried[r["tree"], r["node"]]
            below = np.cumsum(r["counts"].toArray().reshape(len(f), steps, k), axis=1)[:, :-1]
            score = np.round(purity(below) + purity(counts - below), 9) if not spec["extra"] else purity(below) + purity(counts - below)
            score[(below.sum(axis=2) <= 0) | ((counts - below).sum(axis=2) <= 0)] = -np.inf
            j, step = np.unravel_index(int(score.argmax()), score.shape)
            left = trees[r["tree"]].split(r["node"], int(f[j]), float(cuts[j, step]), float(score[j, step] - purity(counts)))
            next_open[r["tree"]] += [left, left + 1]
        open_nodes = next_open
    return trees


# ---------------------------------------------------------------- second phase: subtrees in tasks

SUBTREES = "unit string, tree int, start int, feature binary, cut binary, left binary, value binary, gain binary"
TYPES = {"feature": np.int32, "cut": np.float64, "left": np.int32, "value": np.float64, "gain": np.float64}


def read_tree(record, n_classes: int) -> dict[str, np.ndarray]:
    out = {name: np.frombuffer(record[name], kind) for name, kind in TYPES.items()}
    return out | {"value": out["value"].reshape(-1, n_classes)}


def _in_parts(rows: DataFrame, units: int, copies: int, *by: str) -> DataFrame:
    """Units of work on so many rows, dealt to partitions that adaptive execution leaves apart however few bytes they have."""
    return rows.repartition(max(1, min(2 * units, max(FEW_PARTS, min(copies // PART_ROWS, MOST_PARTS)))), *by)


def _subtrees(rows: DataFrame, tops: dict[int, Tree], n: int, spec: dict) -> DataFrame:
    """One row per finished subtree.  Trees whose root is dealt come in bundles of one copy of the rows."""
    whole = [t for t, tree in tops.items() if tree.feature[0] == DEALT]
    deep = {t: tree.arrays() for t, tree in tops.items() if tree.feature[0] >= 0}
    fields = [c.split() for c in "unit string, tree int, start int, h long, x binary, y int, fold int".split(", ")]
    bundles = min(BUNDLES, len(whole))

    def sent(block: pa.Table, x: pa.Array, unit: pa.Array, tree: int, start: np.ndarray) -> Iterator[pa.RecordBatch]:
        tree = pa.array(np.full(len(start), tree, np.int32))
        columns = [unit, tree, pa.array(start.astype(np.int32)), block["h"], x, block["y"], block["fold"]]
        yield from pa.table([pa.chunked_array([c]) if isinstance(c, pa.Array) else c for c in columns], [name for name, _ in fields]).combine_chunks().to_batches()

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, x in _blocks(batches, spec["d"]):
            h, fold = _numbers(block["h"]).view(np.uint64), _numbers(block["fold"])
            packed = _packed(x)
            for b in range(bundles):
                yield from sent(block, packed, pa.array([f"b{b}"] * len(x)), -1, np.zeros(len(x)))
            for t, top in deep.items():
                use = np.flatnonzero(row_weights(h, fold, t, spec) > 0)
                at = leaves(top, x, use)
                on = top["feature"][at] == DEALT
                use, at = use[on], at[on]
                if len(use):
                    places = pa.array(use)
                    yield from sent(block.select(["h", "y", "fold"]).take(places), packed.take(places), pa.array([f"{t}/{a}" for a in at.tolist()]), t, at)

    ids = {t: np.array(tree.ids, np.uint64) for t, tree in tops.items()}

    def finish(group: pa.Table) -> pa.Table:
        y, h, fold = _numbers(group["y"]), _numbers(group["h"]).view(np.uint64), _numbers(group["fold"])
        unit, tree, start = group["unit"][0].as_py(), group["tree"][0].as_py(), group["start"][0].as_py()
        x = Columns(_unpacked(group["x"], spec["d"]), not spec["extra"])
        jobs = [(t, 0) for i, t in enumerate(whole) if i * bundles // len(whole) == int(unit[1:])] if tree < 0 else [(tree, start)]
        out = []
        for t, at in jobs:
            made = grow(ids[t][at], x, y, row_weights(h, fold, t, spec), spec)
            out.append((unit, t, at, *[made[name].astype(kind).tobytes() for name, kind in TYPES.items()]))
        kinds = [c.split() for c in SUBTREES.split(", ")]
        return pa.table([pa.array(c, ARROW[kind]) for c, (_, kind) in zip(zip(*out), kinds)], [name for name, _ in kinds])

    units = bundles + sum(int((top["feature"] == DEALT).sum()) for top in deep.values())
    return _in_parts(rows.mapInArrow(deal, ", ".join(" ".join(f) for f in fields)), units, n * (bundles + len(deep)), "unit").groupBy("unit").applyInArrow(finish, SUBTREES)


def _whole_trees(rows: DataFrame, tops: dict[int, Tree], n: int, code: Coding, spec: dict) -> DataFrame:
    """One row per tree of a table that goes in codes, block by block, to every bundle of trees; a bundle is a partition."""
    kinds = [c.split() for c in SUBTREES.split(", ")]
    numbers = sorted(tops)
    bundles = min(BUNDLES, len(numbers))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, x in _blocks(batches, spec["d"]):
            data = code.pack(_numbers(block["h"]).view(np.uint64), _numbers(block["fold"]), _numbers(block["y"]), x)
            yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["data"])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = []

        def records() -> Iterator[bytes]:
            for batch in batches:
                for i in range(batch.num_rows):
                    bundle[:] = [batch["bundle"][i].as_py()]
                    yield batch["data"][i].as_buffer()

        first = next(came := records(), None)
        if first is None:
            return
        h, fold, x = code.unpack(itertools.chain([first], came), n)
        del first
        for i, t in enumerate(numbers):
            if i * bundles // len(numbers) == bundle[0]:
                w = np.empty(n)
                for at in range(0, n, BLOCK_ROWS):
                    part = slice(at, at + BLOCK_ROWS)
                    w[part] = row_weights(h[part], fold[part], t, spec)
                made = grow_coded(root_of(spec["seed"], t), x, w, spec)
                out = (f"b{bundle[0]}", t, 0, *[made[name].astype(kind).tobytes() for name, kind in TYPES.items()])
                yield pa.RecordBatch.from_arrays([pa.array([c], ARROW[kind]) for c, (_, kind) in zip(out, kinds)], [name for name, _ in kinds])

    copies = F.explode(F.sequence(F.lit(0), F.lit(bundles - 1))).alias("bundle")
    return rows.mapInArrow(pack, "data binary").select(copies, "data").repartitionById(bundles, "bundle").mapInArrow(finish, SUBTREES)


class _Forest(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed):
    trees = Param(Params._dummy(), "trees", "number of trees", TypeConverters.toInt)
    extra = Param(Params._dummy(), "extra", "all rows and one random cut per feature", TypeConverters.toBoolean)
    key = Param(Params._dummy(), "key", "columns that tell rows apart; the features by default", TypeConverters.toListString)
    foldCol = Param(Params._dummy(), "foldCol", "grow one forest per fold, on the rows of all others", TypeConverters.toString)
    small = Param(Params._dummy(), "small", "rows of a node that one task finishes", TypeConverters.toInt)


class Forest(Estimator, _Forest):
    """Trees to the last pure or constant node; each tries the root of the number of features at a node."""

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", trees=150, extra=False, seed=15, key=(), foldCol="", small=SMALL):
        super().__init__()
        self._setDefault(trees=150, extra=False, seed=15, key=[], foldCol="", small=SMALL)
        self._set(**{name: list(v) if isinstance(v, tuple) else v for name, v in self._input_kwargs.items()})

    def _fit(self, dataset: DataFrame) -> ForestModel:
        get = self.getOrDefault
        labels = class_labels(dataset, self.getLabelCol())
        fold = get("foldCol")
        features = feature_array(dataset, self.getFeaturesCol())
        number = F.array_position(F.lit(labels), F.col(self.getLabelCol()).cast("double")) - 1
        own = F.col(fold).cast("int") if fold else F.lit(-1)
        rows = durable(dataset.select(F.xxhash64(*(get("key") or [features])).alias("h"), features.alias("x"), number.cast("int").alias("y"), own.alias("fold")))
        n, folds = rows.agg(F.count("*"), F.max("fold") + 1).first()
        d = width(rows, "x")
        spec = {"seed": get("seed"), "trees": get("trees"), "folds": folds if fold else 0, "extra": get("extra"), "d": d, "m": max(1, math.isqrt(d)), "classes": len(labels)}
        total = get("trees") * (folds if fold else 1)
        small = spec["small"] = max(get("small"), 4 * n * total // MOST_NODES)
        at_once = max(1, min(total, MOST_OPEN * small // max(1, 2 * n)))
        tops: dict[int, Tree] = {}
        parts = []
        alone = n > small and get("small") >= SMALL  # a task may take the sums of large nodes itself, where it can hold the table
        code = coding(rows, d, len(labels), lambda batches: _blocks(batches, d)) if alone else None
        coded = code is not None and n * code.held_bytes <= WHOLE
        if n <= small or coded or (alone and 8 * n * d <= WHOLE // 4 * 3):
            tops = {t: Tree(root_of(spec["seed"], t), len(labels)) for t in range(total)}
            for tree in tops.values():
                tree.feature[0] = DEALT
            parts.append(durable(_whole_trees(rows, tops, n, code, spec) if coded else _subtrees(rows, tops, n, spec)))
        else:
            for start in range(0, total, at_once):
                made = _grow_tops(rows, list(range(start, min(total, start + at_once))), spec, small)
                tops |= made
                parts.append(durable(_subtrees(rows, made, n, spec).withColumn("unit", F.concat(F.lit(f"{start}:"), "unit"))))
        nodes = parts[0]
        for part in parts[1:]:
            nodes = nodes.unionByName(part)
        return ForestModel(nodes, tops, labels, spec)._set(**{p: get(p) for p in ("featuresCol", "predictionCol", "foldCol", "small")})


class ForestModel(Model, _Forest):
    """The finished forest: subtrees as a table, nodes of the first phase here."""

    def __init__(self, nodes: DataFrame, tops: dict[int, Tree], labels: list[float], spec: dict):
        super().__init__()
        self.nodes, self.tops, self.labels, self.spec = nodes, tops, labels, spec
        self.units = {(r["tree"], r["start"]): r["unit"] for r in nodes.select("tree", "start", "unit").collect()}  # as many as dealt nodes

    def votes(self, rows: DataFrame) -> DataFrame:
        """(id, votes): the sum over trees of the class shares in the leaf of each row (id, x, fold).

        Rows meet subtrees by unit; a unit that more rows reach than one task should hold is cut into blocks of rows.
        """
        spec, k, block = self.spec, len(self.labels), self.getOrDefault("small")
        units, small_roots = self.units, sorted({u for (t, _), u in self.units.items() if self.tops[t].feature[0] == DEALT})
        deep = {t: tree.arrays() for t, tree in self.tops.items() if tree.feature[0] != DEALT}
        fields = [c.split() for c in "unit string, tree int, start int, id long, x binary, fold int, vote array<double>".split(", ")]
        own = spec["trees"]
        folds_of = {unit: {t // own for (t, _), u in units.items() if u == unit} for unit in small_roots} if spec["folds"] else {}

        def share(value: np.ndarray) -> np.ndarray:
            return value / np.maximum(value.sum(axis=-1, keepdims=True), 1e-300)

        def lists(value: np.ndarray) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(np.arange(len(value) + 1, dtype=np.int32) * k), pa.array(value.ravel()))

        def sent(n: int, unit, tree: int, start, ids: pa.Array, x: pa.Array | None, fold: pa.Array, vote: pa.Array | None) -> pa.RecordBatch:
            columns = [pa.array(unit, pa.string()), pa.array(np.full(n, tree, np.int32)), pa.array(start, pa.int32()), ids, x, fold, vote]
            return pa.RecordBatch.from_arrays([pa.nulls(n, ARROW[kind]) if c is None else c for c, (_, kind) in zip(columns, fields)], [name for name, _ in fields])

        def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block, x in _blocks(batches, spec["d"]):
                n, fold, packed = len(x), _numbers(block["fold"]), _packed(x)
                ids, folds = (block[name].combine_chunks() for name in ("id", "fold"))
                mine_of = {f: np.flatnonzero(fold == f) for f in range(spec["folds"])}
                for unit in small_roots:
                    if not spec["folds"]:
                        yield sent(n, [unit] * n, -1, np.zeros(n, np.int32), ids, packed, folds, None)
                        continue
                    mine = np.concatenate([mine_of[f] for f in sorted(folds_of[unit])])  # rows of other folds get no votes here
                    if len(mine):
                        there = pa.array(mine)
                        yield sent(len(mine), [unit] * len(mine), -1, np.zeros(len(mine), np.int32), ids.take(there), packed.take(there), folds.take(there), None)
                ended = np.zeros((n, k))  # of all trees whose first phase ends a row
                for t, top in deep.items():
                    mine = mine_of[t // own] if spec["folds"] else np.arange(n)
                    at = leaves(top, x, mine)
                    done = top["feature"][at] == LEAF
                    ended[mine[done]] += share(top["value"][at[done]])
                    if not done.all():
                        moving, at = pa.array(mine[~done]), at[~done]
                        yield sent(len(at), [units[t, a] for a in at.tolist()], t, at.astype(np.int32), ids.take(moving), packed.take(moving), folds.take(moving), None)
                some = np.flatnonzero(ended.sum(axis=1) > 0)
                if len(some):
                    yield sent(len(some), [None] * len(some), -1, np.zeros(len(some), np.int32), ids.take(pa.array(some)), None, folds.take(pa.array(some)), lists(ended[some]))

        went = rows.mapInArrow(visit, ", ".join(" ".join(f) for f in fields))
        went = durable(went) if deep else went
        cuts = went.where("unit is not null").groupBy("unit").agg((F.floor((F.count("*") - 1) / block) + 1).cast("int").alias("blocks"))
        share_of = sum(map(len, folds_of.values())) / spec["folds"] if spec["folds"] else len(small_roots)
        copies = went.count() if deep else int(rows.count() * share_of)
        if not deep:  # all rows visit every unit, or every unit of their fold
            blocks = max(1, -(-copies // max(1, len(small_roots)) // block))
            cuts = self.nodes.select("unit").distinct().withColumn("blocks", F.lit(blocks))
        left = join_lookup(went.where("unit is not null").drop("vote"), cuts, ["unit"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("blocks")))
        right = join_lookup(self.nodes, cuts, ["unit"]).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)))

        def finish(came: pa.Table, trees: pa.Table) -> pa.Table:
            if not len(came) or not len(trees):
                return pa.table({"id": pa.array([], pa.int64()), "vote": pa.array([], ARROW["array<double>"])})
            x, fold, total = _unpacked(came["x"], spec["d"]), _numbers(came["fold"]), np.zeros((len(came), k))
            tree_of, start_of = _numbers(came["tree"]), _numbers(came["start"])
            for record in trees.sort_by([("tree", "ascending"), ("start", "ascending")]).to_pylist():
                tree = read_tree(record, k)
                mine = np.ones(len(came), bool) if not spec["folds"] else fold == record["tree"] // own
                mine &= (tree_of < 0) | ((tree_of == record["tree"]) & (start_of == record["start"]))
                mine = np.flatnonzero(mine)
                total[mine] += share(tree["value"][leaves(tree, x, mine)])
            return pa.table({"id": came["id"].combine_chunks(), "vote": lists(total)})

        parts = len(set(self.units.values())) + copies // block
        left, right = (_in_parts(side, parts, copies, "unit", "part") for side in (left, right))
        both = left.groupBy("unit", "part").cogroup(right.groupBy("unit", "part")).applyInArrow(finish, "id long, vote array<double>")
        if deep:
            both = both.unionByName(went.where("unit is null").select("id", "vote"))
        return both.groupBy("id").agg(F.array(*[F.sum(F.get("vote", F.lit(i))) for i in range(k)]).alias("votes"))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """Add the class with the largest share of votes, the lowest of equals; rows keep their other columns."""
        fold = self.getOrDefault("foldCol")
        numbered = durable(dataset.withColumn("__id", F.monotonically_increasing_id()))
        rows = numbered.select(F.col("__id").alias("id"), feature_array(dataset, self.getFeaturesCol()).alias("x"), (F.col(fold).cast("int") if fold else F.lit(-1)).alias("fold"))
        votes = self.votes(rows).withColumn("votes", F.transform("votes", lambda v: F.round(v, 9)))
        best = F.get(F.lit(self.labels), (F.array_position("votes", F.array_max("votes")) - 1).cast("int"))
        out = self.getPredictionCol()
        return numbered.join(votes.select(F.col("id").alias("__id"), best.alias(out)), "__id", "left").select(*[c for c in dataset.columns if c != out], out)

    def importances(self, names: list[str]) -> DataFrame:
        """Impurity that each feature removes, as a share per tree, averaged over trees."""
        d, k = self.spec["d"], len(self.labels)

        def sums(trees: Iterator[tuple[int, dict]]) -> pd.DataFrame:
            out: dict[int, np.ndarray] = {}
            for t, tree in trees:
                split = tree["feature"] >= 0
                out.setdefault(t, np.zeros(d))
                out[t] += np.bincount(tree["feature"][split], weights=tree["gain"][split], minlength=d)
            return pd.DataFrame({"tree": list(out), "gain": list(out.values())})

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield sums((r["tree"], read_tree(r, k)) for r in batch.to_dict("records"))

        schema = "tree int, gain array<double>"
        held = sums((t, tree.arrays()) for t, tree in self.tops.items())
        plain = [(int(t), gain.tolist()) for t, gain in zip(held["tree"], held["gain"])]  # numpy numbers only pass through Arrow
        tops = self.nodes.sparkSession.createDataFrame(plain, schema)
        gains = self.nodes.mapInPandas(run, schema).unionByName(tops).select("tree", array_to_vector("gain").alias("gain"))
        whole = gains.groupBy("tree").agg(Summarizer.sum(F.col("gain")).alias("gain")).select(vector_to_array("gain").alias("gain"))
        total = F.aggregate("gain", F.lit(0.0), lambda a, b: a + b)
        shares = whole.withColumn("total", total).where("total > 0").select(F.posexplode("gain").alias("at", "gain"), "total")
        mean = shares.groupBy("at").agg(F.avg(F.col("gain") / F.col("total")).alias("importance"))
        return mean.select(F.get(F.lit(list(names)), F.col("at")).alias("feature"), "importance")


def random_forest(trees: int = 150, seed: int = 15, features: str = "features", label: str = "label", key: tuple[str, ...] = ()) -> Forest:
    return Forest(trees=trees, seed=seed, featuresCol=features, labelCol=label, key=key)


def extra_trees(trees: int = 100, seed: int = 10, features: str = "features", label: str = "label", key: tuple[str, ...] = ()) -> Forest:
    """Trees on all rows that draw one cut per node and feature inside the node's own range."""
    return Forest(trees=trees, seed=seed, featuresCol=features, labelCol=label, extra=True, key=key)


def importances(spark: SparkSession, model: ForestModel, names: list[str]) -> DataFrame:
    """Impurity importance by feature (one row per feature, from the fitted model)."""
    return model.importances(names)
