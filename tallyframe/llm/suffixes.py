"""Suffix arrays by induced sorting, and permuted common prefixes, over numpy arrays."""

from __future__ import annotations

import numpy as np

from .text import BASE, mixed, powers

FEW = 2048  # symbols that are worth a pass over buckets


def classify(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which suffixes are smaller than the next one (the last, a unique smallest symbol, is), and the places of those
    that stand right of a larger one: the leftmost smaller ones."""
    n = len(s)
    differ = np.flatnonzero(s[:-1] != s[1:])
    after = differ[np.searchsorted(differ, np.arange(n - 1))]  # where the run of equal symbols ends
    small = np.append(s[after] < s[after + 1], True)
    return small, np.flatnonzero(small[1:] & ~small[:-1]) + 1


def induce(s: np.ndarray, small: np.ndarray, seeds: np.ndarray, n_symbols: int) -> np.ndarray:
    """All suffixes in the order that ``seeds``, leftmost smaller ones in their order, induce.

    A larger suffix takes the next place from the front of its symbol's bucket when the suffix after it is met in a
    pass from the left; then smaller ones take theirs from the back in a pass from the right.  A bucket's suffixes are
    taken together, those that fall into the same bucket again in a further round.
    """
    n = len(s)
    counts = np.bincount(s, minlength=n_symbols)
    end = np.cumsum(counts)
    start = end - counts
    out = np.full(n, -1, np.int64)

    def deal(places: np.ndarray, which: np.ndarray, at: np.ndarray, step: int) -> None:
        before = places[places > 0] - 1
        before = before[small[before] == which]
        if len(before):
            symbols = s[before]
            order = np.argsort(symbols, kind="stable")
            before, symbols = before[order], symbols[order]
            own = np.bincount(symbols, minlength=n_symbols)
            rank = np.arange(len(before)) - (np.cumsum(own) - own)[symbols]
            out[at[symbols] + (rank if step > 0 else -1 - rank)] = before
            at += step * own

    symbols = s[seeds]
    order = np.argsort(symbols, kind="stable")
    n_seeds = np.bincount(symbols, minlength=n_symbols)
    rank = np.arange(len(seeds)) - (np.cumsum(n_seeds) - n_seeds)[symbols[order]]
    out[(end - n_seeds)[symbols[order]] + rank] = seeds[order]
    front = start.copy()
    used = np.flatnonzero(counts).tolist()
    for c in used:
        low = start[c]
        while low < front[c]:
            low, high = front[c], low
            deal(out[high:low], False, front, 1)
        if n_seeds[c]:
            deal(out[end[c] - n_seeds[c] : end[c]], False, front, 1)
    back = end.copy()
    out[0], back[s[n - 1]] = n - 1, end[s[n - 1]] - 1
    for c in reversed(used):
        high = end[c]
        if c == s[n - 1]:
            deal(out[:1], True, back, -1)
            continue
        while back[c] < high:
            low = back[c]
            deal(out[low:high][::-1], True, back, -1)
            high = low
        deal(out[start[c] : front[c]][::-1], True, back, -1)
    return out


def by_doubling(s: np.ndarray) -> np.ndarray:
    """Suffixes of a string of many symbols, ranked by ever longer prefixes."""
    rank, step, n = np.unique(s, return_inverse=True)[1].astype(np.int64), 1, len(s)
    while True:
        other = np.zeros(n, np.int64)
        other[: max(0, n - step)] = rank[step:] + 1
        pair = rank * (n + 1) + other
        order = np.argsort(pair, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate(([0], np.diff(pair[order]) != 0)))
        if rank[order[-1]] == n - 1:
            return order
        step *= 2


def suffix_array(s: np.ndarray, n_symbols: int) -> np.ndarray:
    """Order of the suffixes of ``s``, whose last symbol is 0 and occurs once.

    Suffixes are classified, substrings between leftmost smaller ones are sorted by induction and named, the string of
    names is sorted recursively, and its order induces that of all suffixes.  A string of names with more symbols than
    ``FEW`` is ranked by doubling, as passes over buckets of a suffix each would be slow here.
    """
    if len(s) == 1:
        return np.zeros(1, np.int64)
    if n_symbols > FEW:
        return by_doubling(s)
    small, left = classify(s)
    if len(left) == 1:
        return induce(s, small, left, n_symbols)
    rough = induce(s, small, left, n_symbols)
    is_left = np.zeros(len(s), bool)
    is_left[left] = True
    ordered = rough[is_left[rough]]
    stop = np.append(left[1:], len(s) - 1) + 1  # a substring ends with the first symbol of the next
    total = prefix_sums(s)
    down = powers(pow(BASE, -1, 1 << 64), len(s) + 1)
    hashes = mixed((total[stop] - total[left]) * down[left] + (stop - left).astype(np.uint64))
    at = np.searchsorted(left, ordered)
    names = np.cumsum(np.concatenate(([0], hashes[at][1:] != hashes[at][:-1])))
    reduced = np.empty(len(left), np.int64)
    reduced[at] = names
    order = at if names[-1] == len(left) - 1 else suffix_array(reduced, int(names[-1]) + 1)
    return induce(s, small, left[order], n_symbols)


def prefix_sums(s: np.ndarray) -> np.ndarray:
    """Sums from which the hash of any substring is a difference."""
    total = np.zeros(len(s) + 1, np.uint64)
    np.cumsum((s.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(s)), out=total[1:])
    return total


def permuted_common_prefixes(s: np.ndarray, order: np.ndarray, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Of each suffix, by place in the string: the suffix before it in ``order`` (-1: none) and the length of their
    common prefix; one shorter than ``least`` may be told as 0.

    Only where the symbols left of both differ is a prefix compared, by hashes of halving length; everywhere else it is
    one shorter than that of the place to the left.
    """
    n = len(s)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    places = np.arange(n)
    own = (places == 0) | (before <= 0)
    own |= s[places - 1] != s[np.maximum(before, 1) - 1]
    heads = np.flatnonzero(own)
    x, y = heads.copy(), before[heads].copy()
    some = y >= 0
    x, y = x[some], y[some]
    total, down = prefix_sums(s), powers(pow(BASE, -1, 1 << 64), n + 1)

    def equal(a: np.ndarray, b: np.ndarray, m: int) -> np.ndarray:
        return (total[a + m] - total[a]) * down[a] == (total[b + m] - total[b]) * down[b]

    long = np.flatnonzero(n - np.maximum(x, y) >= least)
    long = long[equal(x[long], y[long], least)]
    some = np.flatnonzero(some)[long]
    x, y = x[long], y[long]
    length, step = np.full(len(x), least, np.int64), 1 << n.bit_length()
    limit = n - np.maximum(x, y)
    while step and len(x):
        fits = np.flatnonzero(length + step <= limit)
        same = fits[equal(x[fits] + length[fits], y[fits] + length[fits], step)]
        length[same] += step
        step //= 2
    at_heads = np.zeros(len(heads), np.int64)
    at_heads[some] = length
    last = np.searchsorted(heads, places, side="right") - 1
    return before, np.maximum(at_heads[last] - (places - heads[last]), 0)


def repeated_windows(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Of each text, the places where ``width`` bytes begin that also begin at another place of these texts."""
    lengths = np.array([len(t) for t in texts], np.int64)
    s = np.frombuffer(b"\x00".join(texts) + b"\x00\x00", np.uint8).astype(np.int64) + 2
    ends = np.cumsum(lengths + 1) - 1
    s[ends] = 1  # no window runs over the end of a text
    s[-1] = 0
    before, common = permuted_common_prefixes(s, suffix_array(s, 258), width)
    hit = np.zeros(len(s), bool)
    same = np.flatnonzero((common >= width) & (before >= 0))
    hit[same] = hit[before[same]] = True
    starts = ends - lengths
    out = []
    for a, n in zip(starts.tolist(), lengths.tolist()):
        out.append(np.flatnonzero(hit[a : a + max(0, n - width + 1)]))
    return out
