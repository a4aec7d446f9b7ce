"""The Jaccard join against all pairs, with hot passages, copies and edges at exactly 0.8."""

import random

import numpy as np
import pytest

from tallyframe.llm import components, jaccard


def shingles(text, n=5):
    lower = {i: chr(i + 32) for i in range(65, 91)}
    w = [x for x in (text or "").translate(lower).replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if x]
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(sets)):
        for b in range(a):
            (i, x), (j, y) = sets[a], sets[b]
            both = len(x & y)
            if x and y and 100 * both >= 80 * (len(x) + len(y) - both):
                i, j = root(i), root(j)
                parent[max(i, j)] = min(i, j)
    return sorted([(i, len(s), root(i)) for i, s in sets] + [(None, len(shingles(t)), None) for i, t in rows if i is None], key=repr)


def corpus(rng):
    word = lambda: f"w{rng.randint(0, 400)}"
    rows, passage = [], [word() for _ in range(60)]
    for k in range(25):  # families of near copies, some edits breaking the link
        base = [word() for _ in range(rng.choice([3, 5, 6, 9, 13, 14, 30, 80, 200]))]
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = word()
            rows.append(" ".join(copy))
    for _ in range(45):  # a common passage that most of the text consists of
        rows.append(" ".join([word() for _ in range(rng.randint(4, 9))] + passage + [word() for _ in range(rng.randint(2, 9))]))
    rows += [" ".join(passage)] * 4
    return [(1000 + i, t if i % 3 else t.upper()) for i, t in enumerate(rows)]


@pytest.mark.parametrize("large", [2, 16])
def test_against_all_pairs(docs, nasty, monkeypatch, large):
    monkeypatch.setattr(jaccard, "LARGE", large)
    rows = corpus(random.Random(large)) + nasty
    out = jaccard.near_duplicates(docs(rows).repartition(4))
    got = sorted([(r.doc_id, r.n_shingles, r.component_id) for r in out.collect()], key=repr)
    assert got == brute(rows)


def test_empty(docs, nasty):
    assert jaccard.near_duplicates(docs(nasty).where("false")).count() == 0
    out = jaccard.near_duplicates(docs([(3, None), (2, ""), (1, "x")]), key="doc_id").collect()
    assert sorted(map(tuple, out)) == [(1, 1, 1), (2, 0, 2), (3, 0, 3)]


@pytest.mark.parametrize("percent", [60, 80, 95])
def test_similar_sets_share_a_signature(percent):
    rng = np.random.default_rng(percent)
    signer = jaccard.Signer(percent)
    for _ in range(1500):
        n = int(rng.choice([1, 2, 3, 4, 5, 8, 9, 12, 20, 40, 100, 300]))
        x = rng.integers(0, 2**63, n).astype(np.uint64)
        y = np.concatenate([x[rng.integers(0, max(1, n // 4)) :], rng.integers(0, 2**63, rng.integers(0, n // 4 + 1)).astype(np.uint64)])
        x, y = np.unique(x), np.unique(y)
        both = len(np.intersect1d(x, y))
        if 100 * both >= percent * (len(x) + len(y) - both):
            assert len(np.intersect1d(signer(x), signer(y)))


def test_work_for_the_driver(docs, monkeypatch):
    """What the driver keeps of shuffles and tasks grows with the exchanges of all the plans of a join."""
    planned = []

    def counting(df, store=components.stored):
        planned.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange "))
        return store(df)

    monkeypatch.setattr(jaccard, "stored", counting)
    monkeypatch.setattr(components, "stored", counting)
    rows = corpus(random.Random(3))
    out = jaccard.near_duplicates(docs(rows).repartition(4))
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out.collect()), key=repr) == brute(rows)
    assert max(planned) <= 20 and sum(planned) <= 150, planned
