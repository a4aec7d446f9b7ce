"""NRA search against scores of all documents."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from conftest import NASTY

from tallyframe.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(docs, items, k):
    counts = [Counter(TERM.findall((r[1] or "").translate(LOWER))) for r in docs]
    n_docs, n_terms = sum(bool(c) for c in counts), sum(c.total() for c in counts)
    df, out = Counter(t for c in counts for t in c), []
    for item, text in items:
        scored = []
        for (doc, *_), c in zip(docs, counts):
            score = 0
            for t in set(TERM.findall((text or "").translate(LOWER))) & set(c):
                m = 50 + 50 * c.total() * n_docs // n_terms
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
            if score:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, i + 1, None if none else doc, -s) for i, (s, none, doc) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@pytest.mark.parametrize("seed", range(8))
def test_lists_without_random_access(seed):
    rng = np.random.default_rng(seed)
    n_docs, k = int(rng.integers(1, 400)), int(rng.integers(1, 12))
    sums, lists = np.zeros(n_docs, int), []
    for _ in range(rng.integers(1, 9)):
        docs = rng.permutation(n_docs)[: rng.integers(1, n_docs + 1)]
        impacts = -np.sort(-rng.choice([1, 2, 5, 40, 1000, 90_000], len(docs)) * rng.integers(1, 4, len(docs)))
        sums[docs] += impacts
        lists.append((docs, impacts))
    found, scores = ranked.no_random_access(lists, n_docs, k)
    kth = -np.sort(-sums)[min(k, n_docs) - 1]
    assert (scores == sums[found]).all() and {i for i in range(n_docs) if sums[i] >= max(kth, 1)} == {i for i, s in zip(found, scores) if s > 0}


def test_reading_stops_before_the_end():
    """The lists of frequent terms are not read to their end for documents that can't enter any more."""
    n = 10_000
    read = []

    class Counted(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, slice):
                read.append((key.stop or 0) - (key.start or 0))
            return super().__getitem__(key)

    rare = (np.arange(5), np.array([10_000, 9_000, 8_000, 7_000, 6_000]))
    common = (np.arange(n).view(Counted), np.linspace(100, 1, n).astype(int))
    found, scores = ranked.no_random_access([rare, common], n, 3)
    assert sorted(zip(found.tolist(), scores.tolist()))[:3] == [(0, 10_100), (1, 9_099), (2, 8_099)] and sum(read) < n


@pytest.mark.parametrize("sizes", [{}, {"max_terms": 5, "part_postings": 7}])
def test_against_all_scores(spark, docs, sizes):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(40)] + ["Über", "naïve", "x1", "日本"]
    weights = 1 / np.arange(1, len(vocabulary) + 1)
    def text(n):
        return " ".join(rng.choice(vocabulary, n, p=weights / weights.sum()))

    rows = [(i % 70, text(int(rng.integers(1, 60)))) for i in range(90)] + [(300 + i, "w3, W5! same") for i in range(12)] + NASTY
    items = [(1, text(8)), (2, text(20)), (2, "same w3 word"), (3, None), (4, ""), (5, "!!"), (None, "w5 naïve ñandú long"), (7, "w1"), (8, "absent")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    out = ranked.best_documents(docs(rows), asked, k=6, **sizes)
    assert out.columns == ["item_id", "rank", "doc_id", "score"] and got(out) == by_hand(rows, items, 6)


def test_empty_tables_and_clashing_names(spark, docs):
    asked = spark.createDataFrame([("a", "one two", 3)], "item_id string, text string, score int")
    df = docs([(1, "one"), (2, "three")]).withColumnRenamed("source", "score").withColumnRenamed("lang", "row")
    assert [tuple(r) for r in ranked.best_documents(df, asked).collect()] == [("a", 1, 1, by_hand([(1, "one"), (2, "three")], [("a", "one")], 1)[0][3])]
    assert ranked.best_documents(df.where("false"), asked).count() == 0
    assert ranked.best_documents(df, asked.where("false")).count() == 0
    assert ranked.best_documents(docs([(1, None), (2, "")]), asked).count() == 0


def test_long_text_in_pieces(monkeypatch):
    data = ("Abc d9 ñ " * 50).encode()
    whole = ranked.term_counts(data)
    monkeypatch.setattr(ranked, "PIECE", 4)
    assert ranked.term_counts(data) == whole == {b"abc": 50, b"d9": 50, "ñ".encode(): 50}
