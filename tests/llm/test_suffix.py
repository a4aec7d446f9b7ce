"""Suffix arrays and substring deduplication against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tallyframe.llm import suffixdedup, suffixes


@pytest.mark.parametrize("few", [2, 4, 2048])
def test_suffix_array(monkeypatch, few):
    monkeypatch.setattr(suffixes, "FEW", few)
    rng = random.Random(few)
    for _ in range(300):
        k = rng.choice([1, 2, 3, 5])
        s = [rng.randint(1, k) for _ in range(rng.randint(0, 60))] + [0]
        order = suffixes.suffix_array(np.array(s), max(2, k + 1)).tolist()
        assert order == sorted(range(len(s)), key=lambda i: s[i:])
        before, common = suffixes.permuted_common_prefixes(np.array(s), np.array(order))
        for x, y in zip(order[1:], order):
            m = 0
            while s[x + m] == s[y + m]:
                m += 1
            assert before[x] == y and common[x] == m


def brute(texts, width):
    count = Counter(t[i : i + width] for t in texts for i in range(len(t) - width + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - width + 1):
            if count[t[i : i + width]] > 1:
                gone[i : i + width] = True
        edge = np.diff(np.concatenate(([False], gone, [False])).astype(int))
        out.append((len(t), int(gone.sum()), int((edge == 1).sum()), np.frombuffer(t, np.uint8)[~gone].tobytes()))
    return out


@pytest.mark.parametrize("hot", [0, 5000])
def test_against_brute_force(docs, nasty, hot):
    rng = random.Random(1)
    word = lambda: "".join(rng.choices("abcdé ", k=rng.randint(1, 8)))
    passages = [" ".join(word() for _ in range(20)) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [" ".join(word() for _ in range(rng.randint(0, 30)))]
        for _ in range(rng.choice([0, 1, 1, 2])):
            p = rng.choice(passages)
            parts += [p[rng.randint(0, 20) : len(p) - rng.randint(0, 20)], word()]
        rows.append((i, "".join(parts)))
    rows += [(70, "ab" * 100), (71, "x" * 90), (72, rows[3][1]), (73, rows[3][1])] + nasty[:-1] + [(905, "long " * 300)]
    out = suffixdedup.remove_repeats(docs(rows).repartition(3), width=40, gram=12, hot_regions=hot).collect()
    want = brute([(t or "").encode() for _, t in rows], 40)
    got = sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in out], key=repr)
    assert got == sorted([(i, a, b, c, hashlib.sha256(d).hexdigest()) for (i, _), (a, b, c, d) in zip(rows, want)], key=repr)
    assert sum(r.n_removed for r in out) > 0


def test_blocks_and_empty(docs, monkeypatch):
    monkeypatch.setattr(suffixdedup, "BLOCK", 64)
    rng = random.Random(2)
    base = "".join(rng.choices("abcdefgh", k=400))
    texts = [base, "zz" + base[100:300] + "yy", "q" * 30, base[:39]]
    out = suffixdedup.remove_repeats(docs(list(enumerate(texts))), width=40, gram=12).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out} == dict(enumerate(brute([t.encode() for t in texts], 40)))
    assert suffixdedup.remove_repeats(docs([(1, "x")]).where("false"), width=40, gram=12).count() == 0
