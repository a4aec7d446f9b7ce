"""Weak supervision: counts against brute force, what it learns, and that no Python runs on executors."""

import itertools
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyframe.llm import rules
from tallyframe.llm.queries import QUERIES

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    w = WORD.findall(text or "")
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    count, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if count[x] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_counts(docs, nasty):
    rows = [*nasty, (1, "a b c a b c\n\n d #| \r\n d #| \r\nd #|"), (2, "x x x x x"), (3, "\x0bone two\x0c three one two three\x85  "), (4, "a b"), (5, "a b c"), (6, "a b c d")]
    out = rules.text_stats(docs(rows).withColumn("n_words", F.lit("old")), "text").collect()
    got = sorted(((r.doc_id, r.text, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out), key=repr)
    assert got == sorted(((i, t, *brute(t)) for i, t in rows), key=repr)


def test_learns_whom_to_trust():
    patterns = {(1, 1, 1): 800, (-1, 1, 0): 60, (1, -1, 1): 50, (-1, -1, 1): 20, (1, 0, 0): 70}
    trust = rules.learn(patterns)
    assert trust.posterior((1, 1, 1)) > 0.8 and trust.posterior((-1, 1, 0)) < 0.5 and trust.posterior((-1, -1, 1)) < 0.01
    larger = rules.learn({k: 1000 * v for k, v in patterns.items()})
    assert all((trust.posterior(p) > 0.5) == (larger.posterior(p) > 0.5) for p in patterns)
    assert all(0 < a <= 1 for a in trust.accuracies()) and rules.learn({}).good == rules.SHARE


@pytest.mark.parametrize("bad,blame", [(0.02, 0.05), (0.1, 0.05), (0.3, 0.05), (0.02, 0.2), (0.1, 0.2)])
def test_learns_that_a_rule_misfires(bad, blame):
    """Six rules fail 40% of bad documents each, and the first also a share of good ones, which must be kept."""
    patterns = {}
    for votes in itertools.product((-1, 1), repeat=6):
        failed = votes.count(-1)
        of_good = 0 if failed - (votes[0] < 0) else blame if votes[0] < 0 else 1 - blame
        patterns[votes] = round(100_000 * ((1 - bad) * of_good + bad * 0.4**failed * 0.6 ** (6 - failed)))
    assert rules.corroborated(patterns) == [True] * 6
    trust = rules.learn(patterns)
    assert trust.posterior((-1, 1, 1, 1, 1, 1)) >= 0.5 and trust.posterior((1,) * 6) > 0.9
    assert trust.posterior((-1, -1, 1, 1, 1, 1)) < 0.5 and trust.posterior((1, -1, -1, 1, 1, 1)) < 0.5


def test_believes_a_fault_that_never_comes_with_another():
    patterns = {(1, 1, 1): 9000, (-1, 1, 1): 600, (1, -1, -1): 300, (1, -1, 1): 50, (1, 1, -1): 50}
    assert rules.corroborated(patterns) == [False, True, True]
    assert rules.learn(patterns).posterior((-1, 1, 1)) < 0.5


def test_query_on_labels_and_native(spark):
    sf = "/root/testdata/sf0.01"
    df = QUERIES["op2_quality_rules"](spark, sf)
    out = {r.doc_id: r for r in df.collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert set(out) == set(texts)
    for i, r in out.items():
        w = brute(texts[i])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == w
        assert r.base_failed == (w[0] < 50 or 100 * w[4] > 50 * w[0]) and not (r.base_failed and r.kept)
    assert not any(out[i].kept for i, q in label.items() if q == 0)
    assert all(out[i].kept for i, q in label.items() if q == 1 and not out[i].base_failed)
    stats = rules.text_stats(spark.read.parquet(f"{sf}/documents.parquet"))
    judged, _ = rules.judge(stats, rules.default_rules())
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_edge_cases(docs, nasty):
    assert rules.quality_rules(docs(nasty).where("false")).count() == 0
    odd = rules.judge(docs(nasty).withColumn("n", F.length("text")), {"short": F.when(F.col("n") < 3, -1).when(F.col("n") > 100, 5)})[0]
    assert {r.vote_short for r in odd.collect()} == {-1, 0, 1}
    with pytest.raises(ValueError, match="patterns"):
        rules.judge(docs(nasty).withColumn("n", F.length("text")), {"odd": F.col("n") % 2}, max_patterns=0)
