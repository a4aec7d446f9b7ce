"""Decontamination against brute force, in one block and in several."""

import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyframe.llm.decontam import decontaminate
from tallyframe.llm.text import slices

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items, n):
    out = []
    for i, text in rows:
        w, hit, ids = words(text), set(), set()
        for item, t in items:
            own = words(t)
            m = min(n, len(own))
            for a in range(len(own) - m + 1 if m else 0):
                for b in range(len(w) - m + 1):
                    if w[b : b + m] == own[a : a + m]:
                        hit |= set(range(b, b + m))
                        ids |= {str(item)} if item is not None else set()
        out.append((i, len(w), len(hit), sorted(ids)))
    return sorted(out, key=repr)


@pytest.fixture
def data(nasty):
    rng = random.Random(7)
    vocabulary = ["a", "b", "Ü", "c1", "the", "日本"]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 5, 9, 20])))) for k in range(12)] + [(12, None), (13, "... !"), (None, "the a b c1"), (2, "a b a b a")]
    rows = [(i, "\n".join(" ,".join(rng.choices(vocabulary, k=rng.randint(0, 25))) for _ in range(3))) for i in range(40)]
    rows += [(100, f"So: {items[4][1].upper()}... end"), (101, "x y z")]
    return rows + nasty, items


@pytest.mark.parametrize("max_windows", [1_000_000, 7])
def test_against_brute_force(spark, docs, data, max_windows):
    rows, items = data
    out = decontaminate(docs(rows), spark.createDataFrame(items, "item_id long, text string"), n=4, remove=None, max_windows=max_windows)
    got = [(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in out.collect()]
    assert sorted(got, key=repr) == brute(rows, items, 4)
    assert sorted((r.doc_id, r.text) for r in out.where("doc_id < 100").collect()) == sorted(r for r in rows if r[0] is not None and r[0] < 100)


def test_spans_and_documents(spark, docs):
    bench = spark.createDataFrame([(1, "one two three four")], "item_id long, text string")
    df = docs([(1, "Start: ONE two, three four! End."), (2, "one two three"), (3, None), (4, "one two three four one two three four"), (5, "é one two three four é")])
    cut = {r.doc_id: (r.text, [tuple(s) for s in r.spans]) for r in decontaminate(df, bench, n=4).collect()}
    assert cut[1] == ("Start: ! End.", [(1, 4)]) and cut[2] == ("one two three", []) and cut[3] == (None, [])
    assert cut[4] == ("", [(0, 8)]) and cut[5] == ("é é", [(1, 4)])
    kept = decontaminate(df.withColumn("items", F.lit("x")), bench, n=4, remove="documents")
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3]
    assert decontaminate(df, bench.where("false"), n=4, remove="documents").count() == 5
    assert decontaminate(df.where("false"), bench, n=4).count() == 0


@pytest.mark.parametrize("remove", ["spans", "documents", None])
def test_one_pass_over_the_texts(spark, docs, data, remove):
    """A task has one Python worker for texts, not one that finds hits and one that cuts them out."""
    rows, items = data
    out = decontaminate(docs(rows), spark.createDataFrame(items, "item_id long, text string"), n=4, remove=remove)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert sum(line.lstrip("+- :").startswith("MapInArrow") for line in plan.splitlines()) == 1
    several = decontaminate(docs(rows), spark.createDataFrame(items, "item_id long, text string"), n=4, remove=remove, max_windows=7)
    assert sorted(map(repr, out.collect())) == sorted(map(repr, several.collect()))


def test_parts_of_batches():
    """What is made of a batch is bounded by bytes, not by the rows of a batch; a long row is a part of its own."""
    texts = ["a" * 100] * 50 + ["b" * 5000] + ["c"] * 10
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    parts = list(slices([batch, batch.slice(0, 0)], 1000))
    assert [t for p in parts for t in p.column(0).to_pylist()] == texts
    assert len(parts) >= 7 and max(p.num_rows for p in parts) <= 9
    assert [p.num_rows for p in slices([batch.slice(50, 1)], 10)] == [1]
