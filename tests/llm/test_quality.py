"""The attention classifier: gradients, held-out accuracy, edge cases."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from tallyframe.llm import quality
from tallyframe.llm.queries import QUERIES


def test_gradient():
    rng = np.random.default_rng(0)
    net = quality.GatedAttention(hidden=4, gate=3, seed=1)
    x, starts, y = rng.normal(size=(9, quality.WIDTH)) * 0.05, np.array([0, 2, 3, 7]), np.array([0.0, 1.0, 1.0, 0.0])

    def loss():
        p = net.forward(x, starts)["y"]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    for name, d in net.gradient(x, starts, y).items():
        at = tuple(rng.integers(0, n) for n in d.shape)
        old = net.p[name][at]
        net.p[name][at] = old + 1e-6
        up = loss()
        net.p[name][at] = old - 1e-6
        down = loss()
        net.p[name][at] = old
        assert d[at] == pytest.approx((up - down) / 2e-6, rel=1e-3, abs=1e-7)


def test_held_out_accuracy_and_no_leak(spark):
    sf = "/root/testdata/sf0.01"
    out = QUERIES["op4_quality_classifier"](spark, sf).collect()
    assert len(out) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    judged = [(r.predicted, label[r.doc_id]) for r in out if r.held_out and r.doc_id in label]
    assert sum(p == q for p, q in judged) / len(judged) > 0.9
    assert np.mean([p for p, q in judged if q == 1]) > 0.95


def test_edge_cases(spark, docs, nasty):
    df = docs(nasty)
    labels = spark.createDataFrame([(903, 1), (901, 0), (901, 1), (None, 1), (904, None), (905, 0)], "doc_id long, quality int")
    model = quality.fit(df, labels)
    out = quality.score(df.withColumnRenamed("lang", "score"), model).collect()
    assert len(out) == len(nasty) and all(0 <= r.score <= 1 for r in out)
    same = {r.text: r.score for r in out}
    assert same[None] == same[""]
    assert {r.score for r in quality.score(df, quality.fit(df, labels.where("false"))).collect()} == {0.5}
    assert quality.score(df.where("false"), model).count() == 0
    bag = quality.Encoder()(("word " * 1000).encode())
    assert len(bag) == 6 and bag.shape[1] == quality.WIDTH


def test_features_of_the_sample_are_one_array():
    rng = np.random.default_rng(5)
    made = [rng.random((n, quality.WIDTH)).astype(np.float16) for n in (2, 1, 3, 1)]
    got = pa.table({"key": ["b", "a", "10", "b"], "bag": pa.array([x.tobytes() for x in made], pa.binary()), "label": pa.array([1, 0, 1, 0], pa.int32())})
    bags, labels = quality.bags_of(pa.concat_tables([got.slice(0, 3), got.slice(3)]))
    rows = sorted(zip(got["key"].to_pylist(), (x.tobytes() for x in made), made, [1.0, 0.0, 1.0, 0.0]), key=lambda r: r[:2])
    assert labels.tolist() == [r[3] for r in rows] and all(np.array_equal(a, r[2].astype(np.float32)) for a, r in zip(bags, rows))
    assert len({id(bag.base) for bag in bags}) == 1
    none, labels = quality.bags_of(got.slice(0, 0))
    assert none == [] and labels.dtype == np.float64 and len(labels) == 0
