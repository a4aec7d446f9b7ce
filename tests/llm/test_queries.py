"""Queries against their SQL twins, and the pipeline stage by stage."""

import json

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from check import compare, connect
from tallyframe.llm import jaccard, quality
from tallyframe.llm.queries import ORACLES, QUERIES, source_weights

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_every_operator_is_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    assert compare(spark, connect(FOLDER), name, FOLDER) is None


def test_source_weights():
    assert source_weights(["b", None, "a", "é", "B"]) == {"B": 1, "a": 2, "b": 3, "é": 1, None: 2}


def test_stages(spark, docs, nasty, tmp_path):
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    prose = lambda i, n=60: " ".join(f"word{(i * 37 + j * 11) % 997}" for j in range(n))
    rows = [(i, prose(i), f"s{i % 3}") for i in range(30)] + [(100 + i, prose(i) + " end", "s0") for i in range(5)] + [(200, f"{prose(77)} {passage} {prose(78)}", "s1")] + nasty
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    sf, df = str(tmp_path), docs(rows)

    kept = corpus_pipeline.good(spark, df, sf)
    assert kept.columns == COLUMNS and kept.count() == len(rows)  # labels of one kind: the score is their mean

    kept = corpus_pipeline.distinct(spark, df, sf)
    classes = jaccard.near_duplicates(df).collect()
    wanted = {r.component_id for r in classes}
    ids = [r.doc_id for r in kept.collect()]
    # "a" and "b c" have one id and are no near copies: both stay
    assert kept.columns == COLUMNS and set(ids) == wanted and sum(i is not None for i in ids) == len(wanted - {None}) + 1 and not {100, 101} & set(ids)
    unlike = corpus_pipeline.distinct(spark, docs([(1, prose(1)), (1, prose(2)), (2, prose(3)), (2, prose(3)), (3, prose(1))]), sf)
    assert sorted(r.doc_id for r in unlike.collect()) == [1, 1, 2]

    clean = corpus_pipeline.decontaminated(spark, df, sf)
    assert clean.columns == COLUMNS and {r[0] for r in rows} - {r.doc_id for r in clean.collect()} == {200}

    mixed = corpus_pipeline.mixed(spark, df, sf)
    total = sum(len((t or "").split()) for _, t, *_ in rows)
    counts = {}
    for r in mixed.collect():
        counts[json.dumps(r)] = counts.get(json.dumps(r), 0) + 1
    assert mixed.columns == COLUMNS and max(counts.values()) <= 9
    assert abs(sum(len((r.text or "").split()) for r in mixed.collect()) - total) < 0.2 * total

    dealt = corpus_pipeline.dealt(spark, df, sf)
    assert dealt.columns == [*COLUMNS, "shard", "slot"] and dealt.count() == len(rows)
    for stage in corpus_pipeline.STAGES:
        assert stage[1](spark, df.where("false"), sf).count() == 0


def test_pipeline_is_its_stages(spark):
    out = corpus_pipeline.run(spark, FOLDER).collect()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    good = {r.doc_id for r in quality.score(docs, model).where("score >= 0.7").collect()}
    assert out and {r.doc_id for r in out} <= good
    for shard in range(16):
        assert sorted(r.slot for r in out if r.shard == shard) == list(range(sum(r.shard == shard for r in out)))
