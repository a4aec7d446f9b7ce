"""From raw documents to training shards: rate, deduplicate, decontaminate, mix, shard.

Every stage takes (spark, docs, sf_dir) with the columns of ``documents`` (more may be there, they are kept) and
returns them; the last adds the shard and the slot.  An empty table stays empty in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import decontam, jaccard, mixing, quality, sharding
from tallyframe.llm.queries import MAX_SOURCES, n_words, source_weights
from tallyframe.llm.store import stored

QUALITY = 0.7
SHARDS = 16


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores at 0.7 or more; it learns from ``labels`` and these documents."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    model = quality.fit(docs.select("doc_id", "text"), labels)
    return quality.score(docs, model, name="__score").where(F.col("__score") >= QUALITY).select(*docs.columns)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the row with the smallest id, the first of the table among equal ids.

    Every row is a document of its own, so unlike texts under one id, or without an id, all stay.
    """
    numbered = stored(docs.withColumn("__row", F.monotonically_increasing_id()))
    classes = jaccard.near_duplicates(numbered.select("__row", "text", F.col("doc_id").alias("__id")), "__row", "text", n=5, percent=80)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row")
    first = numbered.join(classes, "__row").groupBy("component_id").agg(F.min(order).alias("first")).select(F.col("first.__row").alias("__row"))
    return numbered.join(first, "__row", "left_semi").select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word passage of ``benchmark``."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam.decontaminate(docs, benchmark, n=10, remove="documents").select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their targets (weights 1, 2, 3, repeating; as many words as came in; at most 3 repeats).

    A document appears as often as the mix takes it: the part of one that a source needs to meet its target counts
    as a whole from half of its words, and documents of which nothing is taken go.
    """
    rows = docs.withColumns({"__sources": F.array("source"), "__size": n_words("text")})
    names = [r[0] for r in docs.select("source").distinct().limit(MAX_SOURCES + 1).collect()]
    if len(names) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    taken = mixing.mix(rows, "doc_id", "__size", "__sources", source_weights(names), seed=0, most=3)
    copies = F.when(F.col("__size") > 0, F.floor(F.col("taken") / F.col("__size") + 0.5)).otherwise(0).cast("int")
    return taken.where(copies > 0).withColumn("__copy", F.explode(F.sequence(F.lit(1), copies))).select(*docs.columns)


def dealt(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Records dealt to 16 equal shards by rendezvous hashing of their id, each with a slot in its shard."""
    ties = [c for c in ("text", "lang", "source", "n_chars") if c in docs.columns]
    return sharding.shards(docs, "doc_id", [1.0] * SHARDS, ties=ties)


STAGES = [("quality classifier", good), ("n-gram Jaccard join", distinct), ("benchmark decontamination", decontaminated), ("mixing sources", mixed), ("sharding", dealt)]

ORACLE_SQL = None  # the classifier's training can't be said in SQL; tests/llm holds each stage against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored as Parquet and read back for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
