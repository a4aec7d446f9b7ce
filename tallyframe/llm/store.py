"""Intermediate tables in the folder that all machines share."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a local master without that setting falls back to a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        folder = os.path.join(tempfile.gettempdir(), "tallyframe-checkpoints")
    return folder.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back, so that later passes and lost
    executors do not redo the work.  The table goes when the application ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def batches_of(spark: SparkSession, size: str) -> Iterator[None]:
    """Arrow batches of about ``size`` bytes, and one row at least, for what is run inside; for rows of any length."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def schema_with(df: DataFrame, ddl: str) -> StructType:
    """The columns of ``df`` and those of a DDL string."""
    return StructType([*df.schema.fields, *StructType.fromDDL(ddl).fields])
