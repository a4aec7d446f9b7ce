"""Session defaults and the one place that decides where checkpoints go."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", memory: str = "8g", partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallyframe")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def _plain(folder: str) -> str:
    """A folder's name as it compares: no scheme of local files, no slash at the end."""
    return folder.removeprefix("file:").rstrip("/").replace("///", "/").replace("//", "/")


def shared_folder(session: SparkSession) -> str | None:
    """The folder that ``spark.checkpoint.dir`` names; a temporary one stands in for it only where it is unset and the master
    is local.  None if a checkpoint folder was set on the context alone."""
    folder = session.conf.get("spark.checkpoint.dir", None)
    if folder is None and session.sparkContext.getCheckpointDir() is None:
        if not session.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = os.path.join(tempfile.gettempdir(), "tallyframe-checkpoints")
    return folder


def scratch_path(session: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the application ends."""
    path = f"{(shared_folder(session) or session.sparkContext.getCheckpointDir()).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    jvm_path = session.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(session.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return path


def durable(df: DataFrame) -> DataFrame:
    """Cut lineage through a reliable checkpoint, so that later passes and lost executors do not redo the work.

    The folder is the shared one the session names in ``spark.checkpoint.dir`` (see ``shared_folder``).
    """
    context = df.sparkSession.sparkContext
    folder = shared_folder(df.sparkSession)
    if folder is not None:
        now = context.getCheckpointDir()  # Spark adds a folder of its own to the one it is given
        if now is None or _plain(now.rstrip("/").rpartition("/")[0]) != _plain(folder):
            context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
