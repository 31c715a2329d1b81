"""Session settings and lineage cuts shared by all plans."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# SQL settings the plans are written for.  All of them can be set on a live session.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join partition even when that costs one more exchange later on
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


# folders of local sessions, removed when the process ends
_LOCAL_FOLDERS: list[tempfile.TemporaryDirectory] = []


def configure(spark: SparkSession) -> SparkSession:
    """Apply the recommended SQL settings to an existing session."""
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int = 8, shuffle_partitions: int | None = None, app: str = "duebook") -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", os.environ.get("DUEBOOK_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
    )
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts, taken from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            _LOCAL_FOLDERS.append(tempfile.TemporaryDirectory(prefix="duebook-checkpoint-"))
            folder = _LOCAL_FOLDERS[-1].name
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


# the folder of the current run, if stages are to be removed with it
_RUN: ContextVar[str | None] = ContextVar("duebook_run", default=None)


@contextmanager
def stages(spark: SparkSession):
    """Keep all stages written inside in one folder and remove it at the end.

    What is made inside has to be written to its own place before the end.
    """
    folder = f"{checkpoint_dir(spark)}/run-{uuid.uuid4().hex}"
    token = _RUN.set(folder)
    try:
        yield folder
    finally:
        _RUN.reset(token)
        remove(spark, folder)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system it is."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


# shuffle files go when the query that made them ends, not when the driver happens to collect its garbage
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(*parts: DataFrame, compression: str = "snappy") -> DataFrame:
    """Write ``parts`` to one stage in the shared checkpoint folder, one after the other, and continue from the files.

    A parquet table rather than an RDD checkpoint: later steps read only the columns
    they need and the planner sees true sizes.  Lost executors cost nothing, because
    the files do not live on them.  The shuffle files of a part go before the next one is written.
    """
    spark = parts[0].sparkSession
    path = f"{_RUN.get() or checkpoint_dir(spark)}/stage-{uuid.uuid4().hex}"
    before = spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        for part in parts:
            part.write.mode("append").option("compression", compression).parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLE_CLEANUP)
        else:
            spark.conf.set(_SHUFFLE_CLEANUP, before)
    stored = spark.read.schema(parts[0].schema).parquet(path)
    stored.stage_path = path
    return stored


def discard(*stored: DataFrame) -> None:
    """Remove stages that no later step reads."""
    for df in stored:
        remove(df.sparkSession, df.stage_path)
