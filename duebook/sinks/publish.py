"""Publishing: build beside the old result, then swap."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from duebook.plans.open_items import customer_view
from duebook.sinks.csv_chunks import _filesystem


def publish_path(df: DataFrame, path: str) -> DataFrame:
    """Replace the parquet table at ``path``.

    The new data is complete before the old is touched, so ``df`` may read the old
    table, and a failed job leaves it in place.  The old table is moved aside, not deleted,
    until the new one stands in its place; if that move fails, it is put back.
    """
    spark = df.sparkSession
    fs, as_path = _filesystem(spark, path)
    fresh = f"{path}__new_{uuid.uuid4().hex}"
    df.write.parquet(fresh)
    old = f"{path}__old_{uuid.uuid4().hex}"
    replaced = fs.exists(as_path(path))
    if replaced and not fs.rename(as_path(path), as_path(old)):
        raise RuntimeError(f"cannot move {path} aside")
    if not fs.rename(as_path(fresh), as_path(path)):
        if replaced:
            fs.rename(as_path(old), as_path(path))
        raise RuntimeError(f"cannot move {fresh} to {path}")
    if replaced:
        fs.delete(as_path(old), True)
    return spark.read.schema(df.schema).parquet(path)


CURRENT = "_CURRENT"


def publish_version(df: DataFrame, root: str) -> DataFrame:
    """Publish ``df`` as a new version under ``root``; readers always find a whole version.

    The data is written to a folder of its own, then the small file ``_CURRENT`` is replaced in one
    step by one that names it.  The version before stays for readers that have opened it;
    older ones are removed.
    """
    spark = df.sparkSession
    fs, as_path = _filesystem(spark, root)
    before = current_version(spark, root)
    version = f"version-{uuid.uuid4().hex}"
    df.write.parquet(f"{root}/{version}")
    pointer = f"{root}/_{version}"
    out = fs.create(as_path(pointer), True)
    try:
        out.write(bytearray(version.encode()))
    finally:
        out.close()
    jvm = spark.sparkContext._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(as_path(root).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(as_path(pointer), as_path(f"{root}/{CURRENT}"), overwrite)
    for status in fs.listStatus(as_path(root)):
        if status.isDirectory() and status.getPath().getName() not in (version, before):
            fs.delete(status.getPath(), True)
    return spark.read.schema(df.schema).parquet(f"{root}/{version}")


def current_version(spark, root: str) -> str | None:
    """Name of the version that readers see, if there is one."""
    fs, as_path = _filesystem(spark, root)
    if not fs.exists(as_path(f"{root}/{CURRENT}")):
        return None
    source = fs.open(as_path(f"{root}/{CURRENT}"))
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def read_published(spark, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{current_version(spark, root)}")


def publish_list(rows: DataFrame, root: str, view: str) -> DataFrame:
    """Publish the list as a new version and register the customer view on it."""
    restricted = customer_view(publish_version(rows, root))
    restricted.createOrReplaceTempView(view)
    return restricted
