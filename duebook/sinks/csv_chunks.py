"""CSV export in chunks of exactly N rows, one file each, written in parallel."""

from __future__ import annotations

import json
import re
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.session import discard, materialize

DEFAULT_CHUNK_ROWS = 1_000_000
_PART_BITS = 33
_RENAME_THREADS = 16

CSV_OPTIONS = {
    "header": "true",
    "nullValue": "",
    "emptyValue": "",
    "quote": '"',
    "escape": '"',
    # values are written as they are
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "dateFormat": "yyyy-MM-dd",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
}


def with_chunk(df: DataFrame, rows_per_chunk: int) -> DataFrame:
    """Add ``chunk``: row numbers over all partitions, cut every ``rows_per_chunk`` rows.

    Only one number per partition crosses the network: its row count, turned into an
    offset by the driver.  ``df`` is read twice and has to be a stored table.
    """
    spark = df.sparkSession
    numbered = df.withColumn("__id", F.monotonically_increasing_id())
    part = F.shiftright("__id", _PART_BITS)
    # one number per input partition
    counts = df.groupBy(F.spark_partition_id().cast("bigint").alias("p")).agg(F.count(F.lit(1)).alias("n"))
    before, rows = 0, []
    for p, n in sorted(tuple(r) for r in counts.collect()):
        rows.append((p, before))
        before += n
    offsets = spark.createDataFrame(rows, "__p bigint, __before bigint")
    joined = numbered.withColumn("__part", part).join(F.broadcast(offsets), F.col("__part") == F.col("__p"))
    number = F.col("__before") + F.col("__id") - F.shiftleft(F.col("__part"), _PART_BITS)
    return joined.select(*df.columns, F.floor(number / F.lit(rows_per_chunk)).cast("bigint").alias("chunk"))


def chunk_manifest(df: DataFrame, rows_per_chunk: int) -> DataFrame:
    """Rows per chunk."""
    return with_chunk(df, rows_per_chunk).groupBy("chunk").agg(F.count(F.lit(1)).alias("n_rows"))


def file_name(system: str, table: str, chunk: int) -> str:
    return f"{system}_{table}_{chunk:04d}.csv"


def delivery_path(root: str, client: str, environment: str) -> str:
    return "/".join(part.rstrip("/") for part in (root, client, environment) if part)


def write_chunks(
    df: DataFrame, folder: str, system: str, table: str, rows_per_chunk: int = DEFAULT_CHUNK_ROWS, staged: bool = False
) -> list[str]:
    """Write ``df`` as ``{system}_{table}_{0000}.csv`` files and return their paths.

    Every file has a header; an empty table gives no file.  The files are complete in a staging
    folder before any old file is touched; they are moved into place, files of a longer
    earlier export are removed, and the manifest ``{system}_{table}.json`` with the files and their rows
    is written last: an export without one, or with files it does not name, is unfinished.
    Pass ``staged`` if ``df`` already reads a stored table.
    """
    spark = df.sparkSession
    stored = df if staged else materialize(df)
    total = stored.count()
    chunks = -(-total // rows_per_chunk)
    fs, path = _filesystem(spark, folder)
    fs.mkdirs(path(folder))
    manifest = f"{folder}/{system}_{table}.json"
    staging = f"{folder}/_staging-{uuid.uuid4().hex}"
    try:
        if chunks:
            # one shuffle partition per chunk, so that every chunk becomes one file
            (
                with_chunk(stored, rows_per_chunk)
                .repartitionById(chunks, F.col("chunk").cast("int"))
                .write.options(**CSV_OPTIONS)
                .partitionBy("chunk")
                .csv(staging)
            )
        fs.delete(path(manifest), False)
        with ThreadPoolExecutor(_RENAME_THREADS) as pool:
            delivered = list(pool.map(lambda chunk: _deliver(fs, path, staging, folder, file_name(system, table, chunk), chunk), range(chunks)))
        own = re.compile(re.escape(f"{system}_{table}_") + r"[0-9]{4,}\.csv")
        kept = {file_name(system, table, chunk) for chunk in range(chunks)}
        for status in fs.listStatus(path(folder)):
            name = status.getPath().getName()
            if own.fullmatch(name) and name not in kept:
                fs.delete(status.getPath(), False)
        sizes = [min(rows_per_chunk, total - i * rows_per_chunk) for i in range(chunks)]
        content = {"rows": total, "files": [{"name": file_name(system, table, i), "rows": n} for i, n in enumerate(sizes)]}
        out = fs.create(path(manifest), True)
        try:
            out.write(bytearray(json.dumps(content).encode()))
        finally:
            out.close()
    finally:
        fs.delete(path(staging), True)
        if not staged:
            discard(stored)
    return delivered


def _deliver(fs, path, staging: str, folder: str, name: str, chunk: int) -> str:
    """Move the one file of a chunk to its place: a change of names, no data passes here."""
    source = [
        status.getPath()
        for status in fs.listStatus(path(f"{staging}/chunk={chunk}"))
        if status.getPath().getName().startswith("part-")
    ]
    if len(source) != 1:
        raise RuntimeError(f"chunk {chunk} has {len(source)} files")
    target = f"{folder}/{name}"
    fs.delete(path(target), False)
    if not fs.rename(source[0], path(target)):
        raise RuntimeError(f"cannot move chunk {chunk} to {target}")
    return target


def read_export(spark, folder: str, system: str, table: str, schema) -> DataFrame:
    """The rows of a finished export, read from the files that its manifest names."""
    fs, path = _filesystem(spark, folder)
    source = fs.open(path(f"{folder}/{system}_{table}.json"))
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()
    files = [f"{folder}/{entry['name']}" for entry in json.loads(text)["files"]]
    if not files:
        return spark.createDataFrame([], schema)
    options = {k: v for k, v in CSV_OPTIONS.items() if k not in ("nullValue", "emptyValue")}
    return spark.read.schema(schema).options(**options, multiLine="true").csv(files)


def export_table(
    spark, view: str, root: str, client: str, environment: str, system: str, rows_per_chunk: int = DEFAULT_CHUNK_ROWS
) -> list[str]:
    """Deliver a table or view, named by its last part, to ``root/client/environment``."""
    return write_chunks(
        spark.table(view), delivery_path(root, client, environment), system, view.split(".")[-1], rows_per_chunk
    )


def _filesystem(spark, folder: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs

    def path(text: str):
        return hadoop.Path(text)

    return path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path
