"""Tables in folders by the hash of their key, so that keys can be replaced on storage.

A reload reads and writes only the folders that hold an affected key; all others keep their
files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook.operators.updates import replace_by_key
from duebook.session import discard, materialize, remove

BUCKET = "bucket"


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def write_buckets(df: DataFrame, path: str, keys: list[str], buckets: int) -> None:
    """Write a whole table, one folder a bucket."""
    _bucketed(df, keys, buckets).write.partitionBy(BUCKET).mode("overwrite").parquet(path)


def _bucketed(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    rows = df.withColumn(BUCKET, bucket_of(keys, buckets))
    # a bucket goes to one task, unless adaptive execution splits it
    return rows.repartition(BUCKET)


def read_buckets(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table without the bucket number."""
    return spark.read.schema(schema).parquet(path).select(*[f"`{f.name}`" for f in schema.fields])


def replace_keys(spark: SparkSession, path: str, schema, affected: DataFrame, fresh: DataFrame, keys: list[str], buckets: int) -> list[int]:
    """Drop the affected keys, add ``fresh``, and return the numbers of the rewritten buckets."""
    named = affected.select(*keys).unionByName(fresh.select(*keys))
    touched = sorted(r[0] for r in named.select(bucket_of(keys, buckets)).distinct().collect())
    if not touched:
        return []
    whole = spark.read.parquet(path)
    old = whole.filter(F.col(BUCKET).isin(touched)).select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    # the new rows are complete before a folder is touched, because they are made of the old ones
    rows = materialize(replace_by_key(old, affected, fresh, {k: k for k in keys}).withColumn(BUCKET, bucket_of(keys, buckets)))
    filled = {r[0] for r in rows.select(BUCKET).distinct().collect()}
    rows.repartition(BUCKET).write.partitionBy(BUCKET).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    for number in set(touched) - filled:
        remove(spark, f"{path}/{BUCKET}={number}")
    discard(rows)
    return touched
