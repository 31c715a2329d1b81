"""Keep bookings up to date while booking runs arrive as files.

Each micro-batch stores only the bookings of its own runs and an index (run, timestamp, deleted, part).
Readers take every run in its newest version by the run's own timestamp, whenever it arrived, so an
older version that arrives late changes nothing.  Nothing stored before is rewritten, and a batch
repeated after a failure writes the same folders again.  A stream with another checkpoint writes to
folders of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from duebook.operators.latest import earliest, latest_per_key, newest
from duebook.plans.incremental import run_bookings
from duebook.session import discard, materialize
from duebook.sources.vault import schema_of


def newest_runs(batch: DataFrame) -> DataFrame:
    """The newest state of every run in a batch."""
    ranked = batch.withColumn("hash", _hash())
    return latest_per_key(ranked, ["id"], [newest("timestamp"), F.col("deleted").desc(), earliest("hash")]).drop("hash")


def _hash():
    return F.md5(F.coalesce("summary", F.lit("")))


def stream_bookings(spark: SparkSession, source: str, target: str, checkpoint: str) -> StreamingQuery:
    """Follow parquet files of booking runs under ``source`` until they are all applied."""

    def write(batch: DataFrame, batch_id: int) -> None:
        # the id of the stream lives in its checkpoint
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        part = f"part={stream}-{batch_id}"
        runs = materialize(newest_runs(batch))
        run_bookings(runs).write.mode("overwrite").parquet(f"{target}/bookings/{part}")
        index = runs.select("id", "timestamp", "deleted", _hash().alias("hash"))
        index.write.mode("overwrite").parquet(f"{target}/runs/{part}")
        discard(runs)

    return (
        spark.readStream.schema(schema_of("booking_runs"))
        .parquet(source)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_bookings(spark: SparkSession, target: str) -> DataFrame:
    """Bookings of every run in its newest version; of equal versions one is taken."""
    # the order of ``newest_runs``, so that versions in one batch and in several are treated alike
    order = [newest("timestamp"), F.col("deleted").desc(), earliest("hash"), earliest("part")]
    chosen = latest_per_key(spark.read.parquet(f"{target}/runs"), ["id"], order).select(
        F.col("id").alias("run"), F.col("part").alias("chosen")
    )
    bookings = spark.read.parquet(f"{target}/bookings")
    current = bookings.join(chosen, (F.col("source_run") == F.col("run")) & (F.col("part") == F.col("chosen")), "left_semi")
    return current.drop("part")
