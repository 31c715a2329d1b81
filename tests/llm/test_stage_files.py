"""What stages leave on disk."""

import time

from pyspark.sql import functions as F

from duebook.session import materialize


def test_stages_leave_no_shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled() -> set[str]:
        files = disk.getAllFiles()
        names = (files.apply(i).getName() for i in range(files.size()))
        return {name for name in names if name.startswith("shuffle_") and name.endswith(".data")}

    before = shuffled()
    rows = spark.range(50_000).repartition(5, (F.col("id") % 97).alias("k")).groupBy((F.col("id") % 89).alias("k")).agg(F.sum("id").alias("n"))
    stored = materialize(rows)
    until = time.time() + 10
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - before
    assert stored.count() == 89
