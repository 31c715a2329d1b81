import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from duebook.plans.open_items import CUSTOMER_COLUMNS, LIST_COLUMNS, customer_view
from duebook.sinks.buckets import read_buckets, replace_keys, write_buckets
from duebook.sinks.csv_chunks import chunk_manifest, delivery_path, export_table, file_name, read_export, write_chunks
from duebook.sinks.publish import publish_path, publish_version, read_published


def lines(path):
    with open(path, newline="") as handle:
        return handle.read()


def test_chunks_are_exact(spark, tmp_path):
    df = spark.range(0, 25, 1, 4)
    files = write_chunks(df, str(tmp_path), "system", "large", 10)
    assert [os.path.basename(f) for f in files] == [f"system_large_000{i}.csv" for i in range(3)]
    assert [lines(f).count("\n") for f in files] == [11, 11, 6]
    ids = sorted(int(x) for f in files for x in lines(f).split()[1:])
    assert ids == list(range(25))
    found = sorted(p for p in os.listdir(tmp_path) if not p.startswith("."))
    assert found == ["system_large.json", *[os.path.basename(f) for f in files]]
    assert read_export(spark, str(tmp_path), "system", "large", df.schema).count() == 25


def test_a_shorter_export_leaves_nothing_stale(spark, tmp_path):
    target = str(tmp_path)
    write_chunks(spark.range(95), target, "system", "large", 10)
    write_chunks(spark.range(5), target, "system", "large_other", 10)
    write_chunks(spark.range(25), target, "system", "large", 10)
    names = sorted(p for p in os.listdir(target) if p.endswith(".csv"))
    assert names == ["system_large_0000.csv", "system_large_0001.csv", "system_large_0002.csv", "system_large_other_0000.csv"]
    write_chunks(spark.range(0), target, "system", "large", 10)
    assert [p for p in os.listdir(target) if p.endswith(".csv")] == ["system_large_other_0000.csv"]
    assert read_export(spark, target, "system", "large", "id long").isEmpty()


def test_a_failed_export_keeps_the_old_one(spark, tmp_path):
    target = str(tmp_path)
    write_chunks(spark.range(25), target, "system", "large", 10)
    before = sorted(os.listdir(target))
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        write_chunks(spark.range(5).select((F.lit(1) / (F.col("id") - 3)).alias("id")), target, "system", "large", 10, staged=True)
    assert sorted(os.listdir(target)) == before
    assert read_export(spark, target, "system", "large", "id long").count() == 25


def test_versions_are_switched_by_one_file(spark, tmp_path):
    root = str(tmp_path / "list")
    first = publish_version(spark.range(3), root)
    second = publish_version(read_published(spark, root).withColumn("id", F.col("id") + 10), root)
    # readers of the version before still find their files
    assert first.count() == 3 and sorted(r.id for r in second.collect()) == [10, 11, 12]
    publish_version(spark.range(1), root)
    assert read_published(spark, root).count() == 1
    assert len([p for p in os.listdir(root) if p.startswith("version-")]) == 2
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        publish_version(spark.range(5).select((F.lit(1) / (F.col("id") - 3)).alias("id")), root)
    assert read_published(spark, root).count() == 1


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    path, keys = str(tmp_path / "table"), ["k"]
    df = spark.range(200).select((F.col("id") % 50).alias("k"), F.col("id").alias("v"))
    write_buckets(df, path, keys, 8)

    def files():
        return {os.path.join(at, n) for at, _, names in os.walk(path) for n in names if n.endswith(".parquet")}

    before = files()
    affected = spark.createDataFrame([(7,), (None,)], "k long")
    fresh = spark.createDataFrame([(7, -1), (51, -2), (None, 3)], "k long, v long")
    touched = replace_keys(spark, path, df.schema, affected, fresh, keys, 8)
    expected = df.filter("k <> 7").unionByName(fresh)
    got = read_buckets(spark, path, df.schema)
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()
    kept = {f for f in before if int(f.split("bucket=")[1].split("/")[0]) not in touched}
    assert kept and kept <= files() and 0 < len(touched) < 8
    # a bucket that loses its last row disappears
    number = touched[0]
    own = got.filter(F.pmod(F.xxhash64("k"), F.lit(8)) == number).select("k").distinct()
    replace_keys(spark, path, df.schema, own.filter("k is not null"), fresh.limit(0), keys, 8)
    assert read_buckets(spark, path, df.schema).filter(F.pmod(F.xxhash64("k"), F.lit(8)) == number).filter("k is not null").isEmpty()
    assert replace_keys(spark, path, df.schema, affected.limit(0), fresh.limit(0), keys, 8) == []


def test_a_run_delivers_and_cleans_up(spark, vault, tmp_path):
    import datetime as dt

    from duebook.plans.run import run
    from duebook.session import checkpoint_dir

    v = vault(
        payment_bookings=[{"id": "a", "payment_id": "p", "payment_state_id": "s", "sap_id": "d"}],
        payments=[{"id": "p", "amount": 5}],
        payment_states=[{"id": "s", "payment_status": "OK"}],
        summaries=[{"uuid": "s", "export": "true", "create_time": "2024-03-02 00:00:00"}],
        journal_entries=[{"uuid": "e", "summaries_uuid": "s", "id": "d"}],
        journal_entry_items=[{"uuid": "i1", "journal_entries_uuid": "e", "amount": -1230}],
    )
    before = set(os.listdir(checkpoint_dir(spark).removeprefix("file:")))
    result = run(v, dt.date(2024, 3, 3), "client", "prod", str(tmp_path / "list"), str(tmp_path / "out"), ["one", "two"])
    assert [os.path.relpath(f, tmp_path / "out") for f in result.exported["two"]] == ["client/prod/two_open_items_customer_0000.csv"]
    assert lines(result.exported["one"][0]).count("\n") == 2
    assert lines(result.archived[0]).startswith(",".join(LIST_COLUMNS))
    left = set(os.listdir(checkpoint_dir(spark).removeprefix("file:"))) - before
    assert not [name for name in left if name.startswith("run-") or name.startswith("stage-")]


@pytest.mark.parametrize("total, size, expected", [(100, 1000, 1), (1000, 1000, 1), (2500, 1000, 3), (1001, 1000, 2)])
def test_chunk_counts(spark, total, size, expected):
    manifest = chunk_manifest(spark.range(total), size).orderBy("chunk").collect()
    assert len(manifest) == expected
    assert [r.chunk for r in manifest] == list(range(expected)) and sum(r.n_rows for r in manifest) == total


def test_nulls_and_escaping(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, 'Text with "quotes"'), (2, "Text, comma"), (3, "new\nline"), (4, None), (5, " kept ")], "id int, description string"
    ).coalesce(1)
    (path,) = write_chunks(df, str(tmp_path), "s", "t")
    assert lines(path) == (
        'id,description\n1,"Text with ""quotes"""\n2,"Text, comma"\n3,"new\nline"\n4,\n5, kept \n'
    )


def test_empty_table_gives_no_file(spark, tmp_path):
    assert write_chunks(spark.range(0), str(tmp_path), "s", "t") == []


def test_export_of_a_view(spark, tmp_path):
    spark.range(3).createOrReplaceTempView("small_view")
    (path,) = export_table(spark, "small_view", str(tmp_path), "client", "prod", "sys")
    assert path == f"{tmp_path}/client/prod/sys_small_view_0000.csv"
    export_table(spark, "small_view", str(tmp_path), "client", "prod", "sys")
    assert lines(path).count("\n") == 4
    with pytest.raises(AnalysisException, match="non_existing"):
        export_table(spark, "non_existing", str(tmp_path), "client", "prod", "sys")


def test_names():
    assert file_name("tri", "results", 9999) == "tri_results_9999.csv"
    assert delivery_path("path/", "", "x") == "path/x"


def test_publish_replaces_and_may_read_the_old(spark, tmp_path):
    path = str(tmp_path / "result")
    publish_path(spark.range(3), path)
    publish_path(spark.read.parquet(path).withColumn("id", F.col("id") + 10), path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [10, 11, 12]
    assert os.listdir(tmp_path) == ["result"]


def test_customer_view_is_part_of_the_list(spark):
    assert len(LIST_COLUMNS) == 41 and len(CUSTOMER_COLUMNS) == 33
    empty = spark.range(0).select(*[F.lit(None).cast(t).alias(c) for c, t in LIST_COLUMNS.items()])
    assert customer_view(empty).columns == CUSTOMER_COLUMNS


def test_broken_source_is_not_missing(spark, tmp_path):
    from duebook.sources.vault import from_parquet

    spark.createDataFrame([(1, "x")], "id long, renamed string").write.parquet(f"{tmp_path}/claims")
    vault = from_parquet(spark, str(tmp_path))
    assert not vault.has("dunning_claims") and vault.optional("dunning_claims").isEmpty()
    with pytest.raises(ValueError):
        vault.has("claims")
