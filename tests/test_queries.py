import datetime as dt

import duckdb
import pytest

import __spark_entry__ as entry
from duebook import checks
from duebook.plans import build as b
from duebook.sources.sample_vault import sample_vault
from oracle import statements

FOLDER = "/root/testdata/sf0.001"
TABLES = ["customer", "orders", "lineitem", "part", "events"]
CHECKED = [
    "latest_event_per_user", "pattern_join_parts", "running_numbers", "running_occurrences", "propagate_due_dates",
    "charges", "overpayment_cross_match", "numbered_due_charges", "due_cancelled_charges", "json_bookings",
    "journal_tax_bookings", "incremental_equals_full", "chunk_rows",
]


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return connection


def test_every_check_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(statements.all_statements()) == set(checks.registered())


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_check_sql(spark, engine, name):
    def norm(found, columns):
        order = sorted(range(len(columns)), key=lambda i: columns[i])
        return sorted(tuple(str(row[i]) for i in order) for row in found)

    df = entry.queries()[name](spark, FOLDER)
    cursor = engine.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert norm(df.collect(), df.columns) == norm(cursor.fetchall(), columns)


def test_list_invariants(spark):
    vault = sample_vault(spark, FOLDER)
    rows = b.build(vault, dt.date(2024, 1, 15), ledger="documents").cache()
    assert rows.filter("booking_debit_amount is not null and booking_credit_amount is not null").isEmpty()
    open_rows = rows.filter("due_date is not null")
    assert open_rows.count() == open_rows.select("applied_billing_charge_ouid").distinct().count()
    rows.unpersist()


@pytest.mark.parametrize("name", ["base_charges", "numbered_due_charges", "json_bookings", "tax_amounts", "journal_bookings"])
def test_no_nested_loops_even_without_broadcasts(spark, capsys, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        entry.queries()[name](spark, FOLDER).explain()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    plan = capsys.readouterr().out
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "SinglePartition" not in plan
