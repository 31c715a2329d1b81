"""What the steps store and shuffle, on rows of their own."""

import pytest
from pyspark.sql import functions as F

from duebook.operators import numbering
from duebook.plans import bookings as book
from duebook.plans import open_items as items
from duebook.sources import sample_vault


@pytest.mark.parametrize("kind", ["occurrence_number", "row_numbers"])
def test_rows_do_not_carry_the_cuts_of_their_key(spark, rows, monkeypatch, kind):
    """Only the table of cuts has them, one row a key, and ranges are found without a function over all cuts."""
    plans, store = [], numbering.materialize

    def recorded(df):
        plans.append((df._jdf.queryExecution().toString(), df.columns))
        return store(df)

    monkeypatch.setattr(numbering, "materialize", recorded)
    df = spark.range(6000).select("id", (F.col("id") % 3).alias("k"), F.when(F.col("id") % 11 != 0, F.col("id") % 40).alias("o"))
    order = ["o"] if kind == "occurrence_number" else ["o", "id"]
    split = getattr(numbering, kind)(df, ["k"], order, "n", hot_rows=100)
    holding = [columns for _, columns in plans if "__cuts" in columns]
    assert [set(columns) for columns in holding] == [{"__h_k", "__cuts"}]
    text = "".join(plan for plan, columns in plans if "__cuts" not in columns) + split._jdf.queryExecution().toString()
    assert "filter(__cuts" not in text
    whole = getattr(numbering, kind)(df, ["k"], order, "n", hot_rows=None)
    assert rows(split) == rows(whole)


def _journal(table):
    """A vault with a journal of 40 items, some without sources, references or metadata."""
    n = range(40)
    tables = {
        "summaries": [{"uuid": f"S{i}", "create_time": f"2024-02-{1 + i % 9:02d} 10:00:00", "export": i % 4 != 0} for i in range(8)],
        "journal_entries": [{"uuid": f"J{i}", "summaries_uuid": f"S{i}", "id": f"D{i}", "date": "2024-02-10"} for i in range(8)],
        "journal_entry_items": [{"uuid": f"I{i}", "journal_entries_uuid": f"J{i % 8}" if i % 13 else None, "amount": i - 20, "account": "4000"} for i in n],
        "journal_entry_item_account_metadata": [{"journal_entry_items_uuid": f"I{i}", "type": "rfbibl", "key": k, "value": f"{k}{i % 5}"} for i in n if i % 5 for k in ("aufnr", "mwskz")],
        "journal_entry_item_sources": [{"uuid": f"Q{i}" if i % 9 else None, "journal_entry_items_uuid": f"I{i % 35}"} for i in n],
        "journal_entry_item_source_items": [
            {"journal_entry_item_sources_uuid": f"Q{i}", "amount": i, "amount_formula": "VAT", "transaction_items_uuid": f"X{i % 8}" if i % 6 else None, "transaction_item_taxes_uuid": f"Y{i % 8}" if i % 7 else None}
            for i in [*n, 3, 3]
        ],
        "transaction_items": [{"uuid": f"X{i}", "external_reference": f"A{i}"} for i in range(7)],
        "transaction_item_taxes": [{"uuid": f"Y{i}", "external_reference": f"{i}"} for i in range(7)],
        "payment_bookings": [{"id": f"A{i}", "payment_id": f"M{i}", "payment_state_id": "Z", "sap_id": f"D{i}"} for i in range(7)],
        "payments": [{"id": f"M{i}", "amount": i} for i in range(7)],
        "payment_states": [{"id": "Z", "payment_status": "PAID"}],
    }
    return {name: table(name, *content) for name, content in tables.items()}


def test_journal_in_slices_gives_the_same_rows(spark, table, rows, monkeypatch):
    vault = _journal(table)

    def both():
        bookings = book.journal_bookings(vault)
        paid = items.payment_bookings(vault["payment_bookings"], vault["payments"], vault["payment_states"], bookings)
        return bookings, rows(bookings), rows(paid)

    whole, *expected = both()
    assert not hasattr(whole, "stage_path") and all(expected)
    for module in (book, items):
        monkeypatch.setattr(module, "slices_for", lambda df: 3)
    sliced, *found = both()
    assert found == expected
    # stored slice after slice: no shuffle is left in the plan of the rows
    assert "Exchange" not in sliced._jdf.queryExecution().executedPlan().toString()


def test_sample_vault_keeps_one_copy_of_the_lines(spark, tmp_path, monkeypatch):
    """Source tables that are selections from lines and orders are not stored once more."""
    at = "timestamp '1996-01-02'"
    spark.sql(f"select cast(id as bigint) as o_orderkey, cast(1 as bigint) as o_custkey, {at} as o_orderdate from range(4)").write.parquet(f"{tmp_path}/orders.parquet")
    columns = "cast(id as bigint) as l_orderkey, 1 as l_linenumber, cast(5 as bigint) as l_partkey, cast(6 as bigint) as l_suppkey, 'R' as l_returnflag, 'O' as l_linestatus"
    numbers = "2.0D as l_quantity, 10.0D as l_extendedprice, 0.1D as l_tax, 0.2D as l_discount"
    spark.sql(f"select {columns}, {numbers}, {at} as l_shipdate from range(4)").write.parquet(f"{tmp_path}/lineitem.parquet")
    stored, store = [], sample_vault.materialize
    monkeypatch.setattr(sample_vault, "materialize", lambda df: stored.append(df) or store(df))
    vault = sample_vault.sample_vault(spark, str(tmp_path))
    for name in ("applied_billing_charge", "billing_account_balance", "applied_billing_tax_rate", "journal_entry_items"):
        plain = sample_vault.derived_table(spark, str(tmp_path), name)
        assert plain.exceptAll(vault[name]).isEmpty() and vault[name].count() == plain.count() > 0
    assert len(stored) == 1
