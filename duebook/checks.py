"""Registered queries: every operator and transform on the generated tables.

Each takes (session, folder) and returns a DataFrame.  Transforms run on the sample
vault derived from the tables.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook.functions.amounts import (
    INVERTED_GLID,
    charge_sign,
    german_decimal,
    parse_german_decimal,
    units,
)
from duebook.functions.dates import german_date, hour_of, local_date
from duebook.functions.fingerprint import row_fingerprint
from duebook.functions.text import attribute, comma_list, concat_skipping_nulls, safe_id
from duebook.operators import joins, latest, numbering, patterns, shape, updates
from duebook.plans import balances as bal
from duebook.plans import bookings as book
from duebook.plans import build as b
from duebook.plans import charges as chg
from duebook.plans import due_dates as due
from duebook.plans import dunning as dun
from duebook.plans import incremental as inc
from duebook.plans import incremental_list as inc_list
from duebook.plans import open_items as items
from duebook.plans import overpayments as over
from duebook.session import checkpoint_dir, configure, materialize
from duebook.sinks.buckets import read_buckets, replace_keys, write_buckets
from duebook.sinks.csv_chunks import chunk_manifest, read_export, write_chunks
from duebook.sinks.publish import publish_list, read_published
from duebook.sources.documents import malformed_runs as malformed
from duebook.sources.documents import parse_documents
from duebook.sources.lookups import WITH_VAT_ACCOUNTS
from duebook.sources.sample_vault import raw_table, sample_vault
from duebook.sources.vault import Vault

AS_OF = dt.date(2024, 1, 15)
EARLIER = dt.date(2024, 1, 5)
CLIENT = "sample"
OVERLAYS = {CLIENT: WITH_VAT_ACCOUNTS}
LOOKUPS = WITH_VAT_ACCOUNTS
PART_PATTERNS = [("%ring", "%"), ("small%", "%"), ("%bolt", "Brand#1%"), ("%o%", "Brand#_"), ("red widget", "%")]
CHUNK_ROWS = 10_000

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register a query under its function name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(configure(spark), folder)

    _QUERIES[fn.__name__] = run
    return run


def on_vault(fn: Callable[[Vault], DataFrame]) -> Query:
    """Register a query on the sample vault."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(sample_vault(configure(spark), folder))

    _QUERIES[fn.__name__] = run
    return run


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


# --- generic operators on the raw tables -----------------------------------------


@query
def latest_event_per_user(spark, folder):
    events = raw_table(spark, folder, "events").select("user_id", "event_id", "event_type", "ts")
    return latest.latest_per_key(events, ["user_id"], [latest.newest("ts"), latest.newest("event_id")])


@query
def top_row_per_order(spark, folder):
    lines = raw_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    order = [latest.newest(c) for c in ("l_extendedprice", "l_linenumber", "l_partkey", "l_suppkey")]
    return latest.latest_per_key(lines, ["l_orderkey"], order)


@query
def pattern_join_parts(spark, folder):
    parts = raw_table(spark, folder, "part").select("p_partkey", "p_name", "p_brand")
    return patterns.pattern_join(parts, [F.col("p_name"), F.col("p_brand")], PART_PATTERNS, "pattern")


@query
def pattern_match_once(spark, folder):
    parts = raw_table(spark, folder, "part").select("p_partkey", "p_name", "p_brand")
    return patterns.pattern_join(
        parts, [F.col("p_name"), F.col("p_brand")], PART_PATTERNS, "pattern", match_once=True
    )


@query
def update_from_orders(spark, folder):
    customers = raw_table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    # a matched null overwrites as well
    source = raw_table(spark, folder, "orders").select(
        "o_custkey", F.when(F.col("o_custkey") % 3 != 0, F.col("o_orderpriority")).alias("priority")
    )
    return updates.update_from(customers, source, {"c_custkey": "o_custkey"}, {"c_mktsegment": "priority"})


@query
def fill_if_null(spark, folder):
    customers = raw_table(spark, folder, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("segment")
    )
    orders = raw_table(spark, folder, "orders").select("o_custkey", "o_orderpriority")
    return updates.fill_from(customers, orders, {"c_custkey": "o_custkey"}, {"segment": "o_orderpriority"})


@query
def conditional_update(spark, folder):
    orders = raw_table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    urgent = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).like("1-%")
    return updates.set_where(orders, urgent, {"o_orderstatus": F.lit("U")})


@query
def delete_where(spark, folder):
    events = raw_table(spark, folder, "events").select("event_id", "event_type")
    # null for purchases, which therefore stay
    doomed = F.when(F.col("event_type") != "purchase", F.col("event_type").isin("error", "view"))
    return updates.delete_where(events, doomed)


@query
def anti_join(spark, folder):
    orders = raw_table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    lines = raw_table(spark, folder, "lineitem").filter(F.col("l_returnflag") == "R")
    return updates.delete_using(orders, lines, {"o_orderkey": "l_orderkey"})


@query
def semi_join(spark, folder):
    orders = raw_table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    lines = raw_table(spark, folder, "lineitem").filter(F.col("l_returnflag") == "R")
    return updates.keep_using(orders, lines, {"o_orderkey": "l_orderkey"})


@query
def full_outer_merge(spark, folder):
    orders, events = raw_table(spark, folder, "orders"), raw_table(spark, folder, "events")
    by_customer = orders.groupBy(F.col("o_custkey").alias("person")).agg(F.count(F.lit(1)).alias("n_orders"))
    by_user = events.groupBy((F.col("user_id") * 2).alias("person")).agg(F.count(F.lit(1)).alias("n_events"))
    return joins.full_merge(by_customer, by_user, "person")


@query
def hour_join(spark, folder):
    """Pairs of events of a user within the same hour."""
    events = raw_table(spark, folder, "events").select("event_id", "user_id", hour_of("ts").alias("hour"))
    later = events.select(F.col("event_id").alias("later_id"), F.col("user_id").alias("l_user"), F.col("hour").alias("l_hour"))
    match = (F.col("user_id") == F.col("l_user")) & (F.col("hour") == F.col("l_hour")) & (F.col("event_id") < F.col("later_id"))
    return events.join(later, match).select("event_id", "later_id", "user_id", "hour")


@query
def abs_join(spark, folder):
    def cents(name):
        return F.round(F.col(name) * 100).cast("bigint")

    lines = raw_table(spark, folder, "lineitem")
    paid = lines.select("l_orderkey", "l_partkey", "l_suppkey", (-cents("l_extendedprice")).alias("paid"))
    prices = lines.select(F.col("l_orderkey").alias("other_order"), cents("l_extendedprice").alias("price")).distinct()
    return paid.join(prices, F.abs("paid") == F.abs("price")).select("l_orderkey", "l_partkey", "l_suppkey", "other_order", "paid")


@query
def running_numbers(spark, folder):
    """Numbering that cuts hot keys into ranges, forced by a low limit."""
    events = raw_table(spark, folder, "events").select("event_id", "user_id", "event_type")
    return numbering.row_numbers(events, ["event_type"], ["user_id", "event_id"], "number", hot_rows=1000)


@query
def running_occurrences(spark, folder):
    """Peers count together: the value is not unique within a key."""
    lines = raw_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int").alias("quantity")
    )
    return numbering.occurrence_number(lines, ["l_linenumber"], ["quantity"], "cnt", hot_rows=2000)


@query
def partition_total(spark, folder):
    orders = raw_table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents")
    )
    return numbering.key_total(orders, ["o_custkey"], "cents", "total")


@query
def having_imbalance(spark, folder):
    orders = raw_table(spark, folder, "orders")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    sides = orders.groupBy("o_custkey").agg(
        F.sum(F.when(F.col("o_orderstatus") == "F", cents)).alias("debit"),
        F.sum(F.when(F.col("o_orderstatus") == "O", cents)).alias("credit"),
    )
    return sides.filter(F.col("debit") != F.col("credit"))


@query
def count_distinct_having(spark, folder):
    lines = raw_table(spark, folder, "lineitem")
    return (
        lines.groupBy("l_orderkey")
        .agg(F.count_distinct("l_returnflag").alias("n_flags"), F.count(F.lit(1)).alias("n_lines"))
        .filter(F.col("n_flags") > 1)
    )


@query
def union_distinct(spark, folder):
    lines = raw_table(spark, folder, "lineitem")
    orders = raw_table(spark, folder, "orders")
    return shape.union_distinct(
        lines.filter(F.col("l_tax") == 0).select(F.col("l_orderkey").alias("orderkey")),
        lines.filter(F.col("l_discount") == 0).select(F.col("l_orderkey").alias("orderkey")),
        orders.filter(F.col("o_orderstatus") == "P").select(F.col("o_orderkey").alias("orderkey")),
    )


@query
def except_all(spark, folder):
    lines = raw_table(spark, folder, "lineitem")
    shipped = lines.select("l_orderkey", "l_returnflag")
    returned = lines.filter(F.col("l_linestatus") == "O").select("l_orderkey", "l_returnflag")
    return shipped.exceptAll(returned)


# --- scalar functions ------------------------------------------------------------


@query
def german_decimals(spark, folder):
    lines = raw_table(spark, folder, "lineitem")
    text = german_decimal(F.round(F.col("l_extendedprice") * 100).cast("decimal(20,2)"))
    return lines.select("l_orderkey", "l_partkey", "l_suppkey", text.alias("text"), parse_german_decimal(text).alias("value"))


@query
def berlin_dates(spark, folder):
    return raw_table(spark, folder, "events").select("event_id", local_date("ts").alias("day"))


@query
def german_dates(spark, folder):
    text = F.date_format("o_orderdate", "dd.MM.yyyy")
    text = F.when(F.col("o_orderkey") % 10 == 0, F.lit("no date")).otherwise(text)
    return raw_table(spark, folder, "orders").select("o_orderkey", german_date(text).alias("day"))


@query
def safe_ids(spark, folder):
    """Ids from texts, some of which are none."""
    text = F.when(F.col("event_type") == "click", F.col("event_type")).otherwise(F.col("event_id").cast("string"))
    return raw_table(spark, folder, "events").select("event_id", safe_id(text).alias("parsed"))


@on_vault
def inverted_signs(vault):
    charge = vault["applied_billing_charge"]
    return charge.select(
        "ouid",
        charge_sign("glid").alias("sign"),
        F.col("glid").rlike(INVERTED_GLID).alias("inverted"),
        units("taxincludedamount").alias("gross"),
    )


@query
def json_attributes(spark, folder):
    props = attribute("props", "k").cast("bigint")
    return raw_table(spark, folder, "events").select(
        "event_id", props.alias("k"), attribute("props", "missing").alias("missing")
    )


@query
def comma_lists(spark, folder):
    names = raw_table(spark, folder, "part").select(
        "p_partkey", F.explode(comma_list(F.replace("p_name", F.lit(" "), F.lit(",")))).alias("word")
    )
    return names


@query
def md5_fingerprints(spark, folder):
    events = raw_table(spark, folder, "events")
    maybe = F.when(F.col("event_type") != "view", F.col("event_type"))
    return events.select(
        "event_id",
        row_fingerprint("event_id", maybe, "props").alias("hash"),
        concat_skipping_nulls(F.lit("x"), maybe).alias("joined"),
    )


# --- accounts, due dates ---------------------------------------------------------


@on_vault
def account_map(vault):
    return due.account_map(vault["billing_account"], vault["billing_account_relationship"])


@on_vault
def balance_dates(vault):
    return due.balance_dates(vault["billing_account_balance"])


@on_vault
def original_due_dates(vault):
    return due.original_due_dates(vault["applied_billing_charge"], due.balance_dates(vault["billing_account_balance"]))


@on_vault
def reject_edges(vault):
    return due.reject_edges(vault["applied_billing_charge"])


@on_vault
def propagate_due_dates(vault):
    return b.propagated_due_dates(vault)


@on_vault
def override_request_due(vault):
    return due.override_request_due(
        b.propagated_due_dates(vault), vault["applied_billing_charge"], vault["payment_request"]
    )


@on_vault
def override_partial_due(vault):
    charge = vault["applied_billing_charge"]
    rows = due.override_request_due(b.propagated_due_dates(vault), charge, vault["payment_request"])
    return due.override_partial_due(rows, charge)


@on_vault
def due_overrides(vault):
    return b.overridden_due_dates(vault)


@on_vault
def balance_due_dates(vault):
    return due.apply_due_to_balance(due.balance_dates(vault["billing_account_balance"]), b.overridden_due_dates(vault))


@on_vault
def split_status(vault):
    return due.split_status_transactions(vault["billing_account_balance"])


@on_vault
def split_charge_dates(vault):
    balance = vault["billing_account_balance"]
    return due.charge_balance_dates(balance, due.split_status_transactions(balance), vault["applied_billing_charge"])


@on_vault
def charge_balance_dates(vault):
    return b.due_dates(vault).per_charge_balance


@on_vault
def charge_due_dates(vault):
    return due.charge_due_dates(vault["applied_billing_charge"], vault["settlement_note_advice"])


@on_vault
def migrated_bill_due(vault):
    return due.migrated_bill_due(vault["payment_request"])


# --- dunning and write-offs ------------------------------------------------------


@on_vault
def latest_case(vault):
    return dun.latest_case(vault["case_receivables"])


@on_vault
def active_locks(vault):
    return dun.active_locks(vault["dunning_locks"], AS_OF)


@on_vault
def case_lock_merge(vault):
    return dun.case_lock_merge(dun.latest_case(vault["case_receivables"]), dun.active_locks(vault["dunning_locks"], AS_OF))


@on_vault
def dunning_state(vault):
    return dun.dunning(vault, AS_OF)


@on_vault
def write_offs(vault):
    return b.write_off_rows(vault)


# --- charges ---------------------------------------------------------------------


@on_vault
def base_charges(vault):
    return b.base_charge_rows(vault, AS_OF).distinct()


@on_vault
def can_be_due(vault):
    charge = vault["applied_billing_charge"].select("ouid", "glid", "analyticaxis", F.lit(True).alias("can_be_due"))
    return chg.can_be_due(charge)


@on_vault
def filled_bill_ids(vault):
    charge = vault["applied_billing_charge"]
    rows = charge.select("ouid", "transactionid", F.when(F.col("ouid") % 2 == 0, F.lit("known")).alias("bill_id"))
    return chg.fill_bill_id(rows, chg.found_bills(charge, vault["product"]))


@on_vault
def aggregate_signs(vault):
    return chg.aggregate_signs(vault["applied_billing_tax_rate"], vault["applied_billing_charge"])


@on_vault
def charge_taxes(vault):
    return chg.charge_taxes(vault["applied_billing_tax_rate"])


@on_vault
def charges(vault):
    return b.charge_rows(vault, AS_OF)


@on_vault
def tax_amounts(vault):
    return b.tax_amounts(vault)


@on_vault
def charge_tax_link(vault):
    return b.tax_link(vault)


# --- overpayments, balances, cancelled charges -----------------------------------


@on_vault
def overpayment_used(vault):
    return over.used_dates(vault["applied_billing_charge"])


@on_vault
def overpayment_rejected(vault):
    return over.rejected(vault["applied_billing_charge"])


@on_vault
def overpayment_refund_cancelled(vault):
    return over.refund_cancelled(
        vault["applied_billing_charge"], vault["billing_account_balance"], vault["payment_item"], vault["payment_request"]
    )


@on_vault
def overpayment_request_rejected(vault):
    return over.request_rejected(vault["applied_billing_charge"], vault["payment_request"])


@on_vault
def overpayment_payment_cancelled(vault):
    return over.payment_cancelled(
        vault["applied_billing_charge"], vault["payment_request"], vault["billing_account_balance"]
    )


@on_vault
def overpayment_cross_match(vault):
    return over.cross_match(
        vault["applied_billing_charge"], vault["payment_request"], vault["payment_item"], vault["billing_account_balance"]
    )


@on_vault
def overpayment_dates(vault):
    return over.all_overpayment_dates(vault)


@on_vault
def balances(vault):
    return b.balance_rows(vault)


@on_vault
def numbered_due_charges(vault):
    return bal.numbered_due_charges(vault["applied_billing_charge"], LOOKUPS.due_types)


@on_vault
def numbered_due_charges_once(vault):
    return bal.numbered_due_charges(vault["applied_billing_charge"], LOOKUPS.due_types, match_once=True)


@on_vault
def numbered_cancelled_balances(vault):
    return bal.numbered_cancelled_balances(vault["billing_account_balance"])


@on_vault
def due_cancelled_charges(vault):
    return b.cancelled_rows(vault, LOOKUPS)


# --- ledger ----------------------------------------------------------------------


@on_vault
def json_segments(vault):
    rows = book.json_segments(parse_documents(vault["booking_runs"]))
    related = F.array_join("related_aggregate_ids", ",").alias("related")
    return rows.select(*[c for c in rows.columns if c not in ("position", "related_aggregate_ids")], related)


@on_vault
def json_headers(vault):
    return book.json_headers(parse_documents(vault["booking_runs"]))


@on_vault
def json_raw_segments(vault):
    return book.json_raw_segments(parse_documents(vault["booking_runs"]))


@on_vault
def json_tax_bookings(vault):
    return book.ledger_from_documents(vault, LOOKUPS).tax_bookings


@on_vault
def json_bookings(vault):
    return book.ledger_from_documents(vault, LOOKUPS).bookings


@on_vault
def account_metadata(vault):
    return book.account_metadata(vault["journal_entry_item_account_metadata"])


@on_vault
def journal_bookings(vault):
    return book.journal_bookings(vault)


@on_vault
def journal_tax_bookings(vault):
    return book.journal_tax_bookings(vault, LOOKUPS.vat_accounts_df(vault.spark))


@on_vault
def journal_headers(vault):
    return book.journal_headers(vault)


# --- the list --------------------------------------------------------------------


@on_vault
def open_items(vault):
    return items.open_items(
        b.charge_rows(vault, AS_OF),
        LOOKUPS.due_types,
        book.journal_bookings(vault),
        b.cancelled_rows(vault, LOOKUPS),
        over.all_overpayment_dates(vault),
    )


@on_vault
def booked_charges(vault):
    charge_rows = materialize(b.charge_rows(vault, AS_OF))
    return items.booked_charges(charge_rows, b.tax_link(vault), book.journal_bookings(vault), b.tax_amounts(vault))


@on_vault
def booked_charges_from_documents(vault):
    charge_rows = materialize(b.charge_rows(vault, AS_OF))
    bookings = book.ledger_from_documents(vault, LOOKUPS).bookings
    return items.booked_charges(charge_rows, b.tax_link(vault), bookings, b.tax_amounts(vault))


@on_vault
def booked_balances(vault):
    return items.booked_balances(b.balance_rows(vault), book.journal_bookings(vault))


@on_vault
def booked_taxes(vault):
    ledger = book.ledger_from_journal(vault, LOOKUPS)
    return items.booked_taxes(ledger.tax_bookings, b.charge_rows(vault, AS_OF), ledger.headers)


@on_vault
def payment_bookings(vault):
    return items.payment_bookings(
        vault["payment_bookings"], vault["payments"], vault["payment_states"], book.journal_bookings(vault)
    )


@on_vault
def fix_imbalance(vault):
    bookings = book.journal_bookings(vault)
    paid = items.payment_bookings(vault["payment_bookings"], vault["payments"], vault["payment_states"], bookings)
    rows = items.booked_balances(b.balance_rows(vault), bookings).unionByName(paid)
    return items.fix_imbalance(materialize(rows))


@on_vault
def open_item_list(vault):
    return b.build(vault, AS_OF, CLIENT, OVERLAYS)


@on_vault
def customer_view(vault):
    return items.customer_view(b.build(vault, AS_OF, CLIENT, OVERLAYS, ledger="documents"))


# --- incremental reload ----------------------------------------------------------


def earlier_vault(vault: Vault) -> Vault:
    """An earlier state: some rows were not there yet, some had other values, some are gone since."""
    day = F.expr("interval 1 day")
    charge = vault["applied_billing_charge"].filter(F.col("ouid") % 7 != 0)
    older = F.col("ouid") % 5 == 0
    charge = charge.withColumns(
        {
            "datetimelastmodif": F.when(older, F.col("datetimelastmodif") - day).otherwise(F.col("datetimelastmodif")),
            "taxincludedamount": F.when(older, F.col("taxincludedamount") + 1)
            .otherwise(F.col("taxincludedamount"))
            .cast("decimal(20,2)"),
        }
    )
    account = vault["billing_account"].filter(F.col("ouid") % 10 != 9)
    login = vault["login"].withColumn(
        "externalid", F.when(F.col("ouid") % 11 == 0, F.lit("old")).otherwise(F.col("externalid"))
    )
    tax = vault["applied_billing_tax_rate"].filter(F.col("datetimelastmodif") < F.lit("2024-06-01").cast("timestamp_ntz"))
    request = vault["payment_request"].withColumn(
        "daterequest", F.when(F.col("ouid") % 12 == 0, F.col("daterequest") - day).otherwise(F.col("daterequest"))
    )
    note = vault["settlement_note_advice"].withColumn(
        "id", F.when(F.col("ouid") % 15 == 0, F.concat(F.col("id"), F.lit("-old"))).otherwise(F.col("id"))
    )
    return vault.replacing(
        applied_billing_charge=_since_removed(charge, 13),
        billing_account=account,
        login=_since_removed(login, 17).withColumn("customerouid", F.col("customerouid") + (F.col("ouid") < 0).cast("long") * 7),
        applied_billing_tax_rate=_since_removed(tax, 19),
        payment_request=_since_removed(request, 21),
        settlement_note_advice=note,
    )


def _since_removed(df: DataFrame, share: int) -> DataFrame:
    """``df`` with a copy of some rows under a negative id, which the present vault no longer has."""
    gone = df.filter(F.col("ouid") % share == 0).withColumn("ouid", -F.col("ouid"))
    return df.unionByName(gone)


def earlier_list_vault(vault: Vault) -> Vault:
    """As ``earlier_vault``, with changes in every further source of the list."""
    earlier = earlier_vault(vault)

    def number(column: str):
        return F.expr(f"cast(substring({column}, 2) as bigint)")

    def other(df: DataFrame, where, **values) -> DataFrame:
        return df.withColumns({c: F.when(where, v).otherwise(F.col(c)).cast(df.schema[c].dataType) for c, v in values.items()})

    day = F.expr("interval 1 day")
    balance = other(earlier["billing_account_balance"], F.col("ouid") % 11 == 0, amount=F.col("amount") + 100, startdatetime=F.col("startdatetime") - day)
    product = other(earlier["product"], F.col("ouid") % 9 == 0, orderdate=F.col("orderdate") - day)
    lock = other(earlier["dunning_locks"], F.col("mba").endswith("5"), deleted=~F.col("deleted"))
    entry = other(earlier["journal_entries"], number("uuid") % 14 == 0, date=F.date_add("date", 1))
    item = other(earlier["journal_entry_items"], number("uuid") % 10 == 3, amount=F.col("amount") + 1)
    extra = earlier["journal_entry_items"].filter(number("uuid") % 31 == 0)
    summary = other(earlier["summaries"], number("uuid") % 12 == 0, export=~F.col("export"))
    tax_source = other(earlier["journal_entry_item_tax_source_items"], F.col("amount") % 3 == 0, amount=F.col("amount") + 1)
    state = other(earlier["payment_states"], F.col("id") == "Z1", payment_status=F.lit("EARLIER"))
    payment = other(earlier["payments"], number("id") % 18 == 0, amount=F.col("amount") + 5)
    paid = earlier["payment_bookings"].filter(number("id") % 8 != 0)
    paid = paid.unionByName(paid.filter(number("id") % 27 == 0).withColumn("id", F.concat(F.lit("gone"), F.col("id"))))
    tax_aggregate = other(earlier["tax_aggregate"], F.col("ouid") % 16 == 0, amount=-F.col("amount"))
    return earlier.replacing(
        billing_account_balance=_since_removed(balance.filter(F.col("ouid") % 25 != 0), 23),
        product=product.filter(F.col("ouid") % 33 != 0),
        dunning_locks=lock,
        journal_entries=entry,
        journal_entry_items=item.filter(number("uuid") % 29 != 0).unionByName(extra),
        summaries=summary,
        journal_entry_item_tax_source_items=tax_source,
        payment_states=state,
        payments=payment,
        payment_bookings=paid,
        tax_aggregate=tax_aggregate,
    )


def _charge_prints(vault):
    return inc.fingerprints(vault["applied_billing_charge"], ["ouid"], "datetimelastmodif", "aggregateid")


def _login_rows(vault):
    return vault["login"].filter(F.col("customerouid") > 0).select("ouid", "customerouid", F.md5("externalid").alias("hash"))


def _affected(vault):
    return inc.affected_charges(vault, inc.extract_changes(earlier_vault(vault), vault))


@on_vault
def row_fingerprints(vault):
    return _charge_prints(vault)


@on_vault
def changed_keys(vault):
    return inc.changed_keys(_charge_prints(vault), _charge_prints(earlier_vault(vault)), ["ouid"])


@on_vault
def changed_rows(vault):
    return inc.changed_rows(_login_rows(vault), _login_rows(earlier_vault(vault)))


@on_vault
def changed_since(vault):
    changed = inc.changed_since(
        vault["applied_billing_tax_rate"], earlier_vault(vault)["applied_billing_tax_rate"], "datetimelastmodif"
    )
    return changed.select("ouid", "appliedbillingchargeouid")


@on_vault
def affected_charges(vault):
    return _affected(vault)


@on_vault
def signed_changes(vault):
    return inc.signed_changes(earlier_vault(vault)["applied_billing_charge"], vault["applied_billing_charge"], ["ouid"])


@on_vault
def recompute_affected(vault):
    return inc.charge_extract(vault, _affected(vault))


@on_vault
def incremental_equals_full(vault):
    previous = inc.charge_extract(earlier_vault(vault))
    return inc.reload_charges(previous, vault, materialize(_affected(vault)))


@on_vault
def incremental_list(vault):
    state = inc_list.first(earlier_list_vault(vault), EARLIER, CLIENT, OVERLAYS)
    return inc_list.advance(state, vault, AS_OF, CLIENT, OVERLAYS).list()


@on_vault
def advance_snapshot(vault):
    snapshot, current = _charge_prints(earlier_vault(vault)), _charge_prints(vault)
    return inc.advance_snapshot(snapshot, inc.signed_changes(snapshot, current, ["ouid"]), current, ["ouid"])


@on_vault
def incremental_bookings(vault):
    runs = vault["booking_runs"]
    old = runs.filter(F.col("id") % 6 != 0).withColumn(
        "summary", F.when(F.col("id") % 4 == 0, F.replace("summary", F.lit("4000"), F.lit("4001"))).otherwise(F.col("summary"))
    )
    return inc.reload_bookings(inc.run_bookings(old), runs, inc.document_fingerprints(old))


# --- sinks -----------------------------------------------------------------------


@query
def chunk_rows(spark, folder):
    return chunk_manifest(raw_table(spark, folder, "lineitem"), CHUNK_ROWS)


def _folder(spark, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query
def csv_round_trip(spark, folder):
    """A second, shorter export leaves nothing of the first; read back from its files."""
    lines, target = raw_table(spark, folder, "lineitem"), _folder(spark, "export")
    write_chunks(lines.unionByName(lines), target, "system", "lines", CHUNK_ROWS)
    write_chunks(lines, target, "system", "lines", CHUNK_ROWS)
    return read_export(spark, target, "system", "lines", lines.schema)


@query
def bucket_replace(spark, folder):
    """Orders in folders by key: some not there yet, some with another value, some gone since."""
    orders, path, keys = raw_table(spark, folder, "orders"), _folder(spark, "orders"), ["o_orderkey"]
    earlier = orders.filter("o_orderkey % 9 <> 0").withColumn(
        "o_totalprice", F.when(F.col("o_orderkey") % 5 == 0, F.lit(0)).otherwise(F.col("o_totalprice")).cast(orders.schema["o_totalprice"].dataType)
    )
    earlier = earlier.unionByName(earlier.filter("o_orderkey % 7 = 0").withColumn("o_orderkey", -F.col("o_orderkey")))
    write_buckets(earlier, path, keys, 16)
    changed = inc.signed_changes(earlier, orders, keys)
    replace_keys(spark, path, orders.schema, changed, updates.keep_using(orders, changed, {"o_orderkey": "o_orderkey"}), keys, 16)
    return read_buckets(spark, path, orders.schema)


@on_vault
def published_list(vault):
    """The customer view of a list that was published over an earlier one."""
    rows = items.payment_bookings(vault["payment_bookings"], vault["payments"], vault["payment_states"], book.journal_bookings(vault))
    root = _folder(vault.spark, "published")
    publish_list(rows.limit(0), root, "published_payments")
    publish_list(rows, root, "published_payments")
    return items.customer_view(read_published(vault.spark, root))


@on_vault
def missing_source(vault):
    """Accounts of a vault that has no dunning tables."""
    present = {name: vault[name] for name in ("billing_account", "billing_account_relationship", "login")}
    return b.account_rows(Vault(vault.spark, lambda table: present[table]), AS_OF)


@on_vault
def malformed_runs(vault):
    """Documents cut short in transfer."""
    cut = F.when(F.col("id") % 41 == 0, F.expr("left(summary, length(summary) - 3)")).otherwise(F.col("summary"))
    found = malformed(materialize(parse_documents(vault["booking_runs"].withColumn("summary", cut))))
    return found.select("booking_execution_id", "booking_created")
