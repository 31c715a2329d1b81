"""The whole list from a vault."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from duebook.operators.numbering import HOT_ROWS
from duebook.plans import balances as bal
from duebook.plans import bookings as book
from duebook.plans import charges as chg
from duebook.plans import due_dates as due
from duebook.plans import open_items as items
from duebook.plans.dunning import dunning
from duebook.plans.overpayments import all_overpayment_dates
from duebook.plans.write_offs import write_offs
from duebook.session import materialize
from duebook.sources.documents import parse_documents, without_malformed
from duebook.sources.lookups import ClientLookups, client_lookups
from duebook.sources.vault import Vault


@dataclass(frozen=True)
class Dates:
    """Balance and due dates per transaction and per charge."""

    balance: DataFrame
    per_charge_balance: DataFrame
    per_charge_due: DataFrame


def propagated_due_dates(vault: Vault, max_rounds: int | None = due.MAX_REJECTION_ROUNDS) -> DataFrame:
    """Due dates of originals and of the rejections that inherit them."""
    charge = vault["applied_billing_charge"]
    originals = due.original_due_dates(charge, due.balance_dates(vault["billing_account_balance"]))
    return due.propagate_due_dates(originals, due.reject_edges(charge), max_rounds)


def overridden_due_dates(
    vault: Vault, propagated: DataFrame | None = None, stage: Callable[[DataFrame], DataFrame] = materialize
) -> DataFrame:
    """The three overrides, one after the other.

    Each reads the dates before it as own and as parent dates, so they are stored in between: one
    row per transaction and source, next to which the parents of the charges are read once.
    """
    charge = vault["applied_billing_charge"]
    rows = propagated_due_dates(vault) if propagated is None else propagated
    parents = stage(due.parent_links(charge))
    rows = stage(due.override_request_due(rows, charge, vault["payment_request"]))
    for link in (due.PARTIAL_PARENT, due.REJECTED_PARENT):
        rows = stage(due.override_from_parent(rows, parents, link))
    return rows


def due_dates(
    vault: Vault,
    stage: Callable[[DataFrame], DataFrame] = materialize,
    max_rounds: int | None = due.MAX_REJECTION_ROUNDS,
) -> Dates:
    """All date tables; ``stage`` stores those that later steps read several times."""
    charge, balance = vault["applied_billing_charge"], vault["billing_account_balance"]
    overridden = overridden_due_dates(vault, propagated_due_dates(vault, max_rounds), stage)
    dates = stage(due.apply_due_to_balance(due.balance_dates(balance), overridden))
    split = due.split_status_transactions(balance)
    per_charge = due.charge_balance_dates(balance, split, charge)
    per_charge = due.partial_due_on_charge(per_charge, charge, dates)
    per_charge = due.bonus_refund_dates(per_charge, charge)
    return Dates(dates, per_charge, due.charge_due_dates(charge, vault["settlement_note_advice"]))


def account_rows(vault: Vault, as_of: dt.date | None = None) -> DataFrame:
    accounts = due.account_map(vault["billing_account"], vault["billing_account_relationship"])
    state = dunning(vault, as_of) if as_of is not None else None
    return chg.account_table(vault["billing_account"], vault["login"], accounts, state)


def write_off_rows(vault: Vault) -> DataFrame:
    return write_offs(vault["product"], vault["order_item"], vault["note"], vault["product_order"])


@dataclass(frozen=True)
class ChargeInputs:
    """Everything that charges are joined with, keyed by charge, transaction, account, note or aggregate."""

    dates: DataFrame
    per_charge_balance: DataFrame
    per_charge_due: DataFrame
    accounts: DataFrame
    notes: DataFrame
    write_offs: DataFrame
    bills: DataFrame
    taxes: DataFrame
    signs: DataFrame


def charge_inputs(vault: Vault, as_of: dt.date, dates: Dates | None = None) -> ChargeInputs:
    charge, tax = vault["applied_billing_charge"], vault["applied_billing_tax_rate"]
    dates = due_dates(vault) if dates is None else dates
    return ChargeInputs(
        dates.balance,
        dates.per_charge_balance,
        dates.per_charge_due,
        account_rows(vault, as_of),
        vault["settlement_note_advice"].select("ouid", "id"),
        write_off_rows(vault),
        chg.found_bills(charge, vault["product"]),
        chg.charge_taxes(tax),
        chg.aggregate_signs(tax, charge),
    )


def assemble_charges(charge: DataFrame, inputs: ChargeInputs) -> DataFrame:
    """Rows of all given charges, which may be a part of the source table."""
    rows = chg.base_charges(
        charge, inputs.accounts, inputs.notes, inputs.per_charge_due, inputs.per_charge_balance, inputs.dates, inputs.write_offs
    )
    rows = chg.fill_bill_id(chg.can_be_due(rows), inputs.bills)
    return chg.charges(rows, inputs.taxes, inputs.signs)


def base_charge_rows(vault: Vault, as_of: dt.date, dates: Dates | None = None) -> DataFrame:
    dates = due_dates(vault) if dates is None else dates
    return chg.base_charges(
        vault["applied_billing_charge"],
        account_rows(vault, as_of),
        vault["settlement_note_advice"],
        dates.per_charge_due,
        dates.per_charge_balance,
        dates.balance,
        write_off_rows(vault),
    )


def charge_rows(vault: Vault, as_of: dt.date, dates: Dates | None = None) -> DataFrame:
    return assemble_charges(vault["applied_billing_charge"], charge_inputs(vault, as_of, dates))


def balance_rows(vault: Vault) -> DataFrame:
    return bal.balances(vault["billing_account_balance"], account_rows(vault))


def cancelled_rows(vault: Vault, lookups: ClientLookups, match_once: bool = False, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    charge = vault["applied_billing_charge"]
    return bal.due_cancelled_charges(
        bal.numbered_due_charges(charge, lookups.due_types, match_once, hot_rows),
        bal.numbered_cancelled_balances(vault["billing_account_balance"], hot_rows),
        charge,
    )


def tax_amounts(vault: Vault) -> DataFrame:
    return chg.tax_amounts_per_aggregate(
        vault["charge_aggregate"], vault["tax_aggregate"], vault["applied_billing_charge"], vault["applied_billing_tax_rate"]
    )


def tax_link(vault: Vault) -> DataFrame:
    return chg.charge_tax_link(
        vault["applied_billing_charge"], vault["charge_aggregate"], vault["tax_aggregate"], vault["applied_billing_tax_rate"]
    )


def build(
    vault: Vault,
    as_of: dt.date,
    client_id: str | None = None,
    overlays: Mapping[str, ClientLookups] | None = None,
    ledger: str = "journal",
    match_once: bool = False,
    hot_rows: int | None = HOT_ROWS,
    max_rounds: int | None = due.MAX_REJECTION_ROUNDS,
    quarantine: str | None = None,
) -> DataFrame:
    """The open item and balance list of one client.

    ``ledger`` chooses where bookings come from: ``journal`` or ``documents``.  Charges,
    bookings and the unbalanced list are stored in the checkpoint folder because several
    steps read them.  Chains of rejections are followed over ``max_rounds`` links as in the source
    system, or to their end with None.  A booking run that is no JSON document stops the build, or goes to
    the folder ``quarantine``.
    """
    lookups = client_lookups(client_id, overlays)
    if ledger == "documents":
        documents = without_malformed(materialize(parse_documents(vault["booking_runs"])), quarantine)
        books = book.ledger_from_documents(vault, lookups, documents)
    else:
        books = book.LEDGERS[ledger](vault, lookups)
    bookings = materialize(books.bookings)
    charges = materialize(charge_rows(vault, as_of, due_dates(vault, max_rounds=max_rounds)))
    parts = [
        items.open_items(
            charges,
            lookups.due_types,
            bookings,
            cancelled_rows(vault, lookups, match_once, hot_rows),
            all_overpayment_dates(vault, hot_rows),
        ),
        items.booked_charges(charges, tax_link(vault), bookings, tax_amounts(vault)),
        items.booked_balances(balance_rows(vault), bookings),
        items.booked_taxes(books.tax_bookings, charges, books.headers),
        items.payment_bookings(vault["payment_bookings"], vault["payments"], vault["payment_states"], bookings),
    ]
    return items.fix_imbalance(materialize(items.open_item_list(parts)))
